"""Addresses and ranges as 128-bit numbers, in two BIGINT halves.

An IPv4 address is the IPv6 address that stands for it (``::ffff:a.b.c.d``), so both kinds lie on one line. The sign bit of a half
is turned over: as signed numbers, halves then have the order of the unsigned ones.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from hitledger.functions.text import literal, strip

_GROUP = "[0-9a-f]{1,4}"
_GROUPS = f"{_GROUP}(?::{_GROUP})*"
#: Groups, and at most one gap between them; their number is looked at apart.
_SIX = rf"^(?:{_GROUPS})?(?:::(?:{_GROUPS})?)?\z"


def ipv4_number(address: str) -> str:
    """The address as a BIGINT; null when it is not a dotted IPv4 address."""
    octets = [f"CAST(split_part({address}, '.', {part}) AS BIGINT)" for part in range(1, 5)]
    number = octets[0]
    for octet in octets[1:]:
        number = f"({number} * 256 + {octet})"
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    dotted = literal(rf"^({octet}\.){{3}}{octet}\z")
    return f"CASE WHEN rlike({address}, {dotted}) THEN {number} END"


def _half(digits: str) -> str:
    """Sixteen hexadecimal digits as a BIGINT with its sign bit turned over."""
    return f"(CAST(conv({digits}, 16, -10) AS BIGINT) ^ shiftleft(1L, 63))"


def with_address_number(rows: DataFrame, address: str, name: str) -> DataFrame:
    """Add the address as ``STRUCT<hi BIGINT, lo BIGINT>``; null when the text is no address.

    Known forms: dotted IPv4; IPv6 in full, with a gap, in either case, with a dotted tail.
    """
    groups = "transform(concat(_head, array_repeat('0', 8 - size(_head) - size(_rest)), _rest), g -> lpad(g, 4, '0'))"
    steps = {
        "_ip": f"lower({strip(address)})",
        "_four": ipv4_number("_ip"),
        "_tail": "CASE WHEN contains(_ip, ':') AND contains(_ip, '.') THEN substring_index(_ip, ':', -1) END",
        "_tail_number": ipv4_number("_tail"),
        # a dotted address or tail is written as groups
        "_six": """CASE WHEN _four IS NOT NULL THEN concat('::ffff:', hex(shiftright(_four, 16)), ':', hex(_four & 65535))
            WHEN _tail_number IS NOT NULL THEN concat(left(_ip, char_length(_ip) - char_length(_tail)),
              hex(shiftright(_tail_number, 16)), ':', hex(_tail_number & 65535))
            WHEN _tail IS NULL THEN _ip END""",
        "_text": f"CASE WHEN contains(_six, ':') AND rlike(lower(_six), {literal(_SIX)}) THEN lower(_six) END",
        "_gap": "contains(_text, '::')",
        "_head": "array_remove(split(substring_index(_text, '::', 1), ':'), '')",
        "_rest": "CASE WHEN _gap THEN array_remove(split(substring_index(_text, '::', -1), ':'), '') ELSE array() END",
        "_digits": f"""CASE WHEN (_gap AND size(_head) + size(_rest) < 8) OR (NOT _gap AND size(_head) = 8)
            THEN array_join({groups}, '') END""",
    }
    out = rows
    for step, value in steps.items():
        out = out.selectExpr("*", f"{value} AS {step}")
    number = f"named_struct('hi', {_half('left(_digits, 16)')}, 'lo', {_half('right(_digits, 16)')})"
    return out.selectExpr(*rows.columns, f"CASE WHEN _digits IS NOT NULL THEN {number} END AS {name}")


def range_bounds(cidr: str) -> tuple[int, int]:
    """First and last address of a range as 128-bit numbers. Host bits may be set."""
    network = ipaddress.ip_network(cidr, strict=False)
    base = 0xFFFF << 32 if network.version == 4 else 0
    return base + int(network.network_address), base + int(network.broadcast_address)


def merged_ranges(ranges: Iterable[str]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(map(range_bounds, ranges)):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def halves(number: int) -> tuple[int, int]:
    """A 128-bit number as the two BIGINTs that ``with_address_number`` makes."""
    def signed(half: int) -> int:
        return half - (1 << 63)

    return signed(number >> 64), signed(number & ((1 << 64) - 1))


#: A list of ranges as a column, in order.
RANGES = "ARRAY<STRUCT<first: STRUCT<hi: BIGINT, lo: BIGINT>, last: STRUCT<hi: BIGINT, lo: BIGINT>>>"


def in_ranges(number: str, ranges: str) -> str:
    """Whether an address lies in one of the ranges, by bisection: steps of halved length over the sorted starts."""
    steps = "transform(sequence(0, 20), i -> shiftleft(1, 20 - i))"
    seek = (
        f"aggregate({steps}, 0, (place, step) -> CASE WHEN place + step <= size({ranges}) "
        f"AND get({ranges}, place + step - 1).first <= {number} THEN place + step ELSE place END)"
    )
    return f"coalesce(get({ranges}, {seek} - 1).last >= {number}, false)"
