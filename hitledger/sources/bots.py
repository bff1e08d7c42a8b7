"""The ordered crawler list."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession

from hitledger.crawlers import CRAWLERS
from hitledger.schema import BOTS


class Bot(NamedTuple):
    name: str
    patterns: tuple[str, ...]
    is_llm: bool = True
    ip_ranges: tuple[str, ...] = ()

    @property
    def regex(self) -> str:
        """All patterns as one regular expression; a named group is spelled Spark's way."""
        return "|".join(self.patterns).replace("(?P<", "(?<")


def _bot(name: str, spec: Any) -> Bot:
    if not isinstance(spec, dict):
        return Bot(name, (str(spec),))
    patterns = spec.get("patterns", [])
    if isinstance(patterns, str):
        patterns = [patterns]
    return Bot(
        name,
        tuple(str(p) for p in patterns) or (name,),
        bool(spec.get("is_llm", True)),
        tuple(spec.get("ip_ranges") or ()),
    )


def bots_from_mapping(mapping: dict[str, Any]) -> list[Bot]:
    """An entry is ``{patterns, ip_ranges, is_llm}`` or just a pattern.

    A missing or empty pattern list means the entry's own name, a missing flag true.
    """
    return [_bot(name, spec) for name, spec in mapping.items()]


def default_bots() -> list[Bot]:
    return [
        Bot(name, tuple(patterns), flag, tuple(ranges))
        for name, (flag, patterns, ranges) in CRAWLERS.items()
    ]


def load_bots(spark: SparkSession, path: str) -> list[Bot]:
    """Read a crawler list from one JSON file, keeping the order of its entries.

    A list is configuration a person edits, so it is read whole; key order, which
    decides between entries, would be lost in a JSON table.
    """
    found = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path} must be exactly one file")
    return bots_from_mapping(json.loads(found[0].value))


def list_mark(bots: Sequence[Bot]) -> str:
    """Tells crawler lists apart: the same names, patterns and flags in the same order have the same mark."""
    text = json.dumps([[bot.name, bot.patterns, bot.is_llm] for bot in bots])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def bots_frame(spark: SparkSession, bots: Sequence[Bot] | Iterable[Bot]) -> DataFrame:
    rows = [
        (ord_, bot.name, list(bot.patterns), bot.regex, list(bot.ip_ranges), bot.is_llm)
        for ord_, bot in enumerate(bots)
    ]
    return spark.createDataFrame(rows, BOTS)
