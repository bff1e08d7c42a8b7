import hashlib
import random
import re

import pytest

from hitledger.llm import pii as op

from .conftest import AWKWARD

#: The four patterns as they are specified, for comparison (fixed values).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _plain(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                spans.append(m.span())
        out[kind] = spans
    return out


def test_base_equals_the_patterns():
    rng = random.Random(11)
    pieces = ["@", ".", "-", "+", " ", "(", ")", "a", "B", "7", "0", "255", "256", "1.2.3.4", "x@y.z", "+1 (555) 010-9999",
              "4111 1111 1111 1111", "4111111111111111", "%", "_", "\n", "é", "@@", "a@b"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))
        base, every = op.find_spans(text)
        assert base == _plain(text), text
        assert all(set(base[k]) <= set(every[k]) for k in op.KINDS)


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("write jane.doe (at) example (dot) com now", "email", "jane.doe (at) example (dot) com"),
        ("mail jane at example dot com please", "email", "jane at example dot com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("x jane[at]mail[dot]example[dot]org.", "email", "jane[at]mail[dot]example[dot]org"),
        ("１９２.１６８.0.1 host", "ip", "１９２.１６８.0.1"),
        ("one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
        ("call plus one five five five zero one two three four today", "phone", "plus one five five five zero one two three four"),
        ("card four one one one 1111 1111 one one one one ok", "card", "four one one one 1111 1111 one one one one"),
        ("4111\u200b1111\u200b1111\u200b1111", "card", "4111\u200b1111\u200b1111\u200b1111"),
        ("+1\u2011555\u2011010\u20119999", "phone", "+1\u2011555\u2011010\u20119999"),
        ("host 192 dot 168 dot 0 dot 1 up", "ip", "192 dot 168 dot 0 dot 1"),
        ("192 dot 168 dot 0 dot 1 2024", "ip", "192 dot 168 dot 0 dot 1"),
        ("1 9 2 dot 1 6 8 dot 0 dot 1", "ip", "1 9 2 dot 1 6 8 dot 0 dot 1"),
        ("192[dot]168[dot]0[dot]1", "ip", "192[dot]168[dot]0[dot]1"),
        ("192[.]168[.]0[.]1", "ip", "192[.]168[.]0[.]1"),
        ("call plus 1 555 010 9999", "phone", "plus 1 555 010 9999"),
        ("call plus 1 (555) 010 9999", "phone", "plus 1 (555) 010 9999"),
        ("call plus 15550109999 now", "phone", "plus 15550109999"),
        ("4111 dash 1111 dash 1111 dash 1111", "card", "4111 dash 1111 dash 1111 dash 1111"),
        ("one_nine_two_dot_one_six_eight_dot_zero_dot_one", "ip", "one_nine_two_dot_one_six_eight_dot_zero_dot_one"),
        ("jane at example (dot) com", "email", "jane at example (dot) com"),
        ("jane at mail.example dot com", "email", "jane at mail.example dot com"),
        ("jane at mail dot example.com", "email", "jane at mail dot example.com"),
        ("jane at 123 dot com", "email", "jane at 123 dot com"),
        ("jane at one two three dot com", "email", "jane at one two three dot com"),
        ("jane dot doe at example_dot_com", "email", "jane dot doe at example_dot_com"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, part):
    base, every = op.find_spans(text)
    assert part in [text[a:b] for a, b in every[kind]]
    assert all(set(base[k]) <= set(every[k]) for k in op.KINDS)


@pytest.mark.parametrize("text", ["we met at noon. look at example", "one two three go", "the dot is at the end", "five or six", "привет"])
def test_prose_is_left_alone(text):
    assert not any(op.find_spans(text)[1].values())


@pytest.mark.parametrize("opening, closing", ["()", "[]", "{}", "<>"])
@pytest.mark.parametrize("space", ["", " "])
def test_each_disguise_is_found_alone(opening, closing, space):
    for word in ("dot", "Dot", ".", "punkt", "punto", "point"):
        sign = f"{opening}{space}{word}{space}{closing}"
        for around in ("", " "):
            text = f"jane@example{around}{sign}{around}com"
            assert op.find_spans(text)[1]["email"] == [(0, len(text))], text
    for word in ("at", "AT", "@"):
        text = f"jane{opening}{space}{word}{space}{closing}example.com"
        assert op.find_spans(text)[1]["email"] == [(0, len(text))], text


@pytest.mark.parametrize("text", ["jane@example_dot_com", "jane@example-dot-com", "jane_at_example.com", "jane-at-example.com",
                                  "jane @ example.com", "jane@ example.com", "jane@example dot com"])
def test_each_sign_without_brackets_is_found_alone(text):
    assert op.find_spans(text)[1]["email"] == [(0, len(text))]


@pytest.mark.parametrize("text", ["it stands at three point one four", "sold at 12 point 50", "look at example.com", "2 plus 3 point 5 is 5 point 5"])
def test_numbers_and_plain_names_after_at_are_left_alone(text):
    assert not any(op.find_spans(text)[1].values())


@pytest.mark.parametrize(
    "text",
    ["sold 100 @ 3.50 each", "at noon @ 10.30", "price 5 @3.99", "two for 3 @ 1.25", "version one dot two dot three dot four",
     "section 1 dot 2 dot 3 dot 4", "meet me at example dot com", "look at example dot com", "release 2 punto 0 punto 1 punto 5",
     "at this point we go", "le point de vue, at this point de depart", "option (a) first.second", "room @ 12.30 and 14.45", "the score was three point one four one five"],
)
def test_prices_versions_sections_and_times_are_left_alone(text):
    assert not any(op.find_spans(text)[1].values())


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("escribe a user arroba example punto com hoy", "email", "user arroba example punto com"),
        ("juan [arroba] correo.es", "email", "juan [arroba] correo.es"),
        ("jane(a)example.com", "email", "jane(a)example.com"),
        ("an hans ät beispiel punkt de", "email", "hans ät beispiel punkt de"),
        ("anna (ät) beispiel (punkt) de", "email", "anna (ät) beispiel (punkt) de"),
        ("écrire à luc arobase exemple point fr", "email", "luc arobase exemple point fr"),
        ("ruf plus vier neun eins sieben null eins zwei drei vier fünf an", "phone", "plus vier neun eins sieben null eins zwei drei vier fünf"),
        ("appelez plus trois trois un deux trois quatre cinq six sept huit neuf", "phone", "plus trois trois un deux trois quatre cinq six sept huit neuf"),
        ("llama al más tres cuatro seis uno dos tres cuatro cinco seis siete", "phone", "más tres cuatro seis uno dos tres cuatro cinco seis siete"),
        ("eins neun zwei punkt eins sechs acht punkt null punkt eins", "ip", "eins neun zwei punkt eins sechs acht punkt null punkt eins"),
        ("un neuf deux point un six huit point zéro point un", "ip", "un neuf deux point un six huit point zéro point un"),
        ("uno nueve dos punto uno seis ocho punto cero punto uno", "ip", "uno nueve dos punto uno seis ocho punto cero punto uno"),
        ("vier eins eins eins 1111 1111 eins eins eins eins", "card", "vier eins eins eins 1111 1111 eins eins eins eins"),
        ("quatre un un un 1111 1111 1111 un", "none", ""),
        ("cuatro uno uno uno 1111 1111 uno uno uno uno", "card", "cuatro uno uno uno 1111 1111 uno uno uno uno"),
        ("ip address 8 dot 8 dot 8 dot 8", "ip", "8 dot 8 dot 8 dot 8"),
        ("dns eight dot eight dot four dot four", "ip", "eight dot eight dot four dot four"),
        ("8[.]8[.]8[.]8", "ip", "8[.]8[.]8[.]8"),
        ("ONE Nine TWO Dot one six eight DOT zero dot ONE", "ip", "ONE Nine TWO Dot one six eight DOT zero dot ONE"),
        ("İİ ONE Nine TWO Dot one six eight DOT zero dot ONE", "ip", "ONE Nine TWO Dot one six eight DOT zero dot ONE"),
        ("JANE ARROBA EXAMPLE PUNTO COM", "email", "JANE ARROBA EXAMPLE PUNTO COM"),
    ],
)
def test_disguises_in_four_languages(text, kind, part):
    every = op.find_spans(text)[1]
    if kind == "none":
        assert not any(every.values())
    else:
        assert part in [text[a:b] for a, b in every[kind]]


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000, "one " * 50_000, "@ " * 100_000):
        op.find_spans(text)


def test_every_row(table):
    rows = [*AWKWARD, (50, "me@here.org 1.2.3.4"), (51, "me (at) here (dot) org"), (50, "me@here.org 1.2.3.4")]
    found = sorted((repr(r.doc_id), r.n_email, r.n_ip, r.base_sha256, r.spans) for r in op.find_personal_data(table(*rows)).collect())
    assert len(found) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    seal = hashlib.sha256(b"email:0:11,ip:12:19").hexdigest()
    assert found.count(("50", 1, 1, seal, "email:0:11,ip:12:19")) == 2
    assert ("51", 1, 0, empty, "email:0:22") in found
    assert op.find_personal_data(table((1, "a")).limit(0)).collect() == []
