"""Personal data in plain and in disguised form, as spans of the source text.

Plain identifiers come from four patterns. For disguised ones a cascade of transducers
rewrites the text: look-alike characters to ASCII, zero-width characters away, digits
in words to digits, at/dot disguises to ``@`` and ``.``. Every rewritten character keeps
the source span it came from, through all stages, so the same four patterns run on the
rewritten text and their matches map back to the source.

Words for digits, signs, dots and the at-sign are known in English, German, French and Spanish. Left alone are: prices and times after a
spaced sign, ``at`` after a common word, names after ``at`` whose dots are plain, and four one-digit numbers with dots in words (a version or
section) unless an address is announced before them. Not covered: numbers in words above nine, other languages, and
addresses written backwards or over several lines.

Spans count code points, end exclusive. Null and empty texts have none, repeated rows have the same, an empty table gives no rows. Any length of text is
read whole, in time that grows with its length.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from hitledger.llm.common import per_text

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits either matches from its first digit or not at all, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = str.maketrans("", "", " ().-+")

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    """From each ``@``: the letters before it back to the last match, then the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            yield m.span()


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].translate(_NO_DIGIT)
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(m[0].translate(_NO_DIGIT)) <= 15:
                yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


class Rewritten:
    """A text and, for each of its characters, the span of the source it stands for."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text = text
        self.starts = range(len(text)) if starts is None else starts
        self.ends = range(1, len(text) + 1) if ends is None else ends

    def apply(self, pattern: re.Pattern, rule: Callable[[re.Match], list[tuple[str, int, int]] | None], seen: str | None = None) -> Rewritten:
        """One transducer: ``rule`` gives (character, start, end) in this text, or None to copy. ``seen``: the same in lower case, to look at instead."""
        out: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        done = 0
        for m in pattern.finditer(self.text if seen is None else seen):
            pieces = rule(m)
            if pieces is None:
                continue
            out.append(self.text[done : m.start()])
            starts += self.starts[done : m.start()]
            ends += self.ends[done : m.start()]
            for char, start, end in pieces:
                out.append(char)
                starts.append(self.starts[start])
                ends.append(self.ends[end - 1])
            done = m.end()
        if not done:
            return self
        out.append(self.text[done:])
        return Rewritten("".join(out), [*starts, *self.starts[done:]], [*ends, *self.ends[done:]])

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


#: Letters of other scripts that look like an ASCII letter (fixed values).
_LIKE = dict(zip("абвезіјкмнорсԁһѕтухԛԝАВЕЗІЈКМНОРСЅТУХαγιορτυνκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "a6Be3ijkmhopcdhstyxqwABE3IJKMHOPCSTYXaylopTuvKABEZHIKMNOPTYX"))
#: Stops, dashes and spaces that look like an ASCII one; characters that are not seen (fixed values).
_LIKE |= {"\u3002": ".", "\u2024": "."} | dict.fromkeys("\u2010\u2011\u2012\u2013\u2212", "-") | dict.fromkeys("\xa0\u2007\u2009\u202f", " ")
_INVISIBLE = "\xad\u200b\u200c\u200d\u2060\ufeff"


def _look_alike(char: str) -> str:
    """The ASCII character that this one stands for, or itself."""
    if char in _LIKE:
        return _LIKE[char]
    if (value := unicodedata.decimal(char, None)) is not None:
        return str(value)
    plain = unicodedata.normalize("NFKC", char)
    return plain if len(plain) == 1 and plain.isascii() and plain.isprintable() else char


#: Ranges that hold look-alikes: Greek, Cyrillic, foreign digits, punctuation, enclosed, CJK stop, full-width, mathematical.
_FOREIGN = re.compile(
    r"[\xa0\xadͰ-ԯ٠-٩۰-۹߀-߉०-९  ​-‍‐-–․"
    r" ⁠⁰-₉−①-⓪。﹒﹫﻿！-～\U0001d400-\U0001d7ff]"
)


def _plain_letter(m: re.Match) -> list[tuple[str, int, int]] | None:
    if m[0] in _INVISIBLE:
        return []
    plain = _look_alike(m[0])
    return None if plain == m[0] else [(plain, m.start(), m.end())]


#: Words for digits and signs in English, German, French and Spanish (fixed values).
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_SIGNS = {
    "plus": "+", "más": "+", "mas": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".",
    "dash": "-", "hyphen": "-", "minus": "-", "strich": "-", "bindestrich": "-", "tiret": "-", "guion": "-", "guión": "-",
}
_WORDS = _DIGITS | _SIGNS
#: Longer words first, as some begin others.
_WORD_ITEM = "|".join(sorted(_WORDS, key=len, reverse=True))
_ITEM = rf"(?:(?:{_WORD_ITEM})(?![^\W\d_])|[0-9]|[+.])"
#: At least four items, the first two words of digits not needed: digits and words may be mixed. A word for plus counts alone before a digit.
#: For text in lower case, in which the first letter is quick to look at.
_RUN = rf"(?:{_ITEM}(?:[\s,;_/-]*+{_ITEM}){{3,}}+|(?:plus|más|mas)[\s,;_/-]{{0,3}}(?=[0-9]))"
_FIRST = "".join(sorted({word[0] for word in _WORDS}))
_SPELLED = re.compile(rf"(?<![^\W_])(?=[0-9+.{_FIRST}]){_RUN}")
_SPELLED_ANY_CASE = re.compile(rf"(?<![^\W_]){_RUN}", re.I)
_SPELLED_ITEM = re.compile(rf"{_ITEM}", re.I)


def _spelled(m: re.Match) -> list[tuple[str, int, int]] | None:
    """Signs in words count between digits (``plus``: before one). With words for digits all separators go; without,
    those beside a sign in words and between digits that stand singly."""
    if m[0].lower() == m[0].upper():  # no word
        return None
    items = [(i.start(), i.end(), i[0].lower()) for i in _SPELLED_ITEM.finditer(m.string, m.start(), m.end())]
    if len(items) == 1:
        return [("+", m.start(), m.end())]
    first, last = 0, len(items)
    while last and not _WORDS.get(items[last - 1][2], items[last - 1][2]).isdigit():
        last -= 1
    while first < last and items[first][2] in _WORDS and _WORDS[items[first][2]] in ".-":
        first += 1
    items = items[first:last]
    words = [item in _WORDS for _, _, item in items]
    if not any(words):
        return None
    whole = any(word and _WORDS[item].isdigit() for word, (_, _, item) in zip(words, items))
    text = m.string
    single = [item.isdigit() and not text[a - 1 : a].isdigit() and not text[b : b + 1].isdigit() for a, b, item in items]
    out = [(text[i], i, i + 1) for i in range(m.start(), items[0][0])]
    for k, (start, end, item) in enumerate(items):
        if k and not (whole or words[k - 1] or words[k] or single[k - 1] and single[k]):
            out += [(text[i], i, i + 1) for i in range(items[k - 1][1], start)]
        out.append((_WORDS.get(item, item), start, end))
    return out + [(text[i], i, i + 1) for i in range(items[-1][1], m.end())]


#: ``_AT`` and ``_DOT`` hold one of these openings; a set of characters in front is quick to search for.
_MARKED = r"[(\[{{<_-](?:(?<=[(\[{{<])\s?(?:{0})\s?[)\]}}>]|(?<=[-_]){1}[-_])"
_AT_WORDS = "arroba|arobase|arobas|klammeraffe|ät|aet"
_AT_MARK = _MARKED.format(f"at|@|{_AT_WORDS}", f"(?:at|{_AT_WORDS})")
_DOT_MARK = _MARKED.format(r"dot|\.|punkt|punto|point", "(?:dot|punkt|punto|point)")
_AT, _HAS_AT = re.compile(rf"\s{{0,3}}{_AT_MARK}\s{{0,3}}", re.I), re.compile(_AT_MARK, re.I)
_DOT, _HAS_DOT = re.compile(rf"\s{{0,3}}{_DOT_MARK}\s{{0,3}}", re.I), re.compile(_DOT_MARK, re.I)
#: A name with dots; its last label has two letters at least.
_NAME = r"(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z](?![A-Za-z0-9-])"
#: ``(a)`` stands for the sign only between letters, without spaces.
_SHORT_AT = re.compile(rf"(?<=[A-Za-z0-9])[(\[{{<]a[)\]}}>](?={_NAME})", re.I)
#: Without brackets, ``at`` counts only before a name with a spelled or rewritten dot, and not after a common word: ``_plain_at``.
_PLAIN_AT = re.compile(
    r"(?<=[A-Za-z0-9])\s{1,3}(at|" + _AT_WORDS + r")\s{1,3}(?=([A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+))", re.I
)
#: Before ``at`` these end no address (fixed values).
_COMMON = frozenset(
    """a an the and or but i me you he him she her it we us they them this that these those is are was were be been am being look looks looked
    looking see seen saw meet met find found visit visited here there back home work works worked working live lives lived living stay stayed
    available online open closed up down out in on now then today tomorrow tonight stand stands stood arrive arrived start starts started
    end ends ended buy bought sell sold order ordered read more information info only not all""".split()
)
#: Unbracketed words for a dot. The ambiguous ones count only before a common end of a name (fixed values).
_PLAIN_DOT = re.compile(
    r"(?<=[A-Za-z0-9])\s{1,3}(?:dot\s{1,3}(?=[A-Za-z0-9])"
    r"|(?:punkt|punto|point)\s{1,3}(?=(?:com|org|net|edu|gov|info|io|de|fr|es|eu|uk|at|ch|it|mx|ar)\b))", re.I
)
_DOT_WORDS = ("dot", "punkt", "punto", "point")
#: A space beside the sign: what follows must be a name and what comes before more than a number.
_SPACED_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:\s{{1,2}}@\s{{0,2}}|\s{{0,2}}@\s{{1,2}})(?={_NAME})")


def _sign(char: str) -> Callable[[re.Match], list[tuple[str, int, int]]]:
    return lambda m: [(char, m.start(), m.end())]


def _before(text: str, place: int) -> str:
    """The word that ends at a place, up to white space."""
    start = place
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:place]


def _plain_at(now: Rewritten, source: str) -> Callable[[re.Match], list[tuple[str, int, int]] | None]:
    """A number with a spelled point is no name; four of them are an address. A word that means only the sign needs no spelled dot."""

    def rule(m: re.Match) -> list[tuple[str, int, int]] | None:
        dots = [i for i, c in enumerate(m[2], m.start(2)) if c == "."]
        named = len(dots) == 3 or any(c.isalpha() for c in m[2])
        spelled = any(source[now.starts[i] : now.ends[i]] != "." for i in dots)
        plain = m[1].lower() == "at" and (not spelled or _before(m.string, m.start()).lower() in _COMMON)
        return [("@", m.start(), m.end())] if named and not plain else None

    return rule


def _spaced_at(m: re.Match) -> list[tuple[str, int, int]] | None:
    word = _before(m.string, m.start())
    named = any(c.isalpha() for c in word) and word.lower() not in _COMMON
    return [("@", m.start(), m.end())] if named else None


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises; None if it has none. Every rule looks at every text, dots before at-signs."""
    out = Rewritten(text)
    if not text.isascii():
        out = out.apply(_FOREIGN, _plain_letter)
    low = out.text.lower()
    if len(low) == len(out.text):
        out = out.apply(_SPELLED, _spelled, low)
    else:  # letters that are two in lower case
        out = out.apply(_SPELLED_ANY_CASE, _spelled)
    if _HAS_DOT.search(out.text):
        out = out.apply(_DOT, _sign("."))
    low = out.text.lower()
    if any(word in low for word in _DOT_WORDS):
        out = out.apply(_PLAIN_DOT, _sign("."))
    if _HAS_AT.search(out.text):
        out = out.apply(_AT, _sign("@"))
    if any(mark in low for mark in ("(a)", "[a]", "{a}", "<a>")):
        out = out.apply(_SHORT_AT, _sign("@"))
    if out.text != text or any(word in low for word in _AT_WORDS.split("|")):  # otherwise no dot is rewritten
        out = out.apply(_PLAIN_AT, _plain_at(out, text))
    if "@" in out.text:
        out = out.apply(_SPACED_AT, _spaced_at)
    return None if out.text == text else out


#: Words that announce an address (fixed values).
_ADDRESS = re.compile(r"(?<![^\W_])(?:ip|ipv4|address|adresse|dirección|direccion|host|server|serveur|servidor|dns|gateway|router|ping|subnet|localhost)(?![^\W_])", re.I)
_DOT_WORD = re.compile(r"(?<![(\[{<_-])\b(?:dot|point|punkt|punto)\b", re.I)


def _is_version(text: str, span: Span, number: str) -> bool:
    """Four small numbers with dots in words are rather a version or a section, unless an address is announced."""
    if any(int(part) > 9 for part in number.split(".")) or not _DOT_WORD.search(text[span[0] : span[1]]):
        return False
    return not _ADDRESS.search(text[max(0, span[0] - 30) : span[0]])


def find_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and all spans, per kind and in order of place."""
    base = {kind: list(FINDERS[kind](text)) for kind in KINDS}
    clear = rewrite(text)
    if clear is None:
        return base, base
    every = {}
    for kind in KINDS:
        known = sorted(base[kind])
        found = [(clear.source(span), clear.text[span[0] : span[1]]) for span in FINDERS[kind](clear.text)]
        more = {span for span, number in found if kind != "ip" or span in base[kind] or not _is_version(text, span, number)}
        every[kind] = sorted({*known, *(s for s in more if not _inside(s, known))})
    return base, every


def _inside(span: Span, known: list[Span]) -> bool:
    return any(a <= span[0] and span[1] <= b for a, b in known)


def _write(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_base long"


def _digest(texts: list[str]) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, every = find_spans(text)
        digest = hashlib.sha256(_write(base).encode()).hexdigest()
        rows.append((*(len(every[k]) for k in KINDS), digest, _write(every), sum(map(len, base.values()))))
    return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_base"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, spans counted per kind, ``base_sha256``, ``spans``, ``n_base``. No shuffle."""
    return per_text(docs, lambda: _digest, SCHEMA)
