"""User-agent classification as SQL expressions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from hitledger.functions.text import literal, strip
from hitledger.sources.bots import Bot

# Ignore case by Unicode rules, Unicode character classes, and only a newline ends a line.
REGEX_FLAGS = "(?iUd)"

_REGEX_CHARACTERS = set("\\^$*+?{}[]|()")
_GATE_SIZE = 3


def _plain_text(pattern: str) -> str | None:
    """The longest piece of plain text a match must hold, if the pattern is that simple."""
    if not pattern.isascii() or _REGEX_CHARACTERS & set(pattern):
        return None
    return max(pattern.lower().split("."), key=len)


def _plain_patterns(bot: Bot) -> list[str] | None:
    """Patterns free of regex syntax other than the dot; None if any has more.

    A pattern that holds another plain one of the same entry can never decide.
    """
    if any(_plain_text(p) is None for p in bot.patterns):
        return None
    lowered = list(dict.fromkeys(p.lower() for p in bot.patterns))
    return [
        p for p in lowered
        if not any(q != p and "." not in q and q in p for q in lowered)
    ]


def _matches(bot: Bot, agent: str, folded: str) -> str:
    plain = _plain_patterns(bot)
    if plain is None:
        return f"rlike({agent}, {literal(REGEX_FLAGS + bot.regex)})"
    tests = []
    for pattern in plain:
        test = f"contains({folded}, {literal(_plain_text(pattern))})"
        if "." in pattern:
            test = f"({test} AND rlike({agent}, {literal(REGEX_FLAGS + pattern)}))"
        tests.append(test)
    return " OR ".join(tests)


def is_plain(bots: Sequence[Bot]) -> bool:
    """Whether the whole list can be applied by substring tests."""
    return all(_plain_patterns(bot) is not None for bot in bots)


def gate_words(bots: Sequence[Bot]) -> list[str] | None:
    """Few short words, one of which every matching agent must hold.

    Chosen greedily, the piece of text shared by most patterns first ("bot"), longer
    pieces before shorter ones since they are rarer in other agents. None if some
    pattern cannot be covered this way.
    """
    left: list[str] = []
    for bot in bots:
        plain = _plain_patterns(bot)
        if plain is None:
            return None
        left += [_plain_text(p) for p in plain]
    if any(len(text) < _GATE_SIZE for text in left):
        return None
    chosen: list[str] = []
    while left:
        counts = Counter(
            piece
            for text in left
            for piece in {
                text[i:j]
                for i in range(len(text))
                for j in range(i + _GATE_SIZE, len(text) + 1)
            }
        )
        best = min(counts, key=lambda p: (-(counts[p] - 1) * len(p), -len(p), p))
        chosen.append(best)
        left = [text for text in left if best not in text]
    return chosen


def bot_name(agent: str, folded: str, bots: Sequence[Bot]) -> str:
    """Name of the first entry that matches, null when none does or the agent is empty.

    Stays a row-by-row expression without shuffle or join. Plain patterns become
    substring tests, about eight times cheaper than the regular expression, and the
    gate spares most human agents the whole chain.
    """
    if not bots:
        return "CAST(NULL AS STRING)"
    chain = "\n".join(
        f"WHEN {_matches(bot, agent, folded)} THEN {literal(bot.name)}" for bot in bots
    )
    worth_trying = f"{agent} <> ''"
    words = gate_words(bots)
    if words is not None:
        gate = " OR ".join(f"contains({folded}, {literal(w)})" for w in words)
        worth_trying += f" AND ({gate})"
    return f"CASE WHEN {worth_trying} THEN CASE {chain} END END"


def is_llm(name: str, bots: Sequence[Bot]) -> str:
    names = ", ".join(literal(bot.name) for bot in bots if bot.is_llm)
    return f"coalesce({name} IN ({names}), false)" if names else "false"


def clean_agent(agent: str) -> str:
    return strip(f"coalesce({agent}, '')")


# Ordered families of browsers and systems, first match wins. A
# family is recognised by plain text in the agent.
BROWSERS = {
    "Crawler": ["bot", "spider", "crawler", "facebookexternalhit"],
    "Edge": ["Edg/", "EdgA/", "EdgiOS/", "Edge/"],
    "Opera": ["OPR/", "Opera"],
    "Samsung Internet": ["SamsungBrowser"],
    "Firefox": ["Firefox/", "FxiOS/"],
    "Chrome": ["Chrome/", "CriOS/", "Chromium/"],
    "Safari": ["Safari/"],
    "Internet Explorer": ["MSIE ", "Trident/"],
}
SYSTEMS = {
    "Windows": ["Windows"],
    "Android": ["Android"],
    "iOS": ["iPhone", "iPad", "iPod"],
    "macOS": ["Mac OS X", "Macintosh"],
    "Chrome OS": ["CrOS"],
    "Linux": ["Linux", "X11"],
}


def family(folded: str, families: dict[str, list[str]]) -> str:
    """First family whose text the lower-case agent holds, ``Unknown`` otherwise."""
    branches = "\n".join(
        "WHEN "
        + " OR ".join(f"contains({folded}, {literal(t.lower())})" for t in texts)
        + f" THEN {literal(name)}"
        for name, texts in families.items()
    )
    return f"CASE {branches} ELSE 'Unknown' END"
