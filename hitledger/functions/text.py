"""Text helpers. Like all of this package they take and return SQL expressions.

A long expression built call by call through the Python API costs the driver more
time than the query on a small table; as text it is parsed in one step.
"""

from __future__ import annotations

# Every character Unicode calls white space, plus the four
# separators U+001C..U+001F, which count as space when a line is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def literal(text: str) -> str:
    """A string as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


_SPACE = literal(WHITESPACE)
_BLANKS = literal(" " * len(WHITESPACE))


def strip(text: str) -> str:
    """Remove white space at both ends. A regular expression here costs ten times as much."""
    return f"btrim({text}, {_SPACE})"


def strip_column(column: str) -> str:
    """The same for a column. Trimming looks at every character; text between two visible ASCII characters needs none."""
    ends = [f"{side}({column}, 1) BETWEEN '!' AND '~'" for side in ("left", "right")]
    return f"CASE WHEN {' AND '.join(ends)} THEN {column} ELSE {strip(column)} END"


def words(text: str) -> str:
    """Split on runs of white space, without empty words."""
    return f"array_remove(split(translate({text}, {_SPACE}, {_BLANKS}), ' '), '')"


def words_of_column(column: str) -> str:
    """The same for a column. Only text with other characters than visible ASCII and the space has its white space replaced."""
    spaced = f"CASE WHEN {column} RLIKE '[^ -~]' THEN translate({column}, {_SPACE}, {_BLANKS}) ELSE {column} END"
    return f"array_remove(split({spaced}, ' '), '')"


def fold_case(text: str) -> str:
    """Lower case such that plain ASCII patterns match as they would ignoring case.

    Four letters outside ASCII are equal to an ASCII letter when case is
    ignored: dotted I, dotless i, long s and the Kelvin sign. The detour is
    taken only by values that hold more bytes than characters.
    """
    return (
        f"CASE WHEN octet_length({text}) = char_length({text}) THEN lower({text}) "
        f"ELSE lower(translate({text}, '\u0130\u0131\u017f\u212a', 'iisk')) END"
    )
