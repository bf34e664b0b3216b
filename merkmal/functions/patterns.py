"""Regular-expression building blocks.

Java patterns are ASCII unless told otherwise. ``U`` makes ``\\s \\d \\w`` follow
Unicode, ``iu`` makes case-insensitive matching follow Unicode. Word ends are
written as look-arounds over letters, digits and underscore, because ``\\b``
does not treat signs such as a superscript three as part of a word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

WORD = r"[\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"


def exact(pattern: str) -> str:
    return "(?U)" + pattern


def any_case(pattern: str) -> str:
    return "(?iuU)" + pattern


def keep_if(value: Column, test: Callable[[Column], Column]) -> Column:
    """The value when it passes the test, else null. ``value`` is computed once,
    where ``when(test(value), value)`` would compute it twice."""
    return F.get(F.filter(F.array(value), test), F.lit(0))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time.

    An expression named several times, or inside a lambda, is computed again each
    time; as the variable of an outer lambda it is computed once per row.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the leftmost match, null when there is no match."""
    return keep_if(F.regexp_extract(text, pattern, group), lambda g: g != "")


def all_groups(text: Column, pattern: Column | str, group: int = 1) -> Column:
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.regexp_extract_all(text, pattern, F.lit(group))


# Every character that counts as white space.
WHITE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Remove every kind of white space at both ends."""
    return F.btrim(text, F.lit(WHITE))


def quoted(text: Column) -> Column:
    """Escape a column so that it matches itself inside a pattern."""
    return F.regexp_replace(text, r"([^\p{L}\p{N}])", r"\\$1")


def after_unit(unit: Column) -> Column:
    """Word boundary behind a unit: it depends on the unit's last character."""
    return F.when(unit.rlike(WORD + "$"), F.lit(WORD_END)).otherwise(F.lit(rf"(?={WORD})"))


def number_with_unit(unit: Column, number: str = r"\d+[.,]?\d*") -> Column:
    """Pattern column ``number unit`` with the number as group 1."""
    return F.concat(F.lit(any_case(rf"({number})\s*")), quoted(unit), after_unit(unit))
