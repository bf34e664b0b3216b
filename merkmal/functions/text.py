"""Text columns every layer starts from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from merkmal.functions.patterns import once


def blank_if_null(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def rule_text(title: Column | str = "title", description: Column | str = "description") -> Column:
    """Title, one blank, description."""
    return F.concat_ws(" ", blank_if_null(title), blank_if_null(description))


def german_decimals(text: Column) -> Column:
    """Turn a comma between two digits into a dot."""
    return F.when(text.contains(","), F.regexp_replace(text, r"(?U)(\d),(\d)", "$1.$2")).otherwise(text)


def cut(text: Column, chars: int | None) -> Column:
    """Whole text by default; a length is only used when a caller asks for one."""
    return text if chars is None else F.substring(text, 1, chars)


def plain_text(description_chars: int | None = None) -> Column:
    """Classifier text: title, blank, description."""
    return F.concat(blank_if_null("title"), F.lit(" "), cut(blank_if_null("description"), description_chars))


def piped_text(description_chars: int | None = None) -> Column:
    """Classifier text that names the category: three parts joined by a pipe."""
    return F.concat_ws(
        " | ",
        F.replace(blank_if_null("category"), F.lit("_"), F.lit(" ")),
        blank_if_null("title"),
        cut(blank_if_null("description"), description_chars),
    )


def words_of(text: Column) -> Column:
    """Lower-case words of two or more word characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def flat_text(text: Column) -> Column:
    """Lower-case text with white-space runs made one blank."""
    return F.regexp_replace(F.lower(text), r"(?U)\s\s+", " ")


def word_terms(text: Column) -> Column:
    """Lower-case words of two or more word characters and their bigrams, in order."""
    words = words_of(text)
    pairs = lambda w: F.transform(
        F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda word, i: F.concat(F.get(w, i), F.lit(" "), word)
    )
    return once(words, lambda w: F.concat(w, pairs(w)))


def substrings(text: Column, n: int) -> Column:
    """All substrings of ``n`` characters in order.

    A look-ahead at every character takes them in one native walk; positions in
    the middle of a surrogate pair are no characters.
    """
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{n}}}))"), F.lit(1))


def char_terms(text: Column, low: int = 2, high: int = 4) -> Column:
    """Character n-grams of the lower-case text with white-space runs made one blank."""
    flat = flat_text(text)
    return F.concat(*[substrings(flat, n) for n in range(low, high + 1)])
