"""Key-value pairs of a description as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from merkmal.functions.patterns import strip
from merkmal.functions.text import german_decimals

# Fixed value: a key of 2 to 60 and a value of 1 to 100 characters between separators.
PAIR = r"(?U)([^·•<>\n]{2,60}?)\s*:\s*([^·•<>\n]{1,100})"


def pairs(description: Column) -> Column:
    """Array of (key, value) in text order."""
    keys = F.regexp_extract_all(description, F.lit(PAIR), F.lit(1))
    values = F.regexp_extract_all(description, F.lit(PAIR), F.lit(2))
    return F.arrays_zip(keys.alias("key"), values.alias("value"))


def clean_key(key: Column) -> Column:
    return F.lower(strip(F.ltrim(strip(key), F.lit("- "))))


def clean_value(value: Column) -> Column:
    return german_decimals(F.rtrim(strip(value), F.lit(".")))


def clean_pairs(description: Column) -> Column:
    """Array of (key, value) in text order, both cleaned."""
    return F.transform(
        pairs(description), lambda p: F.struct(clean_key(p["key"]).alias("key"), clean_value(p["value"]).alias("value"))
    )
