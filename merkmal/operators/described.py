"""Key-value pairs in descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.functions.patterns import exact, first_group, once, strip
from merkmal.functions.text import blank_if_null, german_decimals
from merkmal.operators.fuzzy import closest_listed
from merkmal.operators.pairs import clean_key, clean_pairs, clean_value, pairs
from merkmal.operators.prepare import has_texts, if_allowed

FUZZY_CUTOFF = 0.85


def names_feature(key: Column) -> Column:
    """Key and one of the feature's names contain one another, both three or longer."""
    return F.exists(
        "terms",
        lambda t: (F.length(t) >= 3) & (F.length(key) >= 3) & (key.contains(t) | t.contains(key)),
    )


def listed_number(value: Column) -> Column:
    """Number and unit at the start of the value, when listed."""
    joined = exact(r"^([\d.]+)\s*(\S+)")

    def answer(clean: Column) -> Column:
        spaced = first_group(clean, exact(r"^([\d.]+\s+\S+)"))
        rebuilt = F.concat(first_group(clean, joined), F.lit(" "), F.regexp_extract(clean, joined, 2))
        return F.coalesce(if_allowed(clean), if_allowed(spaced), if_allowed(rebuilt))

    return once(german_decimals(strip(value)), answer)


def any_case_listed(value: Column) -> Column:
    same = once(F.lower(value), lambda low: F.filter("entries", lambda e: e["lower"] == low))
    return F.array_min(F.transform(same, lambda e: e["value"]))


def longest_inside(value: Column) -> Column:
    found = once(F.lower(value), lambda low: F.filter("entries", lambda e: low.contains(e["lower"])))
    return F.get(found, F.lit(0))["value"]


def named_values(known: bool) -> Column:
    """Values of the description's pairs that name the row's feature, in text order; ``known``: ``clean_pairs`` is a column."""
    if known:
        return F.transform(F.filter("clean_pairs", lambda p: names_feature(p["key"])), lambda p: p["value"])
    keyed = F.transform(
        pairs(blank_if_null("description")), lambda p: F.struct(clean_key(p["key"]).alias("key"), p["value"].alias("value"))
    )
    return F.transform(F.filter(keyed, lambda p: names_feature(p["key"])), lambda p: clean_value(p["value"]))


def described_value(known: bool, fuzzy: bool = True) -> Column:
    """What the first pair naming the feature that yields a value yields.

    Only rows with a colon in the description and a non-empty slot are looked at. Ways to read a value are tried
    in order, each only where the ones before it fail.
    """

    def answer(value: Column) -> Column:
        return F.coalesce(
            if_allowed(value),
            F.when(F.col("feature_type") == "numeric", listed_number(value)),
            any_case_listed(value),
            *([closest_listed(value, F.col("allowed"), FUZZY_CUTOFF)] if fuzzy else []),
            longest_inside(value),
        )

    wanted = F.col("description").contains(":") & (F.size("allowed") > 0)
    found = F.filter(F.transform(named_values(known), answer), lambda v: v.isNotNull())
    return F.when(wanted, F.get(found, F.lit(0)))


def add_described(rows: DataFrame, out: str, fuzzy: bool = True) -> DataFrame:
    """Add column ``out``: the described value of rows that come from ``prepare``.

    Everything is done inside the row, so nothing is shuffled.
    """
    return rows.withColumn(out, described_value(has_texts(rows), fuzzy))


def key_profile(products: DataFrame) -> DataFrame:
    """How often each key occurs in descriptions of the catalog."""
    rows = products.filter(F.col("description").contains(":")).select(F.explode(pairs(F.col("description"))).alias("p"))
    return rows.groupBy(clean_key(F.col("p.key")).alias("key")).agg(F.count("*").alias("n"))
