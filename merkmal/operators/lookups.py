"""Lookups learned from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.operators.scale import best_per_key


def labelled_products(labels: DataFrame, products: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Labels joined to their product on ``uid``; both sides grow with the catalog, so neither is broadcast."""
    side = products.select("uid", *columns) if columns else products
    return labels.join(side.hint("merge"), "uid")


def most_frequent(rows: DataFrame, keys: list[str], value: str = "feature_value") -> DataFrame:
    """Most frequent value per key; null values are not counted, equal counts go to the first in binary order."""
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n")).withColumnRenamed(value, "value")
    return best_per_key(counted, keys, [-F.col("n"), F.col("value")], ["value", "n"])


def title_lookup(labels: DataFrame, products: DataFrame) -> DataFrame:
    """(feature_name, title) to the value most often given to that title."""
    return most_frequent(labelled_products(labels, products, ["title"]), ["feature_name", "title"])


def feature_mode(labels: DataFrame) -> DataFrame:
    """Most frequent value of every feature."""
    return most_frequent(labels, ["feature_name"])


def add_candidate(rows: DataFrame, lookup: DataFrame, out: str) -> DataFrame:
    """Add the looked-up value of the row's (feature_name, title), whatever its slot lists.

    The lookup grows with the catalog; adaptive execution broadcasts it where it is small,
    otherwise both sides shuffle on (feature_name, title) and adaptive execution
    splits titles that hold many rows (the lookup has one row per key).
    """
    side = lookup.select("feature_name", "title", F.col("value").alias(out))
    return rows.join(side, ["feature_name", "title"], "left")


def values_by_title(lookup: DataFrame, out: str) -> DataFrame:
    """One row per title: feature to value. The lookup has one row per (feature_name, title)."""
    known = lookup.filter("feature_name is not null and title is not null")
    entries = F.collect_list(F.struct("feature_name", "value"))  # at most one per feature
    return known.groupBy("title").agg(F.map_from_entries(entries).alias(out))


def fitting(candidate: Column | str) -> Column:
    """The candidate when the slot is empty or lists it, else null."""
    candidate = F.col(candidate) if isinstance(candidate, str) else candidate
    return F.when((F.size("allowed") == 0) | F.array_contains("allowed", candidate), candidate)


def add_title_lookup(rows: DataFrame, lookup: DataFrame, out: str = "looked_up") -> DataFrame:
    """Add the looked-up value, kept when the slot is empty or lists it."""
    return add_candidate(rows, lookup, "_candidate").withColumn(out, fitting("_candidate")).drop("_candidate")
