"""Closest listed value by edit similarity, as a column: nothing is shuffled and no Python runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def edit_similarity(a: Column, b: Column) -> Column:
    """One minus edit distance over the longer length; two empty words are equal."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer > 0, 1 - F.levenshtein(a, b) / longer).otherwise(F.lit(1.0))


def closest_entry(word: Column, candidates: Column, cutoff: float) -> Column:
    """``(s, v)`` of the candidate with the highest similarity ``s`` at or over the cutoff.

    Ties go to the value last in binary order; null when the word is null or nothing is
    close enough. Lengths alone bound the similarity, so few candidates are compared.
    """
    length = F.length(word)
    reachable = F.filter(
        candidates, lambda c: F.least(F.length(c), length) >= F.lit(cutoff) * F.greatest(F.length(c), length)
    )
    scored = F.filter(
        F.transform(reachable, lambda c: F.struct(edit_similarity(word, c).alias("s"), c.alias("v"))),
        lambda e: e["s"] >= cutoff,
    )
    return F.array_max(scored)


def closest_listed(word: Column, candidates: Column, cutoff: float) -> Column:
    return closest_entry(word, candidates, cutoff)["v"]


def closest_by_edits(rows: DataFrame, value: str, cutoff: float, out: str = "closest") -> DataFrame:
    """Adds the closest of ``allowed`` to column ``value``, and its similarity."""
    best = closest_entry(F.col(value), F.col("allowed"), cutoff)
    return rows.withColumn(out, best["v"]).withColumn("similarity", best["s"])
