"""Matching by vector similarity inside a slot."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from merkmal.functions.patterns import once
from merkmal.functions.text import blank_if_null, substrings
from merkmal.operators.scale import best_per_key, group_tasks

SEMANTIC_THRESHOLD = 0.72
BLOCK = 2048


def normalised(vector: Column) -> Column:
    """Vector of length one; a zero vector stays zero."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    scaled = lambda v: once(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))
    return once(wide, scaled)


def _blocks(df: DataFrame, slot: list[str], row_key: str, name: str, size: int) -> DataFrame:
    counts = df.groupBy(*slot).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias(f"n_{name}"))
    return df.join(counts, slot).withColumn(name, F.pmod(F.xxhash64(row_key), F.col(f"n_{name}")).cast("int"))


def _copied(df: DataFrame, counts: DataFrame, slot: list[str], name: str) -> DataFrame:
    spread = F.explode(F.sequence(F.lit(0), F.col(f"n_{name}") - 1)).alias(name)
    return df.join(counts, slot).select(
        *[F.col(c).alias(c) for c in df.columns], spread
    )


def best_in_slot(texts: DataFrame, values: DataFrame, slot: list[str], threshold: float = SEMANTIC_THRESHOLD,
                 key: str = "uid", block: int = BLOCK) -> DataFrame:
    """Closest value of the slot per text: (slot, key, value, similarity).

    ``texts`` are (slot, key, vec), ``values`` are (slot, value, vec). Texts and
    values of a slot are hashed into blocks, each pair of blocks is one matrix
    product in one task, and the best of every block goes into an aggregate. No
    pair is written out and no slot is held whole. Below the threshold the value
    is null and the similarity is kept; a text whose slot has no values has 0.
    """
    t = _blocks(texts, slot, key, "text_block", block)
    v = _blocks(values.select(*slot, "value", "vec"), slot, "value", "value_block", block)
    t_count = t.groupBy(*slot).agg(F.max("n_text_block").alias("n_text_block"))
    v_count = v.groupBy(*slot).agg(F.max("n_value_block").alias("n_value_block"))
    left = _copied(t.drop("n_text_block"), v_count, slot, "value_block")
    right = _copied(v.drop("n_value_block"), t_count, slot, "text_block")

    def run(block_key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in [*slot, key, "value", "similarity"]})
        b = b.sort_values("value")
        x = np.array(a["vec"].tolist(), dtype=float)
        y = np.array(b["vec"].tolist(), dtype=float)
        unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) > 0, n, 1)
        product = unit(x) @ unit(y).T
        best = product.round(9).argmax(axis=1)  # equal up to rounding: the first value wins
        out = a[[*slot, key]].copy()
        out["value"] = b["value"].to_numpy()[best]
        out["similarity"] = product[np.arange(len(a)), best]
        return out

    types = {f.name: f.dataType.simpleString() for f in [*texts.schema, *values.schema]}
    schema = ", ".join(f"{c} {types[c]}" for c in [*slot, key, "value"]) + ", similarity double"
    keys = [*slot, "text_block", "value_block"]
    texts_side, values_side = group_tasks(left, keys), group_tasks(right, keys)
    per_block = texts_side.groupBy(*keys).cogroup(values_side.groupBy(*keys)).applyInPandas(run, schema)
    best = best_per_key(per_block, [*slot, key], [-F.round("similarity", 9), F.col("value")], ["value", "similarity"])
    found = texts.select(*slot, key).join(best, [*slot, key], "left")
    return found.withColumn("similarity", F.coalesce("similarity", F.lit(0.0))).withColumn(
        "value", F.when(F.col("similarity") >= threshold, F.col("value"))
    )


def trigram_vector(text: Column, dim: int = 64) -> Column:
    """Counts of character trigrams in ``dim`` buckets; stands in for an encoder
    when no vector table is given."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    code = lambda gram, i: F.ascii(F.substring(gram, i, 1))
    buckets = F.transform(
        substrings(padded, 3), lambda g: F.pmod(code(g, 1) * 31 * 31 + code(g, 2) * 31 + code(g, 3), F.lit(dim))
    )
    counts = lambda found: F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: F.size(F.filter(found, lambda b: b == d)).cast("double")
    )
    return once(buckets, counts)


def semantic_layer(rows: DataFrame, slots: DataFrame, threshold: float = SEMANTIC_THRESHOLD,
                   text_vectors: DataFrame | None = None, value_vectors: DataFrame | None = None) -> DataFrame:
    """Open rows take the closest value of their slot to the title.

    ``text_vectors`` are (title, vec) and ``value_vectors`` (value, vec); without
    them trigram vectors are used. Only distinct (slot, title) pairs of open rows
    are compared; the answers are joined back.
    """
    slot = ["category", "feature_name"]
    ask = rows.filter("predicted_value is null").select(*slot, blank_if_null("title").alias("title")).distinct()
    listed = slots.select(*slot, F.explode("allowed").alias("value"))
    texts = ask.join(text_vectors, "title") if text_vectors is not None else ask.withColumn("vec", trigram_vector(F.col("title")))
    values = listed.join(value_vectors, "value") if value_vectors is not None else listed.withColumn("vec", trigram_vector(F.col("value")))
    found = best_in_slot(texts, values, slot, threshold, key="title").filter("value is not null")
    answer = found.select(*slot, F.col("title").alias("_title"), F.col("value").alias("_value"), F.col("similarity").alias("_similarity"))
    on = [F.col(f"r.{c}") == F.col(f"a.{c}") for c in slot] + [
        blank_if_null(F.col("r.title")) == F.col("a._title"),
        F.col("r.predicted_value").isNull(),
    ]
    joined = rows.alias("r").join(answer.alias("a"), on, "left")
    hit = F.col("a._value").isNotNull()
    replaced = {
        "predicted_value": F.coalesce("r.predicted_value", "a._value"),
        "confidence": F.when(hit, F.col("a._similarity")).otherwise(F.col("r.confidence")),
        "layer": F.when(hit, F.lit("semantic")).otherwise(F.col("r.layer")),
    }
    return joined.select(*[replaced.get(c, F.col(f"r.{c}")).alias(c) for c in rows.columns])
