"""Length buckets by dynamic programming over the global histogram, and token-budget batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from merkmal.llm.common import WHITE_SPACE, in_cells, read_table, small_batches, split_words
from merkmal.session import cut_lineage

BUCKETS = 16
BATCH_TOKENS = 65_536
CELLS = 512


def token_count(text: Column) -> Column:
    """Words between white space; a null or empty text has none."""
    return F.size(split_words(F.coalesce(text, F.lit("")), WHITE_SPACE)).cast("long")


def with_token_count(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the number of words as a column of its own.

    For tables that are too wide to checkpoint: the optimizer cannot copy this count into every expression that uses it.
    """

    def run(batches):
        for batch in small_batches(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield batch.append_column(column, pa.array([len(t.split()) if t else 0 for t in texts], pa.int64()))

    docs = docs.drop(column)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def best_boundaries(lengths: list[int], counts: list[int], tokens: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding over the histogram.

    cost(i, j) = lengths[j] * rows(i..j) - tokens(i..j); best[k][j] = min_i best[k-1][i] + cost(i+1, j).
    The best i never falls as j grows, so each bucket is solved by halving: n log n steps, in whole numbers.
    """
    n = len(lengths)
    if n == 0:
        return []
    length = np.array(lengths, dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
    held = np.concatenate([[0], np.cumsum(np.array(tokens, dtype=np.int64))])
    best = np.concatenate([[0], length * rows[1:] - held[1:]])
    choices = [np.zeros(n + 1, dtype=np.int64)]
    for _ in range(min(buckets, n) - 1):
        nxt, choice = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        open_ = [(1, n, 0, n - 1)]
        while open_:
            first, last, low, high = open_.pop()
            j = (first + last) // 2
            end = min(high, j - 1) + 1
            cost = best[low:end] + length[j - 1] * (rows[j] - rows[low:end]) - (held[j] - held[low:end])
            choice[j] = low + int(np.argmin(cost))
            nxt[j] = cost[choice[j] - low]
            if first < j:
                open_.append((first, j - 1, low, int(choice[j])))
            if j < last:
                open_.append((j + 1, last, int(choice[j]), high))
        choices.append(choice)
        best = nxt
    bounds, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return sorted(set(bounds))


def pack(docs: DataFrame, length: Column, order: list[str], buckets: int = BUCKETS, budget: int = BATCH_TOKENS,
         cells: int = CELLS) -> DataFrame:
    """All rows with n_tokens, bucket, bucket_tokens, batch, slot and padding.

    The histogram covers all rows and holds every length as it is. A batch holds rows of one bucket, at most
    ``budget // bucket_tokens`` of them and at least one, so only a single row
    longer than the budget exceeds it. Inside a bucket rows are ordered by hash
    cell, then ``order``; ranks run in ``buckets * cells`` cells, never in a whole bucket.
    """
    names = ["n_tokens", "bucket", "bucket_tokens", "batch", "slot", "padding"]
    docs = docs.drop(*[n for n in names if n in docs.columns])
    counted = docs.withColumn("n_tokens", length)
    histogram = counted.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow().sort_by("n_tokens")  # a line per distinct length
    lengths, counts = (histogram.column(c).to_numpy() for c in ("n_tokens", "n"))
    bounds = best_boundaries(lengths, counts, lengths * counts, buckets)
    bounds = bounds or [0]
    limits = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(limits, lambda b: b < F.col("n_tokens")))
    spread = F.pmod(F.xxhash64(*order), F.lit(cells))
    placed = counted.withColumn("bucket", bucket).withColumn("bucket_tokens", F.element_at(limits, F.col("bucket") + 1))
    placed = placed.withColumn("_cell", (F.col("bucket") * cells + spread).cast("int"))
    sizes = cut_lineage(placed.groupBy("_cell", "bucket").agg(F.count("*").alias("n")))
    before = Window.partitionBy("bucket").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = in_cells(placed, "_cell", [F.col(c) for c in order], offsets, "_position").drop("_cell")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_tokens"), F.lit(1)))).cast("long")
    return (
        ranked.withColumn("batch", F.floor(F.col("_position") / capacity).cast("long"))
        .withColumn("slot", (F.col("_position") % capacity).cast("int"))
        .withColumn("padding", F.col("bucket_tokens") - F.col("n_tokens"))
        .drop("_position")
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document.

    Rows keep null ids; null and empty texts have no tokens and fall into the
    first bucket; equal rows take different slots; an empty table gives no rows.
    """
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", token_count(F.col("text")).alias("_length"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("_crc")
    )
    docs = cut_lineage(docs)  # three narrow columns, so that texts are split once
    return pack(docs, F.col("_length"), ["doc_id", "_crc"]).drop("_length", "_crc")
