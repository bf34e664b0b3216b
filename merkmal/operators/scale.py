"""Helpers that keep joins and rankings safe when data grows or keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from merkmal.session import cut_lineage

#: A table up to this many rows is sent to all executors; the rows joined are the same beyond it.
BROADCAST_ROWS = 20_000


def sent_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint where it is small, for joins whose keys few rows share out badly.

    The hint stays through selections, explodes and aggregates. Left to adaptive execution, the large side
    may be shuffled on the few keys before the small side's size is known.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Row with the lowest ``order`` per key.

    An aggregate with map-side combine instead of a window, so a hot key is
    reduced inside every input partition before it is shuffled.
    """
    best = F.min_by(F.struct(*columns), F.struct(*order)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], spread: list[str], k: int,
                  slices: int = 64, rank: str = "rank") -> DataFrame:
    """The ``k`` lowest rows per group, ranked from 1.

    Each group is first ranked inside ``slices`` hash slices of ``spread``; only
    the ``k`` best of a slice reach the final ranking. The result is exact and
    no task sees more than ``slices * k`` rows of a group at the end.
    """
    slice_no = F.pmod(F.xxhash64(*spread), F.lit(slices))
    within = Window.partitionBy(*keys, "slice_no").orderBy(*order)
    overall = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("slice_no", slice_no)
        .withColumn(rank, F.row_number().over(within))
        .filter(F.col(rank) <= k)
        .drop("slice_no")
        .withColumn(rank, F.row_number().over(overall))
        .filter(F.col(rank) <= k)
    )


def global_rank(df: DataFrame, order: list[str], rank: str = "position") -> DataFrame:
    """Number all rows from 1 in the given order without a single-task window.

    Rows are range-partitioned and sorted; the number inside a partition comes
    from ``monotonically_increasing_id``. The sorted table is checkpointed, so
    the partition sizes added in front belong to exactly these partitions. The
    offsets table has one row per partition.
    """
    sorted_rows = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    numbered = cut_lineage(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_offset") + local + 1)
        .drop("_part", "_id", "_offset")
    )


def rank_within(df: DataFrame, keys: list[str], order: list[str], rank: str = "position") -> DataFrame:
    """Number rows from 1 inside each key; a hot key is spread over many tasks."""
    ranked = global_rank(df, [*keys, *order], "_global")
    starts = ranked.groupBy(*keys).agg(F.min("_global").alias("_start"))
    return (
        ranked.join(starts, keys)
        .withColumn(rank, F.col("_global") - F.col("_start") + 1)
        .drop("_global", "_start")
    )


def group_tasks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Shuffle by the group keys into the configured number of partitions.

    Adaptive execution merges partitions by bytes, which would pack groups that
    are small but costly to compute into few tasks; an explicit number is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def sharded(df: DataFrame, keys: list[str], row_key: list[str], rows_per_shard: int) -> DataFrame:
    """Add ``shard``: each key's rows are hashed into pieces of bounded expected size."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(rows_per_shard)).alias("n_shards"))
    return df.join(sizes, keys).withColumn(
        "shard", F.pmod(F.xxhash64(*row_key), F.col("n_shards")).cast("int")
    )
