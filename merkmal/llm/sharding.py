"""Sharding by fixed virtual slots and a stored, versioned slot-to-shard map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from merkmal.llm.common import in_cells, read_table
from merkmal.session import scratch_path

SLOTS = 8192
SHARDS = 16


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every row.

    The slot comes from id and text together, so rows that share an id (or have
    none) still spread. A null text has size 1 and the CRC of no bytes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot; at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def assigned(sizes: DataFrame, shards: int, loads=None) -> DataFrame:
    """``(virtual_slot, shard)``: slots from the largest to the smallest, each to the lightest shard.

    ``loads`` are bytes the shards hold already (a literal array column). The
    fold runs in one row over at most the fixed number of slots.
    """
    start = loads if loads is not None else F.array_repeat(F.lit(0).cast("long"), shards)
    order = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("neg"), F.col("virtual_slot").alias("slot"))))
    state = F.struct(start.alias("loads"), F.array().cast("array<int>").alias("shards"))

    def place(s, slot):
        lightest = F.array_position(s["loads"], F.array_min(s["loads"])).cast("int") - 1
        loads_after = F.transform(s["loads"], lambda x, i: F.when(i == lightest, x - slot["neg"]).otherwise(x))
        return F.struct(loads_after.alias("loads"), F.concat(s["shards"], F.array(lightest)).alias("shards"))

    folded = sizes.agg(order.alias("slots")).select(
        "slots", F.aggregate("slots", state, place, lambda s: s["shards"]).alias("shards")
    )
    pairs = folded.select(F.explode(F.arrays_zip("slots", "shards")).alias("p"))
    return pairs.select(F.col("p.slots.slot").alias("virtual_slot"), F.col("p.shards").alias("shard"))


def rebalanced(old: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """Edited map for ``shards`` shards: only slots above a shard's fair share move.

    Inside each shard slots stay, smallest first, while their bytes fit the fair
    share; the rest, and slots that the old map doesn't know, go to the lightest shards.
    """
    known = sizes.join(F.broadcast(old), "virtual_slot", "left")
    fair = F.ceil(F.sum("bytes").over(Window.partitionBy(F.lit(1))) / F.lit(shards))
    running = F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    marked = known.withColumn("fair", fair).withColumn(
        "stays", F.col("shard").isNotNull() & (F.col("shard") < shards) & (running <= F.col("fair"))
    )
    kept, moving = marked.filter("stays"), marked.filter("not stays")
    held = kept.groupBy("shard").agg(F.sum("bytes").alias("b"))
    loads = [0] * shards
    for row in held.collect():  # one row per shard
        loads[row["shard"]] = row["b"]
    start = F.array(*[F.lit(x).cast("long") for x in loads])
    return kept.select("virtual_slot", "shard").union(assigned(moving.select("virtual_slot", "bytes"), shards, start))


def save_map(slot_map: DataFrame, root: str, version: int) -> None:
    """Store one version of the map; a version is never overwritten."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{root}/version={version}")


def load_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{root}/version={version}")


def shard(rows: DataFrame, sizes: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every row and its gapless position inside the shard.

    Rows are ranked inside their virtual slot; the slots of a shard follow each
    other in slot order. Rows equal in id and text are interchangeable.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(F.broadcast(slot_map), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("offset")
    )
    return in_cells(rows, "virtual_slot", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], offsets, "slot")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes`` over all documents, 16 shards, map version 1.

    Null ids and texts are kept; empty tables give no rows; repeated rows are
    all placed; columns other than doc_id and text are not read.
    """
    rows = with_slots(read_table(spark, sf_dir, "documents"))
    root = scratch_path(spark, "slots")
    slot_sizes(rows).coalesce(1).write.parquet(f"{root}/sizes")
    sizes = spark.read.schema("virtual_slot int, bytes long, n_rows long").parquet(f"{root}/sizes")
    save_map(assigned(sizes, SHARDS), f"{root}/map", 1)
    placed = shard(rows, sizes, load_map(spark, f"{root}/map", 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
