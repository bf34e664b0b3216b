"""From raw documents to packed batches: toxicity, near copies, repeated substrings, benchmark passages, packing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from merkmal.llm.common import read_table
from merkmal.llm.decontaminate import contamination
from merkmal.llm.packing import pack, with_token_count
from merkmal.llm.shingle_join import linked_components
from merkmal.llm.substrings import without_repeats
from merkmal.llm.toxicity import not_toxic
from merkmal.session import cut_lineage, scratch_path

ROW = "_row"
FILE_BITS = 36


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own per row, the same whenever the table is read.

    Of stored tables it is the place in the file, with the number of the file from a checkpoint, so texts are not written again; other tables are checkpointed whole.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        return cut_lineage(docs.withColumn(ROW, F.monotonically_increasing_id()))
    files = placed.select("_path").distinct().coalesce(1)  # a line per file
    files = cut_lineage(files.select("_path", F.monotonically_increasing_id().alias("_file")))
    number = F.shiftleft("_file", FILE_BITS) + F.col("_place")
    return placed.join(F.broadcast(files), "_path").select(*docs.columns, number.alias(ROW))


def _as_documents(rows: DataFrame) -> DataFrame:
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; labels of held-out rows are not used."""
    return not_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id, rows without id last; the first of equal rows.

    Every row is a document of its own here, whatever its id. Rows without words stay.
    """
    rows = numbered(docs)
    parts = linked_components(_as_documents(rows)).select(F.col("doc_id").alias(ROW), "component_id")
    copies = cut_lineage(parts.filter(f"{ROW} <> component_id"))
    groups = copies.union(copies.select(F.col("component_id").alias(ROW), "component_id").distinct()).join(rows.select(ROW, "doc_id"), ROW)
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", ROW))[ROW].alias(ROW))
    gone = groups.select(ROW).join(first, ROW, "left_anti")
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller id has too; what loses all its words goes.

    A text that loses nothing stays as it is, others become their kept words joined by spaces.
    """
    cut = without_repeats(docs, docs.columns).filter("n_removed = 0 or kept <> ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of a benchmark item, each judged by its own text."""
    rows = numbered(docs)
    hit = contamination(_as_documents(rows), read_table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias(ROW))
    return rows.join(hit, ROW, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their length bucket, batch and slot."""
    return pack(with_token_count(docs, "_length"), F.col("_length"), ["doc_id", "text"]).drop("_length")


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("repeated_substrings", repeated_substrings),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]

#: Toxicity scores and optimal buckets have no SQL form. tests/llm/test_pipeline.py holds near_copies and benchmark_passages
#: against brute force; toxicity, repeated_substrings and packing are tested through their operators only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
