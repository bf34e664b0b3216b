"""Catalog tables on shared storage: readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

PRODUCTS = "uid bigint, category string, title string, description string"
LABELS = "uid bigint, feature_name string, feature_value string, feature_type string"
TAXONOMY = "category string, feature_name string, feature_type string, aggregated_feature_values string"
SPLITS = ("train", "val", "test")


def _path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def read_split(spark: SparkSession, root: str, split: str) -> tuple[DataFrame, DataFrame | None]:
    """Products of a split, and its labels except for the test split."""
    if split not in SPLITS:
        raise ValueError(f"Unknown split: {split}")
    products = spark.read.schema(PRODUCTS).parquet(_path(root, split, "products.parquet"))
    if split == "test":
        return products, None
    return products, spark.read.schema(LABELS).parquet(_path(root, split, "product_features.parquet"))


def _with_position(df: DataFrame, name: str) -> DataFrame:
    """Row order of the stored file, unless the table brings its own column.

    File name and row index order rows across the files of one table: writers name
    files by part number.
    """
    if name in df.columns:
        return df
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.withColumn(name, place)


def read_taxonomy(spark: SparkSession, root: str) -> DataFrame:
    """Taxonomy rows with ``row_pos``; it only has to be ordered, not consecutive."""
    return _with_position(spark.read.parquet(_path(root, "taxonomy", "taxonomy.parquet")), "row_pos")


def read_template(spark: SparkSession, root: str) -> DataFrame:
    """Rows to predict with ``template_pos``, the order in which they are written again."""
    return _with_position(spark.read.parquet(_path(root, "test", "submission.parquet")), "template_pos")


def work_rows(keys: DataFrame, products: DataFrame) -> DataFrame:
    """Labels or template rows with the text of their product.

    Both sides grow with the catalog, and texts made by expressions are larger than Spark expects from the
    files, so neither is ever broadcast.
    """
    return keys.join(products.select("uid", "category", "title", "description").hint("merge"), "uid")


def trial_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by key for a trial run; all rows without a limit."""
    return rows if limit is None else rows.orderBy("uid", "feature_name").limit(limit)


def labelled_output(predictions: DataFrame) -> DataFrame:
    """Output columns of a train or validation run; open rows become empty text."""
    return predictions.select("uid", "feature_name", F.coalesce("predicted_value", F.lit("")).alias("feature_value"), "feature_type")


def filled_template(template: DataFrame, predictions: DataFrame, order: str = "template_pos") -> DataFrame:
    """Template with the first prediction per key; keys without one become empty text."""
    first = predictions.groupBy("uid", "feature_name").agg(
        F.min_by(F.struct("predicted_value"), F.col(order)).alias("first")
    )
    return template.join(first, ["uid", "feature_name"], "left").select(
        "uid", "feature_name", F.coalesce("first.predicted_value", F.lit("")).alias("feature_value"), "feature_type", order
    )


def write_labelled(predictions: DataFrame, path: str) -> None:
    labelled_output(predictions).write.mode("overwrite").parquet(path)


def write_filled_template(template: DataFrame, predictions: DataFrame, path: str, order: str = "template_pos") -> None:
    """Written in template order: range-partitioned by position, sorted in each file."""
    filled_template(template, predictions, order).orderBy(order).drop(order).write.mode("overwrite").parquet(path)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of ``path`` whose pointer row was written; a failed write leaves none."""
    try:
        rows = spark.read.schema("version int").parquet(f"{path}/_committed").select("version").distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # nothing committed yet
    return sorted(r["version"] for r in rows)


def write_model(model: DataFrame, path: str) -> int:
    """Write the model as a new version beside the old ones, then commit it by a one-row pointer.

    Readers take the newest committed version, so a job lost while writing leaves the last model readable;
    the half-written folder of the lost version is never read and is overwritten by the next attempt.
    """
    spark = model.sparkSession
    version = max(committed_versions(spark, path), default=0) + 1
    model.write.mode("overwrite").partitionBy("model").parquet(f"{path}/version={version}")
    spark.createDataFrame([(version,)], "version int").write.mode("overwrite").parquet(f"{path}/_committed/version={version}")
    return version


def read_model_table(spark: SparkSession, path: str) -> DataFrame:
    from merkmal.operators.textmodel import MODEL_SCHEMA

    names = [part.split()[0] for part in MODEL_SCHEMA.split(", ")]
    versions = committed_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed model below {path}")
    return spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/version={versions[-1]}").select(*names)


