"""Catalog profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from merkmal.functions.text import blank_if_null
from merkmal.operators.scale import global_rank, top_per_group


def union_all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; counting needs no column at all."""
    return union_all([
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
        for name, df in tables.items()
    ])


def column_types(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column its type and how many rows have a value."""
    def counted(name: str, df: DataFrame) -> DataFrame:
        row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        found = row.unpivot([], df.columns, "column_name", "n_values")
        kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
        return found.select(F.lit(name).alias("table_name"), "column_name", kinds[F.col("column_name")].alias("data_type"), "n_values")

    return union_all([counted(name, df) for name, df in tables.items()])


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def distinct_categories(products: DataFrame, taxonomy: DataFrame) -> DataFrame:
    n = lambda df, name: df.agg(F.count_distinct("category").alias("n_categories")).select(F.lit(name).alias("source"), "n_categories")
    return n(products, "train").unionByName(n(taxonomy, "taxonomy"))


def top_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    return counts_by(df, key).orderBy(F.desc("n"), key).limit(k)


def size_buckets(products: DataFrame) -> DataFrame:
    """Number of categories per size bucket; upper ends belong to the bucket."""
    # Upper ends and names of the buckets.
    ends = [(1, "1"), (5, "2-5"), (10, "6-10"), (50, "11-50"), (100, "51-100"), (500, "101-500"), (1000, "501-1k")]
    bucket = F.lit(">1k")
    for end, name in reversed(ends):
        bucket = F.when(F.col("n") <= end, F.lit(name)).otherwise(bucket)
    return counts_by(products, "category").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_categories"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal bins from minimum to maximum; the last bin includes the maximum."""
    low, high = df.agg(F.min(value), F.max(value)).first()  # two numbers
    width = (high - low) / bins if low is not None and high > low else 1.0
    low = low if low is not None else 0
    number = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))
    return df.groupBy(number.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def category_size_histogram(products: DataFrame, bins: int = 80) -> DataFrame:
    return histogram(counts_by(products, "category"), "n", bins)


def shares(df: DataFrame, key: str) -> DataFrame:
    """Count and share per key; the window sees one row per key value of a type column."""
    counted = counts_by(df, key)
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def features_per_category(taxonomy: DataFrame) -> DataFrame:
    return counts_by(taxonomy, "category").groupBy(F.col("n").alias("n_features")).agg(F.count("*").alias("n_categories"))


def listed_counts(taxonomy: DataFrame) -> DataFrame:
    """Values per categorical slot, counted by their quoted brackets."""
    cell = F.coalesce("aggregated_feature_values", F.lit(""))
    quoted = F.regexp_extract_all(cell, F.lit(r"'\[.*?\]'"), F.lit(0))
    return taxonomy.filter("feature_type = 'categorical'").select("category", "feature_name", F.size(quoted).cast("bigint").alias("n_values"))


def spread_of(df: DataFrame, value: str, percents: dict[str, float]) -> DataFrame:
    """Mean, maximum and exact percentiles from counts per distinct value, so that
    the percentile works on few weighted numbers."""
    counted = df.groupBy(value).agg(F.count("*").alias("w"))
    return counted.agg(
        (F.sum(F.col(value) * F.col("w")) / F.sum("w")).alias("mean"),
        F.max(value).alias("max"),
        *[F.percentile(value, F.lit(p), F.col("w")).alias(name) for name, p in percents.items()],
    )


def listed_summary(taxonomy: DataFrame) -> DataFrame:
    return spread_of(listed_counts(taxonomy), "n_values", {"median": 0.5})


def listed_histogram(taxonomy: DataFrame, ceiling: int = 50) -> DataFrame:
    """Slots per number of values; larger numbers are counted at the ceiling."""
    return listed_counts(taxonomy).groupBy(F.least("n_values", F.lit(ceiling)).alias("n_values")).agg(F.count("*").alias("n_slots"))


def features_per_product(labels: DataFrame) -> DataFrame:
    return counts_by(labels, "uid").groupBy(F.col("n").alias("n_features")).agg(F.count("*").alias("n_products"))


def features_per_product_summary(labels: DataFrame) -> DataFrame:
    return spread_of(counts_by(labels, "uid").select("n"), "n", {"median": 0.5})


def top_values(labels: DataFrame, features: list[str], k: int = 10) -> DataFrame:
    """Most frequent values of each named feature."""
    counted = labels.filter(F.col("feature_name").isin(features) & (F.col("feature_type") == "categorical"))
    counted = counts_by(counted, "feature_name", "feature_value")
    return top_per_group(counted, ["feature_name"], [F.desc("n"), F.asc("feature_value")], ["feature_value"], k)


def text_lengths(products: DataFrame) -> DataFrame:
    """Length of title and description per product, as rows (part, length)."""
    part = lambda name: F.struct(F.lit(name).alias("part"), F.length(blank_if_null(name)).cast("bigint").alias("length"))
    return products.select(F.explode(F.array(part("title"), part("description"))).alias("p")).select("p.part", "p.length")


def text_length_summary(products: DataFrame) -> DataFrame:
    counted = text_lengths(products).groupBy("part", "length").agg(F.count("*").alias("w"))
    return counted.groupBy("part").agg(
        (F.sum(F.col("length") * F.col("w")) / F.sum("w")).alias("mean"),
        F.percentile("length", F.lit(0.5), F.col("w")).alias("median"),
        F.percentile("length", F.lit(0.99), F.col("w")).alias("p99"),
    )


def text_length_histogram(products: DataFrame, title_ceiling: int = 300, description_ceiling: int = 3000, bins: int = 60) -> DataFrame:
    """Counts in equal bins below a ceiling; longer texts are counted at the ceiling."""
    ceiling = F.when(F.col("part") == "title", F.lit(title_ceiling)).otherwise(F.lit(description_ceiling))
    counted = text_lengths(products).withColumn("length", F.least("length", ceiling)).groupBy("part", "length").agg(F.count("*").alias("w"))
    ends = Window.partitionBy("part")  # at most ceiling + 1 rows per part
    low, high = F.min("length").over(ends), F.max("length").over(ends)
    width = F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0))
    number = F.least(F.floor((F.col("length") - low) / width), F.lit(bins - 1)).cast("bigint")
    return counted.withColumn("bin", number).groupBy("part", "bin").agg(F.sum("w").alias("n"))


def seeded_sample(df: DataFrame, n: int = 50_000, seed: int = 42, key: str = "uid") -> DataFrame:
    """``n`` rows chosen by a seeded hash of their key: the same rows however the
    data is partitioned. Ranks come from range partitions, so no task merges all candidates."""
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    return global_rank(hashed, ["_hash", key], "_rank").filter(F.col("_rank") <= n).drop("_hash", "_rank")


def null_share(template: DataFrame) -> DataFrame:
    return template.agg(F.count_if(F.col("feature_value").isNull()).alias("n_null"), F.count("*").alias("n"))


def example_products(products: DataFrame, labels: DataFrame, at_least: int = 3, k: int = 3) -> DataFrame:
    """Products of lowest uid with enough labels, with their labels."""
    chosen = counts_by(labels, "uid").filter(F.col("n") >= at_least).orderBy("uid").limit(k).select("uid")
    keep = F.broadcast(chosen)  # k rows
    rows = labels.join(keep, "uid", "left_semi").select("uid", "feature_name", "feature_value", "feature_type")
    return rows.join(products.join(keep, "uid", "left_semi"), "uid")


