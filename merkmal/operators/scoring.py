"""Exact-match scoring and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from merkmal.operators.complete import apply_fallbacks, validate


def is_correct(prediction: Column | str = "predicted_value", truth: Column | str = "feature_value") -> Column:
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    truth = F.col(truth) if isinstance(truth, str) else truth
    return F.coalesce(prediction == truth, F.lit(False)).cast("double")


def match_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Inner join on (uid, feature_name) with ``correct``; duplicates multiply.

    Predictions and truth both grow with the catalog: here and below neither is broadcast.
    """
    left = predictions.select("uid", "feature_name", "predicted_value")
    right = truth.select("uid", "feature_name", "feature_value").hint("merge")
    return left.join(right, ["uid", "feature_name"]).withColumn("correct", is_correct())


def accuracy(matched: DataFrame) -> DataFrame:
    return matched.agg(F.avg("correct").alias("accuracy"), F.count("*").alias("n"))


def accuracy_by_feature(matched: DataFrame) -> DataFrame:
    return matched.groupBy("feature_name").agg(F.avg("correct").alias("accuracy"), F.count("*").alias("n"))


def accuracy_by_type(matched: DataFrame, predictions: DataFrame) -> DataFrame:
    types = predictions.select("uid", "feature_name", "feature_type").dropDuplicates()
    typed = matched.join(types.hint("merge"), ["uid", "feature_name"])
    return typed.groupBy("feature_type").agg(F.avg("correct").alias("accuracy"), F.count("*").alias("n"))


def worst_features(by_feature: DataFrame, n: int = 15) -> DataFrame:
    return by_feature.orderBy("accuracy", "feature_name").limit(n)


def best_features(by_feature: DataFrame, n: int = 10) -> DataFrame:
    return by_feature.orderBy(F.desc("accuracy"), F.desc("feature_name")).limit(n)


def evaluate(predictions: DataFrame, truth: DataFrame, worst: int = 15, best: int = 10) -> DataFrame:
    """Overall, by type, by feature, worst and best as (metric, key, accuracy, n).

    Predictions meet the truth once and are reduced once to one line per (type,
    feature). Each line feeds three sums; worst and best are ranks of the feature sums.
    """
    left = predictions.select("uid", "feature_name", "feature_type", "predicted_value")
    matched = left.join(truth.select("uid", "feature_name", "feature_value").hint("merge"), ["uid", "feature_name"])
    lines = matched.groupBy("feature_type", "feature_name").agg(F.sum(is_correct()).alias("hits"), F.count("*").alias("n"))
    entry = lambda metric, key: F.struct(F.lit(metric).alias("metric"), key.alias("key"))
    goals = F.array(entry("overall", F.lit("all")), entry("type", F.col("feature_type")), entry("feature", F.col("feature_name")))
    sums = lines.select(F.explode(goals).alias("goal"), "hits", "n").groupBy("goal.metric", "goal.key").agg(
        (F.sum("hits") / F.sum("n")).alias("accuracy"), F.sum("n").alias("n")
    )
    # One line per feature is ranked, not the rows behind it.
    place = lambda *order: F.row_number().over(Window.partitionBy("metric").orderBy(*order))
    ranked = sums.withColumn("_worst", place("accuracy", "key")).withColumn("_best", place(F.desc("accuracy"), F.desc("key")))
    is_feature = F.col("metric") == "feature"
    metrics = F.array_compact(F.array(
        F.col("metric"),
        F.when(is_feature & (F.col("_worst") <= worst), F.lit("worst")),
        F.when(is_feature & (F.col("_best") <= best), F.lit("best")),
    ))
    return ranked.select(F.explode(metrics).alias("metric"), "key", "accuracy", "n")


def coverage(predictions: DataFrame) -> DataFrame:
    """Share of rows with a prediction."""
    return predictions.agg(
        F.avg(F.col("predicted_value").isNotNull().cast("double")).alias("coverage"), F.count("*").alias("n")
    )


def layer_contribution(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Rows and accuracy per layer."""
    rows = predictions.select("uid", "feature_name", "predicted_value", "layer")
    matched = rows.join(truth.select("uid", "feature_name", "feature_value").hint("merge"), ["uid", "feature_name"])
    return matched.groupBy("layer").agg(F.count("*").alias("n"), F.avg(is_correct()).alias("accuracy"))


def run_counts(predicted: DataFrame, slots: DataFrame, mode: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Open rows before and after the fallback, corrected rows, empty outputs, in one pass over the predictions."""
    marked = predicted.withColumn("_before", F.col("predicted_value").isNull())
    after = apply_fallbacks(marked, slots, mode).withColumn("_after", F.col("predicted_value").isNull())
    done = validate(after, slots, fuzzy)
    counts = {
        "open_before_fallback": F.col("_before"),
        "open_after_fallback": F.col("_after"),
        "corrected": F.col("corrected"),
        "empty_output": F.coalesce("predicted_value", F.lit("")) == "",
    }
    row = done.agg(*[F.count_if(c).alias(name) for name, c in counts.items()])
    return row.unpivot([], list(counts), "metric", "n")


def submission_check(template: DataFrame, submission: DataFrame) -> DataFrame:
    """Problems of a submission: missing columns, missing, extra and repeated keys.

    One full outer join of the key counts of both sides.
    """
    required = ["uid", "feature_name", "feature_value", "feature_type"]
    missing = [c for c in required if c not in submission.columns]
    keys = ["uid", "feature_name"]
    spark = template.sparkSession
    columns = spark.createDataFrame([("missing_columns", len(missing))], "problem string, n bigint")
    if any(k in missing for k in keys):
        return columns
    wanted = template.groupBy(*keys).agg(F.count("*").alias("wanted"))
    given = submission.groupBy(*keys).agg(F.count("*").alias("given"))
    both = wanted.join(given, keys, "full_outer").select(F.coalesce("wanted", F.lit(0)).alias("w"), F.coalesce("given", F.lit(0)).alias("g"))
    counts = both.agg(
        F.count_if((F.col("w") > 0) & (F.col("g") == 0)).alias("missing_keys"),
        F.count_if((F.col("w") == 0) & (F.col("g") > 0)).alias("unknown_keys"),
        F.count_if((F.col("g") > F.col("w")) & (F.col("w") > 0)).alias("repeated_keys"),
    )
    rows = counts.select(F.explode(F.create_map(
        F.lit("missing_keys"), "missing_keys", F.lit("unknown_keys"), "unknown_keys", F.lit("repeated_keys"), "repeated_keys",
    )).alias("problem", "n"))
    return columns.unionByName(rows)
