"""The job from storage to storage: read a split, learn, predict, write, score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merkmal.operators.scoring import evaluate, submission_check
from merkmal.plans.predict import learn, predict
from merkmal.session import cut_lineage
from merkmal.sources import catalog


def stored_model(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Model table below ``path``; None where nothing is stored, so that a run goes on without models."""
    if path is None:
        return None
    if not catalog.committed_versions(spark, path):
        return None
    return catalog.read_model_table(spark, path)


def train(spark: SparkSession, root: str, model_path: str, **fit_options) -> None:
    """Fit both text models on the training split and store them by model."""
    products, labels = catalog.read_split(spark, root, "train")
    knowledge = learn(catalog.read_taxonomy(spark, root), products, labels, models=True, **fit_options)
    catalog.write_model(knowledge.model, model_path)


def run(spark: SparkSession, root: str, split: str, out: str, limit: int | None = None,
        model_path: str | None = None, **options) -> DataFrame:
    """Predictions for a split, written to ``out``; returns its scores, or the problems of a filled template.

    The test split fills the stored template in its order, other splits get one row per label.
    With ``limit`` only the first rows by key are predicted.
    """
    products, truth = catalog.read_split(spark, root, split)
    known_products, known_labels = catalog.read_split(spark, root, "train")
    knowledge = learn(catalog.read_taxonomy(spark, root), known_products, known_labels)
    knowledge.model = stored_model(spark, model_path)
    template = catalog.read_template(spark, root) if truth is None else None
    keys = template.drop("feature_value") if truth is None else truth.select("uid", "feature_name", "feature_type")
    rows = catalog.trial_rows(catalog.work_rows(keys, products), limit)
    predictions = cut_lineage(predict(rows, knowledge, **options))
    if truth is None:
        catalog.write_filled_template(template, predictions, out)
        return submission_check(template, spark.read.parquet(out))
    catalog.write_labelled(predictions, out)
    return evaluate(predictions, truth)
