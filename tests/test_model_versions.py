"""A model write that fails leaves the last committed model readable."""

import pytest
from pyspark.sql import functions as F

from merkmal.operators.textmodel import MODEL_SCHEMA
from merkmal.session import scratch_path
from merkmal.sources import catalog


def model(spark, weight):
    rows = [("word", "plain", "F", None, None, [0.0, weight], ["a", "b"]), ("word", "plain", "F", "rot", 1.0, [0.0, weight], None)]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def weights(spark, path):
    return sorted(r["weights"][1] for r in catalog.read_model_table(spark, path).collect())


def test_failed_write_keeps_the_old_model(spark):
    path = scratch_path(spark, "versions")
    assert catalog.committed_versions(spark, path) == []
    assert catalog.write_model(model(spark, 1.0), path) == 1
    broken = model(spark, 2.0).withColumn("idf", F.when(F.col("term").isNotNull(), F.raise_error(F.lit("lost executor"))).otherwise(F.col("idf")))
    with pytest.raises(Exception):
        catalog.write_model(broken, path)
    assert catalog.committed_versions(spark, path) == [1]
    assert weights(spark, path) == [1.0, 1.0]
    assert catalog.write_model(model(spark, 3.0), path) == 2
    assert weights(spark, path) == [3.0, 3.0]
