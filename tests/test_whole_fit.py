"""The fit of a feature that no single task holds uses all its rows."""

from pyspark.sql import functions as F

from merkmal.operators import textmodel as T
from merkmal.plans.predict import learn


def rows(n):
    """Every row has a word of its own."""
    colours = ["rot", "blau", "grün"]
    return [(i, "Farbe", colours[i % 3], f"Stift wort{i:03d}", None) for i in range(n)]


def frame(spark, given):
    return spark.createDataFrame(given, "uid bigint, feature_name string, feature_value string, title string, description string").withColumn("category", F.lit("c"))


def unmoved(model, kind):
    """Own words of rows (for characters: any part of one) whose weights no row has moved."""
    own = r"^wort\d{3}$" if kind == "word" else r"^\d{3}$"
    terms = model.filter((F.col("model") == kind) & F.col("term").rlike(own))
    return terms.count(), terms.filter(~F.exists("weights", lambda w: w != 0)).count()


def test_every_row_moves_the_weights(spark):
    model = T.fit(frame(spark, rows(120) + rows(2)), "word", epochs=2, max_fit_rows=50)
    assert unmoved(model, "word") == (120, 0)


def test_two_classes_in_shards(spark):
    given = [(i, "Art", "ab"[i % 2], ["Holz", "Metall"][i % 2] + f" teil {i % 5}", "x") for i in range(90)]
    labelled = frame(spark, given)
    model = T.fit(labelled, "word", epochs=6, max_fit_rows=40)
    assert {r["weights"][0] for r in model.collect()} == {0.0}  # one margin, that of the second class
    scored = T.score(labelled.withColumn("allowed", F.array().cast("array<string>")), model, {"word": "plain"})
    wrong = scored.join(labelled.select("uid", "feature_value"), "uid").filter("word_value is null or word_value <> feature_value")
    assert wrong.count() == 0


def test_both_models_of_a_run_learn_from_every_row(spark):
    given = frame(spark, rows(75))
    taxonomy = spark.createDataFrame([("c", "Farbe", "categorical", "{'[rot]','[blau]','[grün]'}", 1)],
                                     "category string, feature_name string, feature_type string, aggregated_feature_values string, row_pos bigint")
    labels = given.select("uid", "feature_name", "feature_value").withColumn("feature_type", F.lit("categorical"))
    model = learn(taxonomy, given.drop("feature_name", "feature_value"), labels, models=True, epochs=1, max_fit_rows=25).model
    assert unmoved(model, "word") == (75, 0)
    own, still = unmoved(model, "char")  # a row already on the right side moves nothing
    assert own == 75 and own - still > 25
