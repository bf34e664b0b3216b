"""Properties of the helpers and jobs that SQL does not cover."""

import random

from pyspark.sql import functions as F

from merkmal.functions.text import char_terms, plain_text, word_terms
from merkmal.operators import batches as B, scale as X, textmodel as T
from merkmal.operators.scoring import is_correct
from merkmal.operators import text_layers
from merkmal.operators.text_layers import dictionary_hits


def test_global_rank_and_rank_within(spark):
    rows = [(i % 3 if i % 2 else 0, i) for i in random.Random(1).sample(range(500), 500)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(5)
    ranked = {r["v"]: r["position"] for r in X.global_rank(frame, ["k", "v"]).collect()}
    assert ranked == {v: i + 1 for i, (k, v) in enumerate(sorted(rows))}
    within = {r["v"]: r["position"] for r in X.rank_within(frame, ["k"], ["v"]).collect()}
    for key in {k for k, _ in rows}:
        members = sorted(v for k, v in rows if k == key)
        assert [within[v] for v in members] == list(range(1, len(members) + 1))


def test_top_per_group_is_exact(spark):
    rows = [(i % 2, i * 37 % 1000, i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "k int, v int, id int")
    found = X.top_per_group(frame, ["k"], [F.asc("v")], ["id"], 7, slices=4).collect()
    for key in (0, 1):
        assert sorted(r["v"] for r in found if r["k"] == key) == sorted(v for k, v, _ in rows if k == key)[:7]


def test_task_terms_equal_native_terms(spark):
    texts = ["Größe  XL, Stahl-Rohr 4.8 mm", "a", "", "Ein   Wort", "ß é 🙂🙂 x_y"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for kind, native in (("word", word_terms), ("char", char_terms)):
        for row in frame.select("text", native(F.col("text")).alias("terms")).collect():
            assert sorted(row["terms"]) == sorted(T.text_terms(row["text"], kind))


def test_dictionary_join_equals_brute_force(spark, monkeypatch):
    generator = random.Random(7)
    letters = "abcß "
    keys = [None if i % 9 == 0 else i // 2 for i in range(60)]  # repeated and null keys
    texts = [(k, "".join(generator.choice(letters) for _ in range(30)), None) for k in keys]
    words = sorted({"".join(generator.choice("abcß") for _ in range(generator.randint(1, 5))) for _ in range(40)})
    products = spark.createDataFrame(texts, "uid bigint, title string, description string")
    values = spark.createDataFrame([(w,) for w in words], "value string")
    expected = sorted((str(k), w) for k, t, _ in texts for w in words if w in t.lower())
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, bound in ((held, 100), ("-1", 0)):  # broadcast and shuffled form
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            monkeypatch.setattr(text_layers, "BROADCAST_WORDS", bound)
            found = dictionary_hits(products, values).collect()
            assert sorted((str(r["uid"]), r["value"]) for r in found) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def colours(feature, n):
    return [(i, feature, ["rot", "blau", "grün"][i % 3], "Stift " + ["rot", "blau", "grün"][i % 3] + f" {i % 7}", None) for i in range(n)]


def labelled_frame(spark, rows):
    return spark.createDataFrame(rows, "uid bigint, feature_name string, feature_value string, title string, description string").withColumn("category", F.lit("c"))


def weights_of(model, feature):
    return sorted((r["term"] or "", [round(w, 9) for w in r["weights"]]) for r in model.filter(F.col("feature_name") == feature).collect())


def test_fit_learns_and_repeats_on_bounded_rows(spark):
    labelled = labelled_frame(spark, colours("Farbe", 240))
    for bound in (1000, 60):
        model = T.fit(labelled, "word", epochs=12, max_fit_rows=bound)
        scored = T.score(labelled.withColumn("allowed", F.array().cast("array<string>")), model, {"word": "plain"})
        joined = scored.join(labelled.select("uid", "feature_value"), "uid")
        assert joined.agg(F.avg(is_correct("word_value"))).first()[0] > 0.99
    assert weights_of(model, "Farbe") == weights_of(T.fit(labelled.repartition(7), "word", epochs=12, max_fit_rows=60), "Farbe")


def test_fit_of_a_feature_ignores_other_features(spark):
    alone = T.fit(labelled_frame(spark, colours("A", 90)), "word", epochs=8, max_fit_rows=100)
    both = T.fit(labelled_frame(spark, colours("A", 90) + colours("B", 300)), "word", epochs=8, max_fit_rows=100)
    assert weights_of(alone, "A") == weights_of(both, "A")


def test_title_lookup_is_the_same_in_shuffled_form(spark):
    from merkmal.operators.lookups import add_title_lookup

    rows = spark.createDataFrame([(i, "Farbe", f"Stift {i % 5}" if i % 7 else None, ["a", "b"]) for i in range(60)],
                                 "uid bigint, feature_name string, title string, allowed array<string>")
    lookup = spark.createDataFrame([("Farbe", f"Stift {i}", v, 3) for i, v in enumerate("abc")], "feature_name string, title string, value string, n bigint")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for limit in (held, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found.append(sorted(map(str, add_title_lookup(rows, lookup, "hit").select("uid", "hit").collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert found[0] == found[1] and len(found[0]) == 60


def test_description_cut_is_only_used_when_asked(spark):
    row = spark.createDataFrame([("t", "x" * 900)], "title string, description string")
    whole, short = row.select(plain_text(), plain_text(200)).first()
    assert (len(whole), len(short)) == (902, 202)


def test_replies(spark):
    texts = ['[{"a": "1"}]', 'so: [{"a": null}] end', "[broken", "none", '[{"a": "1"}] and then [x]', ' [] ']
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    sizes = [None if r["o"] is None else len(r["o"]) for r in frame.select(B.parse_reply(F.col("t")).alias("o")).collect()]
    assert sizes == [1, 1, None, None, None, 0]


def test_null_is_never_correct(spark):
    rows = spark.createDataFrame([(None, None), ("a", None), (None, "a"), ("a", "a")], "predicted_value string, feature_value string")
    assert [r[0] for r in rows.select(is_correct()).collect()] == [0.0, 0.0, 0.0, 1.0]


def test_rules_run_on_a_stream(spark, tmp_path):
    from merkmal.operators.taxonomy import build_slots
    from merkmal.operators.waterfall import predict_by_rules
    from merkmal.streaming.rules import stream_predictions

    slots = build_slots(spark.createDataFrame(
        [("c", "Farbe", "categorical", "{'[Rot]','[Blau]'}", 1)], "category string, feature_name string, feature_type string, aggregated_feature_values string, row_pos bigint"))
    rows = spark.createDataFrame(
        [(i, "c", "Farbe", "categorical", ["Stift rot", "Stift", "blau"][i % 3], None) for i in range(30)],
        "uid bigint, category string, feature_name string, feature_type string, title string, description string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    stream_predictions(stream, slots, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(str, predict_by_rules(rows, slots).collect()))


def test_stored_models_and_trial_limit_in_a_job(spark, tmp_path):
    from merkmal.plans import job

    root = str(tmp_path)
    rows = [(i, "c", "Stift " + ["rot", "blau", "grün"][i % 3], None) for i in range(90)]
    products = spark.createDataFrame(rows, "uid bigint, category string, title string, description string")
    labels = products.select("uid", F.lit("Farbe").alias("feature_name"), F.initcap(F.split("title", " ")[1]).alias("feature_value"), F.lit("categorical").alias("feature_type"))
    for split in ("train", "val"):
        products.write.parquet(f"{root}/{split}/products.parquet")
        labels.write.parquet(f"{root}/{split}/product_features.parquet")
    spark.createDataFrame([("c", "Farbe", "categorical", "{'[Rot]','[Blau]','[Grün]'}")],
        "category string, feature_name string, feature_type string, aggregated_feature_values string").write.parquet(f"{root}/taxonomy/taxonomy.parquet")
    assert job.stored_model(spark, f"{root}/models") is None
    job.train(spark, root, f"{root}/models", epochs=5, text="piped")
    assert {(r["model"], r["form"]) for r in job.stored_model(spark, f"{root}/models").select("model", "form").distinct().collect()} == {("word", "piped"), ("char", "piped")}
    scores = job.run(spark, root, "val", f"{root}/out", limit=40, model_path=f"{root}/models")
    assert {r["metric"]: (r["accuracy"], r["n"]) for r in scores.collect()}["overall"] == (1.0, 40)
    assert spark.read.parquet(f"{root}/out").count() == 40
