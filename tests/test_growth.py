"""Plans that have to hold when the catalog grows: spread inputs, no broadcast of what grows, narrow shuffles."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from merkmal.operators import complete as C, lookups as L, scoring as S, taxonomy as T, textmodel as T2
from merkmal.operators.prepare import product_texts
from merkmal.operators.scale import sent_if_small
from merkmal.operators.waterfall import predict_by_rules
from merkmal.sources import catalog, derived as D


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One file of 320 parts, as the test tables are stored."""
    path = str(tmp_path_factory.mktemp("parts"))
    part = spark.range(0, 320, 1, 1).select(
        F.col("id").alias("p_partkey"), F.format_string("blue word%d", F.col("id") % 5).alias("p_name"),
        F.when(F.col("id") % 2 == 0, "SMALL").otherwise("LARGE").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"),
    )
    part.write.parquet(f"{path}/part.parquet")
    return path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_products_of_one_file_are_spread(spark, folder):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows in (D.products(spark, folder), D.labels(spark, folder), D.template(spark, folder)):
        assert rows.rdd.getNumPartitions() == n
    assert D.products(spark, folder).count() == 320


def test_sides_that_grow_are_not_broadcast(spark, folder):
    products, labels = D.products(spark, folder), D.labels(spark, folder)
    rows = catalog.work_rows(labels.select("uid", "feature_name", "feature_type"), products)
    given = rows.withColumns({"predicted_value": F.lit("x"), "layer": F.lit("l")})
    matched = S.match_truth(given, labels)
    for df in (rows, L.labelled_products(labels, products), matched, S.accuracy_by_type(matched, given),
               S.evaluate(given, labels), S.layer_contribution(given, labels)):
        assert "BroadcastHashJoin" not in plan(df)


def test_small_slots_are_sent_and_rows_are_not_shuffled_on_few_keys(spark, folder):
    slots = sent_if_small(T.build_slots(D.taxonomy(spark, folder)))
    rows = D.request_rows(D.products(spark, folder), slots).select(
        "uid", "category", "feature_name", F.lit(None).cast("string").alias("predicted_value"), F.lit(0.0).alias("confidence"), F.lit("none").alias("layer")
    )
    found = plan(C.apply_fallbacks(rows, slots, L.feature_mode(D.labels(spark, folder))))
    assert "SortMergeJoin [category" not in found and "hashpartitioning(category#" not in found.split("BroadcastExchange")[0]
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(sent_if_small(spark.range(5), 5)) and not hinted(sent_if_small(spark.range(6), 5))


def test_title_lookup_meets_rows_before_texts_are_made(spark, folder):
    products, slots = D.products(spark, folder), sent_if_small(T.build_slots(D.taxonomy(spark, folder)))
    lookup = L.title_lookup(D.labels(spark, folder), products)
    done = predict_by_rules(D.request_rows(products, slots), slots, lookup)
    lines = done._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = lines[next(i for i, line in enumerate(lines) if "Join LeftOuter" in line and "title" in line):]
    assert not [line for line in below if "text_number" in line]


def test_texts_are_made_once_per_product_and_rows_are_not_shuffled_by_title(spark, folder):
    products, slots = D.products(spark, folder), sent_if_small(T.build_slots(D.taxonomy(spark, folder)))
    lookup = L.title_lookup(D.labels(spark, folder), products)
    done = predict_by_rules(D.request_rows(product_texts(products, lookup), slots), slots, lookup)
    lines = done._jdf.queryExecution().optimizedPlan().toString().split("\n")
    slot_join = max(i for i, line in enumerate(lines) if "Join Inner, (category" in line)
    above, below = "\n".join(lines[:slot_join]), "\n".join(lines[slot_join:])
    assert "regexp_extract_all(description" not in above and "Join LeftOuter, (title" not in above
    assert "RepartitionByExpression" in below and "Join LeftOuter, (title" in below
    plain = predict_by_rules(D.request_rows(products, slots), slots, lookup)
    assert done.columns == plain.columns
    assert sorted(map(str, done.collect())) == sorted(map(str, plain.collect()))


def test_product_texts_keep_repeated_and_null_keys(spark):
    rows = [(1, "c", "rot 5,5 kg", "Höhe: 3 mm"), (1, "c", "rot 5,5 kg", "Höhe: 3 mm"), (None, "c", None, None), (2, "c", "blau", "")]
    products = spark.createDataFrame(rows, "uid long, category string, title string, description string")
    lookup = spark.createDataFrame([("f", "rot 5,5 kg", "x"), (None, "blau", "y"), ("g", None, "z")], "feature_name string, title string, value string")
    got = product_texts(products, lookup).select("uid", "text", "title_number", "title_values", "clean_pairs").collect()
    line = (1, "rot 5,5 kg Höhe: 3 mm", "rot 5.5 kg", {"f": "x"}, [("höhe", "3 mm")])
    assert sorted(map(repr, map(tuple, [(*r[:4], r[4] and [tuple(p) for p in r[4]]) for r in got]))) == sorted(
        map(repr, [line, line, (None, " ", "", None, None), (2, "blau ", "blau", None, None)]))


def test_commonest_value_against_counting(spark):
    slots = spark.createDataFrame(
        [("a", "f", "categorical", ["x", "y"]), ("b", "f", "categorical", ["y", "z"]), ("c", "f", "categorical", ["z", "x", "y"]),
         (None, "f", "categorical", ["z"]), ("a", None, "categorical", ["q"]), ("d", "g", "categorical", [])],
        "category string, feature_name string, slot_type string, allowed array<string>",
    )
    got = {(r.category, r.feature_name): (r.value, r.n) for r in C.commonest_slot_value(slots).collect()}
    assert got == {("a", "f"): ("y", 3), ("b", "f"): ("y", 3), ("c", "f"): ("y", 3), (None, "f"): ("z", 3)}


def _texts(spark):
    rows = [(1, "f", "rot Stift rot"), (1, "f", "blau"), (1, "g", "rot Stift rot"), (2, "f", "blau blau rot"), (3, "f", None), (None, "f", "rot rot"), (4, "g", "")]
    return spark.createDataFrame(rows, "uid long, feature_name string, text string")


def _words(text):
    words = re.findall(r"\w{2,}", (text or "").lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_term_counts_and_tfidf_against_counting(spark):
    rows = [tuple(r) for r in _texts(spark).collect()]
    docs, total, tf = Counter(), Counter(), Counter()
    for uid, feature, text in rows:
        docs.update((feature, t) for t in set(_words(text)))
        total.update((feature, t) for t in _words(text))
        tf.update((uid, feature, t) for t in _words(text))
    counted = {(r.feature_name, r.term): (r.n_docs, r.n_total) for r in T2.term_counts(_texts(spark), "word").collect()}
    assert counted == {k: (docs[k], total[k]) for k in total}
    vocab = T2.vocabulary(_texts(spark), "word")
    idf = {(r.feature_name, r.term): r.idf for r in vocab.collect()}
    raw = {k: (1 + math.log(n)) * idf[k[1:]] for k, n in tf.items() if k[0] is not None}  # a null key joins with nothing
    norm = Counter()
    for k, x in raw.items():
        norm[k[:2]] += x * x
    got = {(r.uid, r.feature_name, r.term): r.tfidf for r in T2.tfidf(_texts(spark), vocab, "word").collect()}
    assert got.keys() == raw.keys() and all(abs(x - raw[k] / math.sqrt(norm[k[:2]])) < 1e-12 for k, x in got.items())


def test_terms_are_not_shuffled(spark):
    """Weights and scores move texts and sums between tasks, no row per term."""
    vocab = T2.vocabulary(_texts(spark), "char")
    model = spark.createDataFrame([("word", "plain", "f", None, None, [0.1, 0.2], ["a", "b"]), ("word", "plain", "f", "rot", 1.0, [0.0, 1.0], None)], T2.MODEL_SCHEMA)
    rows = spark.createDataFrame([(1, "f", "c", "rot", "", [])], "uid long, feature_name string, category string, title string, description string, allowed array<string>")
    for df in (T2.tfidf(_texts(spark), vocab, "char"), T2.score(rows, model, {"word": "plain"})):
        assert not [line for line in plan(df).split("\n") if "hashpartitioning(" in line and "term" in line]


def test_rows_with_texts_are_read_once_for_all_layers(spark, folder):
    slots = sent_if_small(T.build_slots(D.taxonomy(spark, folder)))
    products = D.products(spark, folder)
    lookup = L.title_lookup(D.labels(spark, folder), products)
    rows = D.request_rows(product_texts(products, lookup), slots)
    lines = plan(predict_by_rules(rows, slots, lookup)).split("\n")
    top = next(i for i, line in enumerate(lines) if "Generate inline" in line)
    join = next(i for i, line in enumerate(lines) if i > top and "Join" in line)
    # One projection for the layers and the join's own.
    assert sum("Project [" in line for line in lines[top:join]) <= 2
