"""Full-batch fit as Spark aggregates against the same descent on one machine."""

import numpy as np
from pyspark.sql import functions as F

from merkmal.operators import textmodel as T


def rows(n):
    colours = ["rot", "blau", "grün"]
    return [(i, "Farbe", colours[i % 3], f"Stift {colours[i % 3]} {i % 7}", None) for i in range(n)] + [
        (i, "Art", ["a", "b"][i % 2], ["Holz", "Metall"][i % 2] + f" teil {i % 5}", "x") for i in range(n)
    ]


def frame(spark, n):
    return spark.createDataFrame(rows(n), "uid bigint, feature_name string, feature_value string, title string, description string").withColumn("category", F.lit("c"))


def descend(x, labels, classes, epochs, rate, alpha):
    n, k = len(labels), len(classes)
    sizes = np.array([np.sum(labels == c) for c in range(k)], float)
    balance = sizes.sum() / (k * sizes)
    cols = [1] if k == 2 else list(range(k))
    w, b = np.zeros((x.shape[1], k)), np.zeros(k)
    for _ in range(epochs):
        m = x @ w + b
        g = np.zeros((n, k))
        for c in cols:
            hit = labels == c if k > 2 else labels == 1
            sign = np.where(hit, 1.0, -1.0)
            z = sign * m[:, c]
            slope = np.where(z < -1, -4.0, np.where(z < 1, -2 * (1 - z), 0.0))
            cost = np.where(hit | (k == 2), balance[labels], 1.0)
            g[:, c] = sign * slope * cost / n
        w = w - rate * (x.T @ g + alpha * w)
        b = b - rate * g.sum(0)
    return w, b


def test_full_fit_equals_single_machine_descent(spark):
    labelled = frame(spark, 60)
    model = T.fit_full(labelled, "word", epochs=6, rate=0.8).collect()
    docs = labelled.select("uid", "feature_name", "feature_value", T.TEXTS["plain"](None).alias("text"))
    for feature in ("Farbe", "Art"):
        mine = docs.filter(F.col("feature_name") == feature)
        vocab = T.vocabulary(mine, "word")
        values = T.tfidf(mine, vocab, "word").collect()
        terms = sorted({r["term"] for r in vocab.collect()})
        uids = sorted({r["uid"] for r in mine.collect()})
        x = np.zeros((len(uids), len(terms)))
        for r in values:
            x[uids.index(r["uid"]), terms.index(r["term"])] = r["tfidf"]
        head = [r for r in model if r["feature_name"] == feature and r["term"] is None][0]
        classes = list(head["classes"])
        truth = {r["uid"]: r["feature_value"] for r in mine.collect()}
        labels = np.array([classes.index(truth[u]) for u in uids])
        w, b = descend(x, labels, classes, 6, 0.8, 1e-4)
        got = {r["term"]: r["weights"] for r in model if r["feature_name"] == feature and r["term"] is not None}
        assert np.allclose(head["weights"], b, atol=1e-9)
        assert np.allclose(np.array([got[t] for t in terms]), w, atol=1e-9)


def test_full_fit_scores_its_rows(spark):
    labelled = frame(spark, 90)
    model = T.fit_full(labelled, "word", epochs=25)
    scored = T.score(labelled.withColumn("allowed", F.array().cast("array<string>")), model, {"word": "plain"})
    joined = scored.join(labelled.select("uid", "feature_name", "feature_value"), ["uid", "feature_name"])
    assert joined.agg(F.avg((F.col("word_value") == F.col("feature_value")).cast("int"))).first()[0] > 0.99
