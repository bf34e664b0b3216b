"""Scoring by sparse join against a dense numpy computation of the same margins and probabilities."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from merkmal.operators import textmodel as T


def dense_best(text, allowed, terms, idf, matrix, bias, classes):
    words = re.findall(r"\w{2,}", text.lower())
    known = Counter(t for t in words + [f"{a} {b}" for a, b in zip(words, words[1:])] if t in terms)
    value = {t: (1 + math.log(n)) * idf[terms[t]] for t, n in known.items()}
    norm = math.sqrt(sum(v * v for v in value.values()))
    margin = np.array(bias, float)
    for t, v in value.items():
        margin = margin + (v / norm) * matrix[terms[t]]
    if len(classes) == 2:
        p1 = (min(max(margin[1], -1), 1) + 1) / 2
        p = np.array([1 - p1, p1])
    else:
        p = (np.clip(margin, -1, 1) + 1) / 2
        p = p / p.sum() if p.sum() > 0 else np.full(len(p), 1 / len(p))
    options = [i for i, c in enumerate(classes) if c in allowed] if allowed else range(len(classes))
    top = max(options, key=lambda i: p[i], default=None)
    return (classes[top], round(float(p[top]), 9)) if top is not None and p[top] > 0 else (None, 0.0)


def test_sparse_scores_equal_dense_margins(spark):
    rng = random.Random(4)
    vocab = ["rot", "blau", "grün", "stift", "holz", "metall", "rot stift", "blau stift"]
    features = {"Farbe": ["blau", "grün", "rot"], "Art": ["a", "b"], "Leer": ["x", "y", "z"]}
    model_rows = []
    dense = {}
    for feature, classes in features.items():
        w = np.array([[rng.uniform(-1.5, 1.5) for _ in classes] for _ in vocab])
        if len(classes) == 2:
            w[:, 0] = 0.0
        bias = [rng.uniform(-0.5, 0.5) for _ in classes]
        if feature == "Leer":
            bias = [-2.0, -2.0, -2.0]  # every probability 0 without terms
        idf = [rng.uniform(1, 3) for _ in vocab]
        model_rows.append(("word", "plain", feature, None, None, bias, classes))
        model_rows += [("word", "plain", feature, t, idf[i], w[i].tolist(), None) for i, t in enumerate(vocab)]
        dense[feature] = ({t: i for i, t in enumerate(vocab)}, idf, w, bias, classes)
    model = spark.createDataFrame(model_rows, T.MODEL_SCHEMA)
    rows = []
    for uid in range(80):
        feature = rng.choice(list(features))
        title = " ".join(rng.choice(vocab[:6] + ["zzz"]) for _ in range(rng.randint(0, 6)))
        allowed = rng.choice([[], ["rot"], ["blau", "rot"], ["nie"]])
        rows.append((uid, feature, "c", title, None, allowed))
    rows.append((999, "Ohne", "c", "rot", None, []))
    frame = spark.createDataFrame(rows, "uid long, feature_name string, category string, title string, description string, allowed array<string>")
    got = {(r["uid"]): (r["word_value"], round(r["word_confidence"], 9)) for r in T.score(frame, model, {"word": "plain"}).collect()}
    assert 999 not in got
    for uid, feature, _, title, _, allowed in rows[:-1]:
        want = dense_best(title + " ", allowed, *dense[feature])
        assert got[uid][0] == want[0] and abs(got[uid][1] - want[1]) < 1e-9, (uid, got[uid], want)


def test_scoring_plan_has_no_python(spark):
    model = spark.createDataFrame([("word", "plain", "F", None, None, [0.1, 0.2], ["a", "b"]), ("word", "plain", "F", "rot", 1.0, [0.0, 1.0], None)], T.MODEL_SCHEMA)
    rows = spark.createDataFrame([(1, "F", "c", "rot", "", [])], "uid long, feature_name string, category string, title string, description string, allowed array<string>")
    scored = T.score(rows, model, {"word": "plain"})
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert scored.first()["word_value"] == "b"
