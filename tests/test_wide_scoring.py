"""Scores with a column per class and with a line per class, and texts shared by features."""

import random

from pyspark.sql import functions as F

from merkmal.operators import textmodel as T

SCHEMA = "uid bigint, feature_name string, category string, title string, description string, allowed array<string>"


def given(spark):
    rng = random.Random(9)
    words = ["rot", "blau", "grün", "holz", "metall"]
    classes = {"Farbe": ["blau", "grün", "rot"], "Art": ["a", "b"]}
    model = []
    for kind in ("word", "char"):
        for feature, names in classes.items():
            model.append((kind, "plain", feature, None, None, [rng.uniform(-0.5, 0.5) for _ in names], names))
            model += [(kind, "plain", feature, t if kind == "word" else t[:3], rng.uniform(1, 2), [rng.uniform(-1, 1) for _ in names], None) for t in words]
    rows = []
    for uid in range(40):
        title = " ".join(rng.choice(words + ["zzz"]) for _ in range(uid % 5))
        for feature in ("Farbe", "Art", "Ohne"):
            rows.append((uid if uid % 9 else None, feature, "c", title or None, None, rng.choice([[], ["rot", "a"], ["nie"]])))
    rows += rows[:7] + [(3, "Farbe", "c", "rot rot holz", None, [])]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(model, T.MODEL_SCHEMA)


def test_both_forms_of_the_sums_agree(spark, monkeypatch):
    rows, model = given(spark)
    found = []
    for bound in (T.WIDE_CLASSES, 2, 0):
        monkeypatch.setattr(T, "WIDE_CLASSES", bound)
        scored = T.score(rows, model).withColumns({c: F.round(c, 9) for c in ("word_confidence", "char_confidence")})
        found.append(sorted(map(str, scored.collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 2 * rows.count() // 3 + 1


def test_terms_do_not_become_a_row_per_class(spark):
    rows, model = given(spark)
    plan = T.score(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan
