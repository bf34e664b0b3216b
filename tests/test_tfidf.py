"""tf-idf with the vocabulary sent to the texts and met in a join: the same weights, counted by hand."""

import math
from collections import Counter, defaultdict

from merkmal.operators import textmodel as T

ROWS = [
    (1, "Farbe", "Roter  Stift rot"), (1, "Art", "Roter  Stift rot"), (1, "Farbe", "rot blau"), (2, "Farbe", "blau"), (2, "Farbe", "blau"),
    (3, "Art", None), (3, "Farbe", "🙂🙂 Größe ß"), (None, "Farbe", "rot"), (4, None, "rot"), (5, "Ohne", "rot"), (6, "Farbe", "zzz"), (7, "Art", ""),
    (8, "Art", "blau rot blau"),
]


def by_hand(vocab, kind):
    texts = defaultdict(Counter)
    for uid, feature, text in ROWS:
        if uid is not None and feature is not None and text is not None:
            texts[uid, feature].update(T.text_terms(text, kind))
    found = {}
    for (uid, feature), counted in texts.items():
        raw = {t: (1 + math.log(n)) * vocab[feature, t] for t, n in counted.items() if (feature, t) in vocab}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        found |= {(uid, feature, t): round(x / norm, 9) for t, x in raw.items()}
    return found


def test_both_forms_equal_the_weights_by_hand(spark, monkeypatch):
    documents = spark.createDataFrame(ROWS, "uid bigint, feature_name string, text string")
    for kind in ("word", "char"):
        vocab = T.vocabulary(documents.filter("feature_name <> 'Ohne' and (uid is null or uid <> 6)"), kind)
        wanted = by_hand({(r["feature_name"], r["term"]): r["idf"] for r in vocab.collect()}, kind)
        for bound in (T.BROADCAST_TERMS, 0):
            monkeypatch.setattr(T, "BROADCAST_TERMS", bound)
            monkeypatch.setattr(T, "OUT_ROWS", 3)
            rows = T.tfidf(documents, vocab, kind).collect()
            got = {(r["uid"], r["feature_name"], r["term"]): round(r["tfidf"], 9) for r in rows}
            assert got == wanted and len(rows) == len(wanted) > 5
            monkeypatch.undo()


def test_a_text_is_not_cut_per_feature(spark):
    documents = spark.createDataFrame(ROWS, "uid bigint, feature_name string, text string")
    plan = T.tfidf(documents, T.vocabulary(documents, "char"), "char")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # terms used to become rows of every (key, feature), twice
