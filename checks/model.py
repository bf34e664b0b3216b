"""Text models. Scoring is checked with a model made of term counts per class,
which SQL can build too; the fitted model has no SQL form."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.layers import LAYERS, slots
from checks.relations import with_relations
from merkmal.functions.text import plain_text
from merkmal.operators import textmodel as T
from merkmal.operators.lookups import labelled_products
from merkmal.operators.scale import group_tasks
from merkmal.operators.taxonomy import with_slots
from merkmal.operators.waterfall import predict_by_rules
from merkmal.plans.predict import classifier_layer
from merkmal.session import cut_lineage, scratch_path
from merkmal.sources import catalog, derived as D


def training(spark, sf):
    labels = D.labels(spark, sf).filter("split = 'train'").drop("split")
    return labelled_products(labels, D.products(spark, sf), ["category", "title", "description"])


def documents(spark, sf):
    gate = F.broadcast(T.training_gate(training(spark, sf)).select("feature_name"))  # one row per feature
    return training(spark, sf).join(gate, "feature_name").select("uid", "feature_name", "feature_value", plain_text().alias("text"))


def term_counts(kind):
    return lambda spark, sf: T.term_counts(documents(spark, sf), kind)


def vocabulary(kind, k):
    def query(spark, sf):
        return T.vocabulary(documents(spark, sf), kind, k).select("feature_name", "term", "n_docs", "n_total", F.round("idf", 6).alias("idf"))

    return query


def tfidf(kind):
    def query(spark, sf):
        docs = documents(spark, sf)
        found = T.tfidf(docs, T.vocabulary(docs, kind), kind)
        return found.select("uid", "feature_name", "term", F.round("tfidf", 6).alias("tfidf"))

    return query


def count_model(docs, kind):
    """Weight of a term for a class: share of the class's documents with the term
    minus the share of all documents with it. No intercept."""
    vocab = T.vocabulary(docs, kind)
    sizes = docs.groupBy("feature_name", "feature_value").agg(F.count("*").alias("n_class"))
    rows = docs.groupBy("feature_name").agg(F.count("*").alias("n_rows"))
    copies = docs.groupBy("text", "feature_name", "feature_value").agg(F.count("*").alias("n"))
    lines = group_tasks(copies, ["text"]).groupBy("text").agg(F.collect_list(F.struct("feature_name", "feature_value", "n")).alias("marks"))
    held = lines.select("marks", F.explode(F.array_distinct(T.TERMS[kind](F.col("text")))).alias("term")).select(F.explode("marks").alias("m"), "term")
    held = held.groupBy("m.feature_name", "m.feature_value", "term").agg(F.sum("m.n").alias("n_both"))
    grid = vocab.join(sizes, "feature_name").join(rows, "feature_name").join(held, ["feature_name", "feature_value", "term"], "left")
    weight = F.coalesce("n_both", F.lit(0)) / F.col("n_class") - F.col("n_docs") / F.col("n_rows")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("feature_value").alias("c"), weight.alias("w"))))
    terms = grid.groupBy("feature_name", "term", "idf").agg(ordered.alias("cw")).select(
        "feature_name", "term", "idf", F.transform("cw", lambda x: x["w"]).alias("weights"), F.lit(None).cast("array<string>").alias("classes")
    )
    names = sizes.groupBy("feature_name").agg(F.array_sort(F.collect_list("feature_value")).alias("classes"))
    heads = names.select(
        "feature_name", F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
        F.transform("classes", lambda c: F.lit(0.0)).alias("weights"), "classes",
    )
    return terms.unionByName(heads).withColumns({"model": F.lit(kind), "form": F.lit("plain")})


def both_models(spark, sf):
    docs = documents(spark, sf)
    return cut_lineage(count_model(docs, "word").unionByName(count_model(docs, "char")))


def asked(spark, sf):
    """Every labelled (uid, feature_name) with its allowed values."""
    rows = labelled_products(D.labels(spark, sf).select("uid", "feature_name"), D.products(spark, sf))
    return with_slots(rows, slots(spark, sf), ["allowed"])


def scored(spark, sf):
    return T.score(asked(spark, sf), both_models(spark, sf))


def model_scores(spark, sf):
    return scored(spark, sf).select(
        "uid", "feature_name", "word_value", F.round("word_confidence", 6).alias("word_confidence"),
        "char_value", F.round("char_confidence", 6).alias("char_confidence"),
    )


def ensemble_choice(spark, sf):
    return T.ensemble_choice(scored(spark, sf)).select(
        "uid", "feature_name", F.col("agree").cast("int").alias("agree"), "choice", F.round("choice_confidence", 6).alias("choice_confidence")
    )


def ensemble_override(spark, sf):
    """Rule predictions of labelled rows after the ensemble rule."""
    known, products = slots(spark, sf), D.products(spark, sf)
    rows = catalog.work_rows(D.labels(spark, sf).select("uid", "feature_name", "feature_type"), products)
    predicted = cut_lineage(predict_by_rules(rows, known, fuzzy=False))  # read twice, as in ``predict``
    return classifier_layer(predicted, known, both_models(spark, sf)).select("uid", "feature_name", "predicted_value", F.round("confidence", 6).alias("confidence"))


def model_round_trip(spark, sf):
    """The count model written as a table by model and read again, one row per weight."""
    path = scratch_path(spark, "model")
    catalog.write_model(count_model(documents(spark, sf), "word"), path)
    back = catalog.read_model_table(spark, path).filter("term is not null")
    names = catalog.read_model_table(spark, path).filter("term is null").select("feature_name", F.col("classes").alias("names"))
    spread = back.join(names, "feature_name").select("feature_name", "term", "names", F.posexplode("weights").alias("i", "w"))
    return spread.select("feature_name", "term", F.get("names", F.col("i")).alias("value"), F.round("w", 6).alias("w"))


def fitted_models(spark, sf):
    """Fit on the training split; one line per feature and model."""
    rows = training(spark, sf)
    model = T.fit(rows, "word").unionByName(T.fit(rows, "char"))
    return model.groupBy("model", "feature_name").agg(
        F.count("term").alias("n_terms"), F.max(F.size("weights")).cast("bigint").alias("n_classes"),
    )


_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"
_TERMS = {
    "word": f"list_concat({_WORDS}, list_transform(range(1, len({_WORDS})), lambda i: {_WORDS}[i] || ' ' || {_WORDS}[i + 1]))",
    "char": "list_concat(list_concat({}, {}), {})".format(
        *[f"list_transform(range(1, length(flat) - {n} + 2), lambda i: substring(flat, i, {n}))" for n in (2, 3, 4)]
    ),
}
_M = {
    "training": "SELECT uid, feature_name, feature_value, title || ' ' || coalesce(description, '') AS text FROM labels JOIN products USING (uid) WHERE split = 'train'",
    "gate": "SELECT feature_name, count(*) AS n_rows, count(DISTINCT feature_value) AS n_classes FROM training GROUP BY 1 HAVING count(*) >= 30 AND count(DISTINCT feature_value) BETWEEN 2 AND 1000",
    "docs": r"SELECT *, regexp_replace(lower(text), '\s\s+', ' ', 'g') AS flat FROM training WHERE feature_name IN (SELECT feature_name FROM gate)",
    "asked": r"SELECT uid, feature_name, category, text, regexp_replace(lower(text), '\s\s+', ' ', 'g') AS flat FROM (SELECT uid, feature_name, category, title || ' ' || coalesce(description, '') AS text FROM labels JOIN products USING (uid)) WHERE feature_name IN (SELECT feature_name FROM gate)",
}
_MN = {"training": ["labels", "products"], "gate": ["training"], "docs": ["gate"], "asked": ["labels", "products", "gate"]}
for _k in ("word", "char"):
    _M.update({
        f"{_k}_tf": f"SELECT uid, feature_name, feature_value, term, count(*) AS tf FROM (SELECT uid, feature_name, feature_value, unnest({_TERMS[_k]}) AS term FROM docs) GROUP BY ALL",
        f"{_k}_counts": f"SELECT feature_name, term, count(*) AS n_docs, CAST(sum(tf) AS BIGINT) AS n_total FROM {_k}_tf GROUP BY 1, 2",
        f"{_k}_vocab": f"SELECT feature_name, term, n_docs, n_total, n_rows, ln((1 + n_rows) / (1 + n_docs)) + 1 AS idf FROM (SELECT *, row_number() OVER (PARTITION BY feature_name ORDER BY n_total DESC, term) AS rn FROM {_k}_counts) JOIN gate USING (feature_name) WHERE rn <= 5000",
        f"{_k}_weights": f"""SELECT feature_name, term, c.feature_value AS value, coalesce(n_both, 0) / n_class - n_docs / n_rows AS w FROM {_k}_vocab JOIN (SELECT feature_name, feature_value, count(*) AS n_class FROM docs GROUP BY 1, 2) c USING (feature_name)
            LEFT JOIN (SELECT feature_name, feature_value, term, count(*) AS n_both FROM {_k}_tf GROUP BY 1, 2, 3) b USING (feature_name, feature_value, term)""",
        f"{_k}_asked_tf": f"SELECT uid, feature_name, term, count(*) AS tf FROM (SELECT uid, feature_name, unnest({_TERMS[_k]}) AS term FROM asked) GROUP BY ALL",
        f"{_k}_raw": f"SELECT uid, feature_name, term, (1 + ln(tf)) * idf AS raw FROM {_k}_asked_tf JOIN {_k}_vocab USING (feature_name, term)",
        f"{_k}_unit": f"SELECT uid, feature_name, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY uid, feature_name)) AS tfidf FROM {_k}_raw",
        f"{_k}_margin": f"SELECT uid, feature_name, value, sum(tfidf * w) AS m FROM {_k}_unit JOIN {_k}_weights USING (feature_name, term) GROUP BY 1, 2, 3",
        f"{_k}_p": f"""SELECT uid, feature_name, value, CASE WHEN k = 2 THEN CASE WHEN place = 2 THEN q ELSE 1 - other END WHEN total > 0 THEN q / total ELSE 1.0 / k END AS p FROM (
            SELECT *, sum(q) OVER g AS total, count(*) OVER g AS k, row_number() OVER (PARTITION BY uid, feature_name ORDER BY value) AS place, last_value(q) OVER (PARTITION BY uid, feature_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS other
            FROM (SELECT *, (greatest(-1, least(1, m)) + 1) / 2 AS q FROM {_k}_margin) WINDOW g AS (PARTITION BY uid, feature_name))""",
        f"{_k}_best": f"""SELECT uid, feature_name, value, p FROM (SELECT a.uid, a.feature_name, value, p, row_number() OVER (PARTITION BY a.uid, a.feature_name ORDER BY round(p, 9) DESC, value) AS rn
            FROM asked a JOIN {_k}_p USING (uid, feature_name) LEFT JOIN slots s USING (category, feature_name) WHERE p > 0 AND (coalesce(len(allowed), 0) = 0 OR list_contains(allowed, value))) WHERE rn = 1""",
        f"{_k}_train_raw": f"SELECT uid, feature_name, term, (1 + ln(tf)) * idf AS raw FROM {_k}_tf JOIN {_k}_vocab USING (feature_name, term)",
    })
    _MN.update({
        f"{_k}_tf": ["docs"], f"{_k}_counts": [f"{_k}_tf"], f"{_k}_vocab": [f"{_k}_counts"], f"{_k}_weights": [f"{_k}_vocab"], f"{_k}_asked_tf": ["asked"],
        f"{_k}_raw": [f"{_k}_asked_tf", f"{_k}_vocab"], f"{_k}_unit": [f"{_k}_raw"], f"{_k}_margin": [f"{_k}_unit", f"{_k}_weights"], f"{_k}_p": [f"{_k}_margin"],
        f"{_k}_best": [f"{_k}_p", "slots"], f"{_k}_train_raw": [f"{_k}_vocab"],
    })
_M["scores"] = """SELECT a.uid, a.feature_name, w.value AS word_value, coalesce(w.p, 0.0) AS word_confidence, c.value AS char_value, coalesce(c.p, 0.0) AS char_confidence
    FROM asked a LEFT JOIN word_best w USING (uid, feature_name) LEFT JOIN char_best c USING (uid, feature_name)"""
_M["choices"] = """SELECT uid, feature_name, coalesce(word_value = char_value, false) AS agree,
    CASE WHEN coalesce(word_value = char_value, false) OR word_confidence > char_confidence THEN word_value ELSE char_value END AS choice,
    CASE WHEN coalesce(word_value = char_value, false) THEN (word_confidence + char_confidence) / 2 + 0.1 ELSE greatest(word_confidence, char_confidence) END AS choice_confidence FROM scores"""
_M["plain_rules"] = """SELECT l.uid, l.feature_name, b.feature_type, coalesce(c1, c2, c3, c4, c5, c6, c7, c8, c9) AS predicted_value,
    CASE WHEN c1 IS NOT NULL THEN 0.93 WHEN c2 IS NOT NULL THEN 0.92 WHEN c3 IS NOT NULL THEN 0.95 WHEN c4 IS NOT NULL THEN 0.9 WHEN c5 IS NOT NULL THEN 0.9 WHEN c6 IS NOT NULL THEN 0.88
      WHEN c7 IS NOT NULL THEN 0.85 WHEN c8 IS NOT NULL THEN 0.75 WHEN c9 IS NOT NULL THEN 0.5 ELSE 0 END AS confidence FROM labels l JOIN by_rules b USING (uid, feature_name)"""
_MN.update({"scores": ["word_best", "char_best"], "choices": ["scores"], "plain_rules": ["labels", "by_rules"]})
MODEL = {"extra": {**LAYERS["extra"], **_M}, "needs": {**LAYERS["needs"], **_MN}}


def sql(body, *names):
    return with_relations(body, *names, **MODEL)


def _tfidf_sql(kind):
    return sql(f"SELECT uid, feature_name, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY uid, feature_name)), 6) AS tfidf FROM {kind}_train_raw", f"{kind}_train_raw")


_TAKE = "choice IS NOT NULL AND (predicted_value IS NULL OR (feature_type <> 'numeric' AND agree AND confidence < 0.9 AND choice_confidence > 0.5))"

PAIRS = {
    "training_gate": (lambda s, d: T.training_gate(training(s, d)), sql("SELECT * FROM gate", "gate")),
    "word_term_counts": (term_counts("word"), sql("SELECT * FROM word_counts", "word_counts")),
    "char_term_counts": (term_counts("char"), sql("SELECT * FROM char_counts", "char_counts")),
    "word_vocabulary": (vocabulary("word", 5000), sql("SELECT feature_name, term, n_docs, n_total, round(idf, 6) AS idf FROM word_vocab", "word_vocab")),
    "char_vocabulary": (vocabulary("char", 5000), sql("SELECT feature_name, term, n_docs, n_total, round(idf, 6) AS idf FROM char_vocab", "char_vocab")),
    "word_tfidf": (tfidf("word"), _tfidf_sql("word")),
    "char_tfidf": (tfidf("char"), _tfidf_sql("char")),
    "model_scores": (model_scores, sql("SELECT uid, feature_name, word_value, round(word_confidence, 6) AS word_confidence, char_value, round(char_confidence, 6) AS char_confidence FROM scores", "scores")),
    "ensemble_choice": (ensemble_choice, sql("SELECT uid, feature_name, CAST(agree AS INTEGER) AS agree, choice, round(choice_confidence, 6) AS choice_confidence FROM choices", "choices")),
    "ensemble_override": (ensemble_override, sql(
        f"""SELECT uid, feature_name, CASE WHEN {_TAKE} THEN choice ELSE predicted_value END AS predicted_value,
            round(CAST(CASE WHEN {_TAKE} THEN choice_confidence * 0.7 ELSE confidence END AS DOUBLE), 6) AS confidence FROM plain_rules LEFT JOIN choices USING (uid, feature_name)""", "plain_rules", "choices")),
    "model_round_trip": (model_round_trip, sql("SELECT feature_name, term, value, round(w, 6) AS w FROM word_weights", "word_weights")),
    "fitted_models": (fitted_models, sql(" UNION ALL ".join(
        f"SELECT '{k}' AS model, feature_name, count(*) AS n_terms, max(n_classes) AS n_classes FROM {k}_vocab JOIN gate USING (feature_name) GROUP BY feature_name"
        for k in ("word", "char")), "word_vocab", "char_vocab", "gate")),
}
