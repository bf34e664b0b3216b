"""Fallback, validation, scoring and outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.layers import LAYERS, closest_sql, full_rule_run, slots
from checks.relations import with_relations
from checks.taxonomy import stored_catalog
from merkmal.operators import complete as C, lookups as L, scoring as S
from merkmal.operators.waterfall import predict_by_rules
from merkmal.plans import job
from merkmal.plans.predict import learn, predict
from merkmal.session import scratch_path
from merkmal.sources import catalog, derived as D


def labelled_rows(spark, sf):
    """Rule predictions for every labelled row."""
    known, products = slots(spark, sf), D.products(spark, sf)
    rows = catalog.work_rows(D.labels(spark, sf).select("uid", "feature_name", "feature_type"), products)
    lookup = L.title_lookup(D.labels(spark, sf).filter("split = 'train'"), products)
    return predict_by_rules(rows, known, lookup, fuzzy=False)


def filled(spark, sf):
    mode = L.feature_mode(D.labels(spark, sf).filter("split = 'train'"))
    return C.apply_fallbacks(labelled_rows(spark, sf), slots(spark, sf), mode)


def validated(spark, sf, fuzzy=False):
    return C.validate(filled(spark, sf), slots(spark, sf), fuzzy)


def fallback_all(spark, sf):
    """Fallback for every open row of the whole request."""
    known, products = slots(spark, sf), D.products(spark, sf)
    rows = D.request_rows(products, known).select(
        "uid", "category", "feature_name", F.lit(None).cast("string").alias("predicted_value"), F.lit(0.0).alias("confidence"), F.lit("none").alias("layer")
    )
    mode = L.feature_mode(D.labels(spark, sf).filter("split = 'train'"))
    return C.apply_fallbacks(rows, known, mode).select("uid", "feature_name", "predicted_value", "confidence", "layer")


def commonest(spark, sf):
    return C.commonest_slot_value(slots(spark, sf))


def validate_native(spark, sf):
    rows = validated(spark, sf)
    return rows.select("uid", "feature_name", "predicted_value", "confidence", "layer", F.col("corrected").cast("int").alias("corrected"))


def validate_fuzzy(spark, sf):
    return validated(spark, sf, True).select("uid", "feature_name", "predicted_value", F.col("corrected").cast("int").alias("corrected"))


def matched(spark, sf):
    return S.match_truth(validated(spark, sf), D.labels(spark, sf))


def rounded(df):
    return df.withColumn("accuracy", F.round("accuracy", 6))


def accuracy_by_type(spark, sf):
    predictions = validated(spark, sf)
    return rounded(S.accuracy_by_type(S.match_truth(predictions, D.labels(spark, sf)), predictions))


def run_counts(spark, sf):
    mode = L.feature_mode(D.labels(spark, sf).filter("split = 'train'"))
    return S.run_counts(labelled_rows(spark, sf), slots(spark, sf), mode, fuzzy=False)


def template_rows(spark, sf):
    known, products = slots(spark, sf), D.products(spark, sf)
    rows = catalog.work_rows(D.template(spark, sf).drop("feature_value"), products)
    return predict_by_rules(rows, known, fuzzy=False)


def filled_template(spark, sf):
    return catalog.filled_template(D.template(spark, sf), template_rows(spark, sf)).select("template_pos", "uid", "feature_name", "feature_value", "feature_type")


def labelled_output(spark, sf):
    return catalog.labelled_output(labelled_rows(spark, sf))


def submission_check(spark, sf):
    template = D.template(spark, sf)
    given = catalog.labelled_output(template_rows(spark, sf)).filter("feature_name <> 'Farbe'")
    extra = D.labels(spark, sf).filter("feature_name = 'Farbe'").select(given.columns)
    return S.submission_check(template, given.unionByName(extra))


def stored_run(split):
    """The whole job on stored splits: what it wrote, read again."""

    def query(spark, sf):
        out = scratch_path(spark, "predictions")
        job.run(spark, stored_catalog(spark, sf), split, out)
        return spark.read.parquet(out).select("uid", "feature_name", "feature_value", "feature_type")

    return query


def full_validation_run(spark, sf):
    """Everything: fit both text models on train, run all layers on validation rows, score."""
    products, labels = D.products(spark, sf), D.labels(spark, sf)
    known = learn(D.taxonomy(spark, sf), products, labels.filter("split = 'train'"), models=True)
    truth = labels.filter("split = 'val'")
    rows = catalog.work_rows(truth.select("uid", "feature_name", "feature_type"), products)
    return S.evaluate(predict(rows, known, semantic=True), truth)


_FILLED = """SELECT uid, category, feature_name, w.feature_type, allowed, coalesce(predicted_value, CASE WHEN coalesce(len(allowed), 0) = 0 OR list_contains(allowed, m.value) THEN m.value END, c.value) AS predicted_value,
          CASE WHEN predicted_value IS NOT NULL THEN confidence WHEN m.value IS NOT NULL AND (coalesce(len(allowed), 0) = 0 OR list_contains(allowed, m.value)) THEN 0.2 WHEN c.value IS NOT NULL THEN 0.15 ELSE confidence END AS confidence,
          CASE WHEN predicted_value IS NOT NULL THEN layer WHEN m.value IS NOT NULL AND (coalesce(len(allowed), 0) = 0 OR list_contains(allowed, m.value)) THEN 'fallback_mode' WHEN c.value IS NOT NULL THEN 'fallback_common' ELSE layer END AS layer
        FROM @ROWS@ w LEFT JOIN slots USING (category, feature_name) LEFT JOIN feature_mode m USING (feature_name) LEFT JOIN commonest c USING (category, feature_name)"""
_VALIDATED = r"""SELECT uid, category, feature_name, feature_type, confidence, layer, predicted_value AS before, CASE WHEN predicted_value IS NULL OR coalesce(len(allowed), 0) = 0 OR list_contains(allowed, predicted_value) THEN predicted_value
          WHEN feature_type = 'categorical' THEN coalesce(list_min(list_filter(allowed, lambda a: lower(a) = lower(predicted_value))), @CLOSE@predicted_value)
          WHEN list_contains(allowed, regexp_replace(trim(predicted_value), '\s+', ' ', 'g')) THEN regexp_replace(trim(predicted_value), '\s+', ' ', 'g')
          ELSE predicted_value END AS predicted_value FROM @ROWS@"""

_C = {
    "labelled_work": """SELECT l.uid, l.feature_name, category, w.feature_type, predicted_value, confidence, layer
        FROM labels l JOIN waterfall w USING (uid, feature_name)""",
    "commonest": """SELECT category, feature_name, value, n FROM (SELECT category, feature_name, value, n, row_number() OVER (PARTITION BY category, feature_name ORDER BY n DESC, value) AS rn
        FROM slot_values JOIN (SELECT feature_name, value, count(*) AS n FROM slot_values GROUP BY 1, 2) USING (feature_name, value)) WHERE rn = 1""",
    "filled": _FILLED.replace("@ROWS@", "labelled_work"),
    "validated": _VALIDATED.replace("@ROWS@", "filled").replace("@CLOSE@", ""),
    "validated_fuzzy": _VALIDATED.replace("@ROWS@", "filled").replace("@CLOSE@", closest_sql("predicted_value", 0.75) + ", "),
    "filled_all": _FILLED.replace("@ROWS@", "waterfall_fuzzy"),
    "validated_all": _VALIDATED.replace("@ROWS@", "filled_all").replace("@CLOSE@", closest_sql("predicted_value", 0.75) + ", "),
    "matched": """SELECT v.uid, v.feature_name, v.feature_type, v.layer, CASE WHEN v.predicted_value = l.feature_value THEN 1.0 ELSE 0.0 END AS correct
        FROM validated v JOIN labels l USING (uid, feature_name)""",
    "by_feature": "SELECT feature_name, round(avg(correct), 6) AS accuracy, count(*) AS n FROM matched GROUP BY feature_name",
    "template_waterfall": """SELECT t.uid, t.feature_name, t.template_pos, t.feature_type, coalesce(c1, c2, c3, c4, c5, c6, c7, c8, c9) AS predicted_value FROM template t JOIN by_rules USING (uid, feature_name)""",
    "given": """SELECT uid, feature_name FROM template_waterfall WHERE feature_name <> 'Farbe' UNION ALL SELECT uid, feature_name FROM labels WHERE feature_name = 'Farbe'""",
    "key_counts": """SELECT coalesce(w, 0) AS w, coalesce(g, 0) AS g FROM (SELECT uid, feature_name, count(*) AS w FROM template GROUP BY 1, 2)
        FULL JOIN (SELECT uid, feature_name, count(*) AS g FROM given GROUP BY 1, 2) USING (uid, feature_name)""",
}
COMPLETE = {
    "extra": {**LAYERS["extra"], **_C},
    "needs": {
        **LAYERS["needs"], "labelled_work": ["labels", "waterfall"], "commonest": ["slot_values"], "filled": ["labelled_work", "slots", "feature_mode", "commonest"],
        "validated": ["filled"], "validated_fuzzy": ["filled"], "filled_all": ["waterfall_fuzzy", "slots", "feature_mode", "commonest"], "validated_all": ["filled_all"], "matched": ["validated", "labels"], "by_feature": ["matched"], "template_waterfall": ["template", "by_rules"],
        "given": ["template_waterfall", "labels"], "key_counts": ["template", "given"],
    },
}


def sql(body, *names):
    return with_relations(body, *names, **COMPLETE)


_LINE = "SELECT '{}' AS metric, {} AS key, {} AS accuracy, {} AS n FROM {}"

PAIRS = {
    "commonest_slot_value": (commonest, sql("SELECT * FROM commonest", "commonest")),
    "fallback_fill": (fallback_all, sql(
        """SELECT uid, feature_name, CASE WHEN list_contains(allowed, m.value) THEN m.value ELSE c.value END AS predicted_value,
           CAST(CASE WHEN list_contains(allowed, m.value) THEN 0.2 ELSE 0.15 END AS DOUBLE) AS confidence, CASE WHEN list_contains(allowed, m.value) THEN 'fallback_mode' ELSE 'fallback_common' END AS layer
           FROM work LEFT JOIN feature_mode m USING (feature_name) LEFT JOIN commonest c USING (category, feature_name)""", "work", "feature_mode", "commonest")),
    "fallback_and_validate": (validate_native, sql(
        "SELECT uid, feature_name, predicted_value, CAST(confidence AS DOUBLE) AS confidence, layer, CAST(coalesce(predicted_value <> before, false) AS INTEGER) AS corrected FROM validated", "validated")),
    "validate_fuzzy": (validate_fuzzy, sql(
        "SELECT uid, feature_name, predicted_value, CAST(coalesce(predicted_value <> before, false) AS INTEGER) AS corrected FROM validated_fuzzy", "validated_fuzzy")),
    "full_rule_run": (full_rule_run, sql(
        "SELECT uid, category, feature_name, feature_type, predicted_value, CAST(confidence AS DOUBLE) AS confidence, layer FROM validated_all", "validated_all")),
    "match_truth": (lambda s, d: matched(s, d).select("uid", "feature_name", "correct"), sql("SELECT uid, feature_name, CAST(correct AS DOUBLE) AS correct FROM matched", "matched")),
    "accuracy": (lambda s, d: rounded(S.accuracy(matched(s, d))), sql("SELECT round(avg(correct), 6) AS accuracy, count(*) AS n FROM matched", "matched")),
    "accuracy_by_type": (accuracy_by_type, sql("SELECT feature_type, round(avg(correct), 6) AS accuracy, count(*) AS n FROM matched GROUP BY 1", "matched")),
    "accuracy_by_feature": (lambda s, d: rounded(S.accuracy_by_feature(matched(s, d))), sql("SELECT * FROM by_feature", "by_feature")),
    "worst_features": (lambda s, d: rounded(S.worst_features(S.accuracy_by_feature(matched(s, d)))), sql("SELECT * FROM by_feature ORDER BY accuracy, feature_name LIMIT 15", "by_feature")),
    "best_features": (lambda s, d: rounded(S.best_features(S.accuracy_by_feature(matched(s, d)))), sql("SELECT * FROM by_feature ORDER BY accuracy DESC, feature_name DESC LIMIT 10", "by_feature")),
    "evaluation": (lambda s, d: rounded(S.evaluate(validated(s, d), D.labels(s, d))), sql(" UNION ALL ".join([
        _LINE.format("overall", "'all'", "round(avg(correct), 6)", "count(*)", "matched"),
        _LINE.format("type", "feature_type", "round(avg(correct), 6)", "count(*)", "matched GROUP BY feature_type"),
        _LINE.format("feature", "feature_name", "accuracy", "n", "by_feature"),
        "SELECT * FROM (" + _LINE.format("worst", "feature_name", "accuracy", "n", "by_feature ORDER BY accuracy, feature_name LIMIT 15") + ")",
        "SELECT * FROM (" + _LINE.format("best", "feature_name", "accuracy", "n", "by_feature ORDER BY accuracy DESC, feature_name DESC LIMIT 10") + ")",
    ]), "matched", "by_feature")),
    "layer_contribution": (lambda s, d: rounded(S.layer_contribution(validated(s, d), D.labels(s, d))), sql(
        "SELECT layer, count(*) AS n, round(avg(correct), 6) AS accuracy FROM matched GROUP BY layer", "matched")),
    "run_counts": (run_counts, sql(
        """SELECT 'open_before_fallback' AS metric, count(*) AS n FROM labelled_work WHERE predicted_value IS NULL
           UNION ALL SELECT 'open_after_fallback', count(*) FROM filled WHERE predicted_value IS NULL
           UNION ALL SELECT 'corrected', count(*) FROM validated WHERE predicted_value <> before
           UNION ALL SELECT 'empty_output', count(*) FROM validated WHERE coalesce(predicted_value, '') = ''""", "labelled_work", "filled", "validated")),
    "filled_template": (filled_template, sql(
        """SELECT template_pos, uid, feature_name, coalesce(v, '') AS feature_value, feature_type FROM template
           LEFT JOIN (SELECT uid, feature_name, arg_min_null(predicted_value, template_pos) AS v FROM template_waterfall GROUP BY 1, 2) USING (uid, feature_name)""", "template_waterfall", "template")),
    "labelled_output": (labelled_output, sql("SELECT uid, feature_name, coalesce(predicted_value, '') AS feature_value, feature_type FROM labelled_work", "labelled_work")),
    "submission_check": (submission_check, sql(
        """SELECT 'missing_columns' AS problem, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'missing_keys', count(*) FROM key_counts WHERE w > 0 AND g = 0
           UNION ALL SELECT 'unknown_keys', count(*) FROM key_counts WHERE w = 0 AND g > 0 UNION ALL SELECT 'repeated_keys', count(*) FROM key_counts WHERE w > 0 AND g > w""", "key_counts")),
    "stored_run_val": (stored_run("val"), sql(
        """SELECT uid, feature_name, coalesce(predicted_value, '') AS feature_value, v.feature_type
           FROM validated_fuzzy v JOIN labels USING (uid, feature_name) WHERE split = 'val'""", "validated_fuzzy", "labels")),
    "stored_run_test": (stored_run("test"), sql(
        """SELECT uid, feature_name, coalesce(predicted_value, '') AS feature_value, t.feature_type
           FROM template t LEFT JOIN validated_all USING (uid, feature_name)""", "validated_all", "template")),
    "full_validation_run": (full_validation_run, None),
}
