"""Numbers, units, short formats and text columns over the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.layers import closest_sql
from checks.relations import german, with_relations
from merkmal.functions import measures as M, text as X
from merkmal.operators import complete as C
from merkmal.operators.fuzzy import closest_by_edits as closest_edits
from merkmal.operators.taxonomy import build_slots, with_slots
from merkmal.sources import derived as D


def texts(spark, sf):
    return D.products(spark, sf).withColumn("text", X.rule_text())


def value_column(column):
    """Query: one value per product, where the text has one."""

    def query(spark, sf):
        return texts(spark, sf).select("uid", column(F.col("text")).alias("value")).filter("value is not null")

    return query


def rule_text(spark, sf):
    return texts(spark, sf).select("uid", "text")


def classifier_text_plain(spark, sf):
    return D.products(spark, sf).select("uid", X.plain_text().alias("text"))


def classifier_text_piped(spark, sf):
    return D.document_catalog(spark, sf).select("uid", X.piped_text().alias("text"))


def german_decimals(spark, sf):
    return texts(spark, sf).select("uid", X.german_decimals(F.col("text")).alias("text"))


def measured(unit):
    def query(spark, sf):
        found = texts(spark, sf).select("uid", F.posexplode(M.measurements(F.col("text"), unit)).alias("pos", "value"))
        return found.select("uid", F.col("pos").cast("bigint").alias("pos"), "value")

    return query


def unit_conversion(spark, sf):
    """Every weight and length of the catalog in every related unit."""
    number = F.lit(r"(?iU)(\d+\.?\d*)\s*(mm|cm|m|kg|g|ml|l)(?![\p{L}\p{N}_])")
    clean = X.german_decimals(F.col("text"))
    every = F.arrays_zip(F.regexp_extract_all(clean, number, F.lit(1)).alias("n"), F.regexp_extract_all(clean, number, F.lit(2)).alias("u"))
    found = texts(spark, sf).select("uid", F.explode(every).alias("m")).select(
        "uid", F.col("m.n").cast("double").alias("n"), F.lower("m.u").alias("from_unit_seen")
    )
    wanted = found.withColumn("target", F.explode(F.array(*[F.lit(u) for u in ("mm", "cm", "m", "g", "kg", "l", "ml")])))
    return M.convert_units(wanted, "n", "from_unit_seen", "target").select(
        "uid", "from_unit_seen", "target", F.round("converted", 6).alias("converted")
    )


def number_format(spark, sf):
    price = D.read_table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 8).alias("x"))
    return price.select(F.col("p_partkey").alias("uid"), M.format_number(F.col("x")).alias("value"))


def _labels_with_slots(spark, sf):
    slots = build_slots(D.taxonomy(spark, sf))
    rows = D.labels(spark, sf).join(D.products(spark, sf).select("uid", "category"), "uid")
    return with_slots(rows, slots, ["allowed"])


def _written(rows):
    """Label values as people write them: other case, doubled blanks."""
    odd = F.col("uid") % 3
    value = F.when(odd == 0, F.upper("feature_value")).when(odd == 1, F.replace("feature_value", F.lit(" "), F.lit("  "))).otherwise(F.col("feature_value"))
    return rows.withColumn("written", value)


_WRITTEN = """SELECT uid, category, feature_name, feature_type, coalesce(allowed, []) AS allowed,
  CASE uid % 3 WHEN 0 THEN upper(feature_value) WHEN 1 THEN replace(feature_value, ' ', '  ') ELSE feature_value END AS written
  FROM labels JOIN products USING (uid) LEFT JOIN slots USING (category, feature_name)"""
_W = {"extra": {"written_labels": _WRITTEN}, "needs": {"written_labels": ["labels", "products", "slots"]}}


def snap_categorical_native(spark, sf):
    rows = _written(_labels_with_slots(spark, sf)).filter("feature_type = 'categorical'")
    return C.add_snapped(rows, "written", "snapped", 0.85, fuzzy=False).select("uid", "feature_name", "written", "snapped")


def snap_categorical_fuzzy(spark, sf):
    rows = _written(_labels_with_slots(spark, sf)).filter("feature_type = 'categorical'")
    return C.add_snapped(rows, "written", "snapped", 0.6).select("uid", "feature_name", "written", "snapped")


def snap_numeric(spark, sf):
    rows = _written(_labels_with_slots(spark, sf)).filter("feature_type = 'numeric'")
    return rows.select("uid", "feature_name", "written", C.snap_number(F.col("written")).alias("snapped"))


def closest_by_edits(spark, sf):
    rows = _written(_labels_with_slots(spark, sf)).select("uid", "feature_name", "written", "allowed")
    found = closest_edits(rows, "written", 0.6)
    return found.select("uid", "feature_name", "closest", F.round("similarity", 6).alias("similarity"))


_TEXTS = {"extra": {"texts": "SELECT uid, coalesce(title, '') || ' ' || coalesce(description, '') AS text FROM products"}, "needs": {"texts": ["products"]}}


def value_sql(expression):
    return with_relations(f"SELECT * FROM (SELECT uid, {expression} AS value FROM texts) WHERE value IS NOT NULL", "texts", **_TEXTS)


def first(pattern, group=1, source="text"):
    return f"nullif(regexp_extract({source}, '{pattern}', {group}), '')"


def measured_sql(unit, others):
    """``others``: (unit, factor) in the order they are tried."""
    clean = german("text")
    number = r"(\d+\.?\d*)\s*"
    direct = f"regexp_extract_all({clean}, '(?i){number}{unit}\\b', 1)"

    def shown(x):
        return (f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS STRING) "
                f"ELSE regexp_replace(regexp_replace(printf('%.4f', {x}), '0+$', ''), '\\.$', '') END")

    converted = ", ".join(
        shown(f"(CAST({first(f'(?i){number}{o}' + chr(92) + 'b', 1, clean)} AS DOUBLE) * {f})") for o, f in others
    )
    return with_relations(
        f"""SELECT uid, unnest(v) AS value, CAST(generate_subscripts(v, 1) - 1 AS BIGINT) AS pos FROM (SELECT uid, CASE WHEN len({direct}) > 0
          THEN list_transform({direct}, lambda n: n || ' {unit}') ELSE list_filter([coalesce({converted}) || ' {unit}'], lambda x: x IS NOT NULL) END AS v FROM texts)""",
        "texts", **_TEXTS)


_DRIVE = r"(?i)\b(PZ|PH|TX|T)\s*(\d+)\b"
_FACTORS = "(VALUES " + ", ".join(f"('{a}', '{b}', CAST({f!r} AS DOUBLE))" for a, b, f, _ in M.unit_factor_rows()) + ") f(a, b, factor)"
_MEASURE = r"(?i)(\d+\.?\d*)\s*(mm|cm|m|kg|g|ml|l)\b"

PAIRS = {
    "rule_text": (rule_text, with_relations("SELECT uid, text FROM texts", "texts", **_TEXTS)),
    "classifier_text_plain": (classifier_text_plain, with_relations("SELECT uid, text FROM texts", "texts", **_TEXTS)),
    "classifier_text_piped": (classifier_text_piped, with_relations(
        "SELECT uid, replace(category, '_', ' ') || ' | ' || title || ' | ' || description AS text FROM document_catalog", "document_catalog")),
    "german_decimals": (german_decimals, with_relations(f"SELECT uid, {german('text')} AS text FROM texts", "texts", **_TEXTS)),
    "unit_conversion": (unit_conversion, with_relations(
        rf"""SELECT uid, u AS from_unit_seen, target, round(CASE WHEN u = target THEN n ELSE n * factor END, 6) AS converted FROM (
          SELECT uid, n, u, unnest(['mm', 'cm', 'm', 'g', 'kg', 'l', 'ml']) AS target FROM (
            SELECT uid, CAST(unnest(regexp_extract_all(t, '{_MEASURE}', 1)) AS DOUBLE) AS n, lower(unnest(regexp_extract_all(t, '{_MEASURE}', 2))) AS u
            FROM (SELECT uid, {german('text')} AS t FROM texts)))
          LEFT JOIN {_FACTORS} ON u = a AND target = b""", "texts", **_TEXTS)),
    "number_format": (number_format, r"""SELECT p_partkey AS uid, CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS STRING)
        ELSE regexp_replace(regexp_replace(printf('%.4f', x), '0+$', ''), '\.$', '') END AS value FROM (SELECT p_partkey, p_retailprice / 8 AS x FROM part)"""),
    "measurements_cm": (measured("cm"), measured_sql("cm", [("mm", 0.1), ("m", 100)])),
    "measurements_kg": (measured("kg"), measured_sql("kg", [("g", 0.001)])),
    "thread_size": (value_column(M.thread_size), value_sql("'M ' || " + first(r"\bM\s*(\d+(?:\.\d+)?)\b", 1, german("text")))),
    "scale_format": (value_column(M.scale), value_sql("':' || " + first(r"1\s*[:/]\s*(\d+)"))),
    "drive_size": (value_column(M.drive_size), value_sql(f"replace(upper({first(_DRIVE)}), 'TX', 'T') || ' ' || {first(_DRIVE, 2)}")),
    "prefixed_value": (value_column(lambda t: M.prefixed_value(t, "Gewicht: ", "kg")), value_sql(
        "'Gewicht: ' || " + german(first(r"Gewicht: \s*(\d+[.,]?\d*)\s*kg")) + " || ' kg'")),
    "snap_categorical": (snap_categorical_native, with_relations(
        """SELECT uid, feature_name, written, CASE WHEN list_contains(allowed, written) THEN written
             ELSE list_min(list_filter(allowed, lambda a: lower(a) = lower(written))) END AS snapped FROM written_labels WHERE feature_type = 'categorical'""", "written_labels", **_W)),
    "snap_categorical_fuzzy": (snap_categorical_fuzzy, with_relations(
        f"""SELECT uid, feature_name, written, CASE WHEN list_contains(allowed, written) THEN written
             ELSE coalesce(list_min(list_filter(allowed, lambda a: lower(a) = lower(written))), {closest_sql("written", 0.6)}) END AS snapped FROM written_labels WHERE feature_type = 'categorical'""", "written_labels", **_W)),
    "snap_numeric": (snap_numeric, with_relations(
        r"""SELECT uid, feature_name, written, CASE WHEN NOT list_contains(allowed, written) AND list_contains(allowed, flat) THEN flat ELSE written END AS snapped
           FROM (SELECT *, regexp_replace(trim(written), '\s+', ' ', 'g') AS flat FROM written_labels WHERE feature_type = 'numeric')""", "written_labels", **_W)),
    "closest_by_edits": (closest_by_edits, with_relations(
        """SELECT uid, feature_name, b.v AS closest, round(b.s, 6) AS similarity FROM (SELECT uid, feature_name, list_sort(list_filter(list_transform(allowed,
             lambda a: {'s': 1 - levenshtein(written, a) / greatest(length(a), length(written)), 'v': a}), lambda e: e.s >= 0.6))[-1] AS b FROM written_labels)""", "written_labels", **_W)),
}
