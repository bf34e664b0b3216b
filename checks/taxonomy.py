"""Taxonomy, sources and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.relations import with_relations
from merkmal.operators import lookups, taxonomy as T
from merkmal.session import scratch_path
from merkmal.sources import catalog, derived as D


def slots(spark, sf):
    return T.build_slots(D.taxonomy(spark, sf))


def joined(column):
    return F.array_join(column, "|")


def taxonomy_values(spark, sf):
    rows = D.taxonomy(spark, sf)
    return rows.select("category", "feature_name", "row_pos", joined(T.parse_values(F.col("aggregated_feature_values"))).alias("parsed_values"))


def taxonomy_slots(spark, sf):
    return slots(spark, sf).select("category", "feature_name", "slot_type", joined("allowed").alias("allowed"), "unit")


def slot_values(spark, sf):
    return T.slot_values(slots(spark, sf)).select("category", "feature_name", "slot_type", F.col("pos").cast("bigint").alias("pos"), "value", "value_lower")


def slot_lookup(spark, sf):
    rows = D.labels(spark, sf).join(D.products(spark, sf), "uid").select("uid", "category", "feature_name")
    found = T.with_slots(rows, slots(spark, sf), ["slot_type", "unit", "allowed"])
    return found.select("uid", "category", "feature_name", "slot_type", "unit", joined("allowed").alias("allowed"))


def dominant_units(spark, sf):
    return slots(spark, sf).filter("unit is not null").select("category", "feature_name", "unit")


def _own_rows(spark, sf):
    """Labels as if every product had the features of its title's family only:
    the feature of another category shows up where it is not in the taxonomy."""
    labels = D.labels(spark, sf).join(D.products(spark, sf).select("uid", "category"), "uid")
    norm = D.products(spark, sf).select("uid", F.lit("Norm").alias("feature_name"), F.lit("DIN 933").alias("feature_value"), F.lit("categorical").alias("feature_type"), "category")
    return labels.drop("split").unionByName(norm)


_OWN = """SELECT uid, feature_name, feature_value, feature_type, category FROM labels JOIN products USING (uid)
  UNION ALL SELECT uid, 'Norm', 'DIN 933', 'categorical', category FROM products"""


def features_outside_taxonomy(spark, sf):
    return T.rows_outside_taxonomy(_own_rows(spark, sf), slots(spark, sf)).select("uid", "category", "feature_name")


def value_format_violations(spark, sf):
    return T.format_violations(_own_rows(spark, sf), slots(spark, sf)).select("uid", "feature_name", "feature_value", "problem")


def stored_catalog(spark, sf):
    root = scratch_path(spark, "catalog")
    products, labels = D.with_split(D.products(spark, sf)), D.labels(spark, sf)
    for split in catalog.SPLITS:
        products.filter(F.col("split") == split).drop("split").write.parquet(f"{root}/{split}/products.parquet")
    for split in ("train", "val"):
        labels.filter(F.col("split") == split).drop("split").write.parquet(f"{root}/{split}/product_features.parquet")
    template = D.template(spark, sf).orderBy("template_pos").drop("template_pos")
    template.write.parquet(f"{root}/test/submission.parquet")
    D.taxonomy(spark, sf).orderBy("row_pos").drop("row_pos").write.parquet(f"{root}/taxonomy/taxonomy.parquet")
    return root


def stored_splits(spark, sf):
    root = stored_catalog(spark, sf)
    frames = []
    for split in catalog.SPLITS:
        products, labels = catalog.read_split(spark, root, split)
        rows = products.join(labels, "uid") if labels is not None else products.withColumns(
            {c: F.lit(None).cast("string") for c in ("feature_name", "feature_value", "feature_type")}
        )
        frames.append(rows.select(F.lit(split).alias("split"), "uid", "category", "title", "description", "feature_name", "feature_value"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def stored_taxonomy(spark, sf):
    found = T.build_slots(catalog.read_taxonomy(spark, stored_catalog(spark, sf)))
    return found.select("category", "feature_name", "slot_type", joined("allowed").alias("allowed"), "unit")


def stored_template(spark, sf):
    from merkmal.operators.scale import global_rank

    rows = catalog.read_template(spark, stored_catalog(spark, sf)).select("uid", "feature_name", "feature_type", "feature_value", "template_pos.*")
    return global_rank(rows, ["file_path", "row_index"], "place").select("uid", "feature_name", "feature_type", "feature_value", "place")


def labels_with_products(spark, sf):
    return lookups.labelled_products(D.labels(spark, sf), D.products(spark, sf)).select("uid", "feature_name", "feature_value", "category", "title", "description")


def template_with_products(spark, sf):
    return catalog.work_rows(D.template(spark, sf), D.products(spark, sf)).select("template_pos", "uid", "feature_name", "category", "title", "description")


def trial_rows(spark, sf):
    rows = catalog.work_rows(D.labels(spark, sf), D.products(spark, sf))
    return catalog.trial_rows(rows, 500).select("uid", "feature_name", "title")


def title_lookup(spark, sf):
    labels = D.labels(spark, sf).filter("split = 'train'")
    return lookups.title_lookup(labels, D.products(spark, sf)).select("feature_name", "title", "value", "n")


def feature_mode(spark, sf):
    return lookups.feature_mode(D.labels(spark, sf).filter("split = 'train'")).select("feature_name", "value", "n")


def title_lookup_layer(spark, sf):
    labels = D.labels(spark, sf).filter("split = 'train'")
    products = D.products(spark, sf)
    rows = T.with_slots(D.request_rows(products, slots(spark, sf)), slots(spark, sf), ["allowed"])
    found = lookups.add_title_lookup(rows, lookups.title_lookup(labels, products), "value")
    return found.filter("value is not null").select("uid", "feature_name", "value")


PAIRS = {
    "taxonomy_values": (taxonomy_values, with_relations(
        r"""SELECT category, feature_name, row_pos, array_to_string(list_filter(regexp_extract_all(aggregated_feature_values, '\[([^\]]*)\]', 1), lambda v: v <> ''), '|') AS parsed_values FROM taxonomy""", "taxonomy")),
    "taxonomy_slots": (taxonomy_slots, with_relations("SELECT category, feature_name, slot_type, array_to_string(allowed, '|') AS allowed, unit FROM slots", "slots")),
    "taxonomy_slot_values": (slot_values, with_relations("SELECT category, feature_name, slot_type, CAST(pos AS BIGINT) AS pos, value, lower(value) AS value_lower FROM slot_values", "slot_values")),
    "taxonomy_slot_lookup": (slot_lookup, with_relations(
        """SELECT uid, category, feature_name, slot_type, unit, coalesce(array_to_string(allowed, '|'), '') AS allowed
           FROM labels JOIN products USING (uid) LEFT JOIN slots USING (category, feature_name)""", "labels", "products", "slots")),
    "taxonomy_dominant_unit": (dominant_units, with_relations("SELECT * FROM slot_units", "slot_units")),
    "taxonomy_value_frequency": (lambda s, d: T.value_frequency(slots(s, d)), with_relations(
        "SELECT feature_name, value, count(*) AS n FROM slot_values GROUP BY 1, 2", "slot_values")),
    "taxonomy_sizes": (lambda s, d: T.taxonomy_sizes(slots(s, d)), with_relations(
        """SELECT (SELECT count(*) FROM slots) AS n_slots, (SELECT count(DISTINCT category) FROM slots) AS n_categories,
           (SELECT count(DISTINCT value) FROM slot_values WHERE slot_type = 'categorical') AS n_categorical_values""", "slot_values")),
    "taxonomy_reverse_index": (lambda s, d: T.reverse_index(slots(s, d)), with_relations(
        """SELECT value_lower, category, feature_name, count(*) OVER (PARTITION BY value_lower) AS n_slots
           FROM (SELECT DISTINCT lower(value) AS value_lower, category, feature_name FROM slot_values)""", "slot_values")),
    "taxonomy_distinct_values": (lambda s, d: T.distinct_values(slots(s, d)), with_relations("SELECT DISTINCT value FROM slot_values", "slot_values")),
    "features_outside_taxonomy": (features_outside_taxonomy, with_relations(
        "SELECT uid, category, feature_name FROM own WHERE NOT EXISTS (SELECT 1 FROM slots s WHERE s.category = own.category AND s.feature_name = own.feature_name)",
        "own", "slots", extra={"own": _OWN}, needs={"own": ["labels", "products"]})),
    "value_format_violations": (value_format_violations, with_relations(
        """SELECT uid, feature_name, feature_value, problem FROM (SELECT own.*, CASE
             WHEN feature_type = 'categorical' THEN CASE WHEN len(allowed) > 0 AND NOT list_contains(allowed, feature_value) THEN 'value not listed' END
             WHEN unit IS NOT NULL AND NOT suffix(feature_value, ' ' || unit) THEN 'unit missing' END AS problem
           FROM own LEFT JOIN slots USING (category, feature_name)) WHERE problem IS NOT NULL""",
        "own", "slots", extra={"own": _OWN}, needs={"own": ["labels", "products"]})),
    "stored_splits": (stored_splits, with_relations(
        """SELECT split, uid, category, title, description, feature_name, feature_value FROM labels JOIN products USING (uid)
           UNION ALL SELECT 'test', uid, category, title, description, NULL, NULL FROM products WHERE CAST(floor(uid / 16) AS BIGINT) % 10 = 9""", "labels", "products")),
    "stored_taxonomy": (stored_taxonomy, with_relations("SELECT category, feature_name, slot_type, array_to_string(allowed, '|') AS allowed, unit FROM slots", "slots")),
    "stored_template": (stored_template, with_relations(
        "SELECT uid, feature_name, feature_type, feature_value, row_number() OVER (ORDER BY template_pos) AS place FROM template", "template")),
    "labels_with_products": (labels_with_products, with_relations(
        "SELECT uid, feature_name, feature_value, category, title, description FROM labels JOIN products USING (uid)", "labels", "products")),
    "template_with_products": (template_with_products, with_relations(
        "SELECT template_pos, uid, feature_name, category, title, description FROM template JOIN products USING (uid)", "template", "products")),
    "trial_rows": (trial_rows, with_relations(
        "SELECT uid, feature_name, title FROM labels JOIN products USING (uid) ORDER BY uid, feature_name LIMIT 500", "labels", "products")),
    "title_lookup": (title_lookup, with_relations("SELECT feature_name, title, value, n FROM title_lookup", "title_lookup")),
    "feature_mode": (feature_mode, with_relations("SELECT feature_name, value, n FROM feature_mode", "feature_mode")),
    "title_lookup_layer": (title_lookup_layer, with_relations(
        "SELECT uid, feature_name, value FROM work JOIN title_lookup USING (feature_name, title) WHERE len(allowed) = 0 OR list_contains(allowed, value)", "work", "title_lookup")),
}
