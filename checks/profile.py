"""Catalog profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.relations import with_relations
from merkmal.operators import profile as P
from merkmal.sources import derived as D


def train_products(spark, sf):
    return D.with_split(D.products(spark, sf)).filter("split = 'train'")


def train_labels(spark, sf):
    return D.labels(spark, sf).filter("split = 'train'")


def tables(spark, sf):
    return {
        "products": D.products(spark, sf), "labels": D.labels(spark, sf), "template": D.template(spark, sf), "taxonomy": D.taxonomy(spark, sf),
        "order_catalog": D.order_catalog(spark, sf), "document_catalog": D.document_catalog(spark, sf),
    }


def split_counts(spark, sf):
    products = P.counts_by(D.with_split(D.products(spark, sf)), "split").withColumn("kind", F.lit("products"))
    labels = P.counts_by(D.labels(spark, sf), "split").withColumn("kind", F.lit("labels"))
    template = P.counts_by(D.template(spark, sf).withColumn("split", F.lit("test")), "split").withColumn("kind", F.lit("labels"))
    return P.union_all([products, labels, template])


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def documents(spark, sf):
    return D.document_catalog(spark, sf)


def sample_ids(spark, sf):
    return P.seeded_sample(D.order_catalog(spark, sf), 5000).select("uid")


FIVE = ["Material", "Farbe", "Ausführung", "Form", "Oberfläche"]
_SHARE = "SELECT feature_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {} GROUP BY feature_type"
_SIZES = {"sizes": "SELECT category, count(*) AS n FROM {} GROUP BY category"}
_LEN = {
    "lengths": """SELECT 'title' AS part, length(coalesce(title, '')) AS n FROM {0} UNION ALL SELECT 'description', length(coalesce(description, '')) FROM {0}""",
}


def sized(body, relation):
    return with_relations(body, relation, "sizes", extra={"sizes": _SIZES["sizes"].format(relation)})


def measured(body, relation):
    return with_relations(body, relation, "lengths", extra={"lengths": _LEN["lengths"].format(relation)})


_SUMMARY = "SELECT part, round(avg(n), 6) AS mean, quantile_cont(n, 0.5) AS median, round(quantile_cont(n, 0.99), 6) AS p99 FROM lengths GROUP BY part"
_HISTOGRAM = """SELECT part, CAST(least(floor((n - low) / CASE WHEN high > low THEN (high - low) / 60 ELSE 1 END), 59) AS BIGINT) AS bin, count(*) AS n FROM (
    SELECT part, n, min(n) OVER (PARTITION BY part) AS low, max(n) OVER (PARTITION BY part) AS high
    FROM (SELECT part, least(n, CASE part WHEN 'title' THEN 300 ELSE 3000 END) AS n FROM lengths)) GROUP BY 1, 2"""
_BUCKET = """SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 10 THEN '6-10' WHEN n <= 50 THEN '11-50' WHEN n <= 100 THEN '51-100' WHEN n <= 500 THEN '101-500'
    WHEN n <= 1000 THEN '501-1k' ELSE '>1k' END AS bucket, count(*) AS n_categories FROM sizes GROUP BY 1"""
_BINS = """SELECT CAST(least(floor((n - low) / CASE WHEN high > low THEN (high - low) / 80 ELSE 1 END), 79) AS BIGINT) AS bin, count(*) AS n
    FROM sizes, (SELECT min(n) AS low, max(n) AS high FROM sizes) GROUP BY 1"""
_COUNTS = r"SELECT category, feature_name, len(regexp_extract_all(coalesce(aggregated_feature_values, ''), '''\[.*?\]''')) AS n FROM taxonomy WHERE feature_type = 'categorical'"

# Columns and Spark types of the relations above, as they are derived.
COLUMNS = {
    "products": [("uid", "bigint"), ("category", "string"), ("title", "string"), ("description", "string")],
    "labels": [("uid", "bigint"), ("feature_name", "string"), ("feature_value", "string"), ("feature_type", "string"), ("split", "string")],
    "template": [("uid", "bigint"), ("feature_name", "string"), ("feature_value", "string"), ("feature_type", "string"), ("template_pos", "bigint")],
    "taxonomy": [("category", "string"), ("feature_name", "string"), ("feature_type", "string"), ("aggregated_feature_values", "string"), ("row_pos", "bigint")],
    "order_catalog": [("uid", "bigint"), ("category", "string"), ("title", "string"), ("description", "string")],
    "document_catalog": [("uid", "bigint"), ("category", "string"), ("title", "string"), ("description", "string")],
}

PAIRS = {
    "column_types": (lambda s, d: P.column_types(tables(s, d)), with_relations(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, count({c}) AS n_values FROM {t}"
        for t, columns in COLUMNS.items() for c, k in columns), *COLUMNS)),
    "table_overview": (lambda s, d: P.table_overview(tables(s, d)), with_relations(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({c} AS BIGINT) AS n_columns FROM {t}"
        for t, c in (("products", 4), ("labels", 5), ("template", 5), ("taxonomy", 5), ("order_catalog", 4), ("document_catalog", 4))),
        "products", "labels", "template", "taxonomy", "order_catalog", "document_catalog")),
    "split_counts": (split_counts, with_relations(
        """SELECT 'products' AS kind, CASE WHEN CAST(floor(uid / 16) AS BIGINT) % 10 < 7 THEN 'train' WHEN CAST(floor(uid / 16) AS BIGINT) % 10 < 9 THEN 'val' ELSE 'test' END AS split, count(*) AS n
           FROM products GROUP BY 1, 2 UNION ALL SELECT 'labels', split, count(*) FROM labels GROUP BY split UNION ALL SELECT 'labels', 'test', count(*) FROM template""", "products", "labels", "template")),
    "distinct_categories": (lambda s, d: P.distinct_categories(train_products(s, d), D.taxonomy(s, d)), with_relations(
        """SELECT 'train' AS source, count(DISTINCT category) AS n_categories FROM products WHERE CAST(floor(uid / 16) AS BIGINT) % 10 < 7
           UNION ALL SELECT 'taxonomy', count(DISTINCT category) FROM taxonomy""", "products", "taxonomy")),
    "top_categories": (lambda s, d: P.top_counts(documents(s, d), "category", 20), with_relations(
        "SELECT category, count(*) AS n FROM document_catalog GROUP BY category ORDER BY n DESC, category LIMIT 20", "document_catalog")),
    "category_size_buckets": (lambda s, d: P.size_buckets(documents(s, d)), sized(_BUCKET, "document_catalog")),
    "category_size_buckets_orders": (lambda s, d: P.size_buckets(D.order_catalog(s, d)), sized(_BUCKET, "order_catalog")),
    "category_size_histogram": (lambda s, d: P.category_size_histogram(documents(s, d)), sized(_BINS, "document_catalog")),
    "type_share_taxonomy": (lambda s, d: rounded(P.shares(D.taxonomy(s, d), "feature_type"), "share"), with_relations(_SHARE.format("taxonomy"), "taxonomy")),
    "type_share_labels": (lambda s, d: rounded(P.shares(train_labels(s, d), "feature_type"), "share"), with_relations(
        _SHARE.format("(SELECT * FROM labels WHERE split = 'train')"), "labels")),
    "features_per_category": (lambda s, d: P.features_per_category(D.taxonomy(s, d)), with_relations(
        "SELECT n AS n_features, count(*) AS n_categories FROM (SELECT category, count(*) AS n FROM taxonomy GROUP BY 1) GROUP BY 1", "taxonomy")),
    "top_categories_by_features": (lambda s, d: P.top_counts(D.taxonomy(s, d), "category", 10), with_relations(
        "SELECT category, count(*) AS n FROM taxonomy GROUP BY category ORDER BY n DESC, category LIMIT 10", "taxonomy")),
    "listed_value_summary": (lambda s, d: rounded(P.listed_summary(D.taxonomy(s, d)), "mean"), with_relations(
        f"SELECT round(avg(n), 6) AS mean, max(n) AS max, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median FROM ({_COUNTS})", "taxonomy")),
    "listed_value_histogram": (lambda s, d: P.listed_histogram(D.taxonomy(s, d)), with_relations(
        f"SELECT least(n, 50) AS n_values, count(*) AS n_slots FROM ({_COUNTS}) GROUP BY 1", "taxonomy")),
    "features_per_product": (lambda s, d: P.features_per_product(train_labels(s, d)), with_relations(
        "SELECT n AS n_features, count(*) AS n_products FROM (SELECT uid, count(*) AS n FROM labels WHERE split = 'train' GROUP BY 1) GROUP BY 1", "labels")),
    "features_per_product_summary": (lambda s, d: rounded(P.features_per_product_summary(train_labels(s, d)), "mean"), with_relations(
        "SELECT round(avg(n), 6) AS mean, max(n) AS max, quantile_cont(n, 0.5) AS median FROM (SELECT uid, count(*) AS n FROM labels WHERE split = 'train' GROUP BY 1)", "labels")),
    "top_feature_names": (lambda s, d: P.top_counts(train_labels(s, d), "feature_name", 25), with_relations(
        "SELECT feature_name, count(*) AS n FROM labels WHERE split = 'train' GROUP BY 1 ORDER BY n DESC, feature_name LIMIT 25", "labels")),
    "top_values_per_feature": (lambda s, d: P.top_values(train_labels(s, d), FIVE).select("feature_name", "feature_value", "n", F.col("rank").cast("bigint").alias("rank")), with_relations(
        """SELECT * FROM (SELECT feature_name, feature_value, count(*) AS n, row_number() OVER (PARTITION BY feature_name ORDER BY count(*) DESC, feature_value) AS rank FROM labels
           WHERE split = 'train' AND feature_type = 'categorical' AND feature_name IN ('Material', 'Farbe', 'Ausführung', 'Form', 'Oberfläche') GROUP BY 1, 2) WHERE rank <= 10""", "labels")),
    "text_lengths_documents": (lambda s, d: rounded(P.text_length_summary(documents(s, d)), "mean", "p99"), measured(_SUMMARY, "document_catalog")),
    "text_lengths_products": (lambda s, d: rounded(P.text_length_summary(D.products(s, d)), "mean", "p99"), measured(_SUMMARY, "products")),
    "text_length_histogram": (lambda s, d: P.text_length_histogram(documents(s, d)), measured(_HISTOGRAM, "document_catalog")),
    "seeded_sample": (sample_ids, with_relations(
        "SELECT uid FROM order_catalog ORDER BY md5(CAST(uid AS STRING) || '|42'), uid LIMIT 5000", "order_catalog")),
    "template_null_share": (lambda s, d: P.null_share(D.template(s, d)), with_relations(
        "SELECT count(*) FILTER (feature_value IS NULL) AS n_null, count(*) AS n FROM template", "template")),
    "example_products": (lambda s, d: P.example_products(train_products(s, d), train_labels(s, d)).select("uid", "feature_name", "feature_value", "category", "title"), with_relations(
        """SELECT uid, feature_name, feature_value, category, title FROM labels JOIN products USING (uid) WHERE split = 'train' AND uid IN (
           SELECT uid FROM labels WHERE split = 'train' GROUP BY uid HAVING count(*) >= 3 ORDER BY uid LIMIT 3)""", "labels", "products")),
}
