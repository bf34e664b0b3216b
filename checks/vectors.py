"""Vector matching on the embeddings table and on titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.layers import LAYERS, slots
from checks.relations import with_relations
from merkmal.operators import lookups as L, vectors as V
from merkmal.operators.waterfall import predict_by_rules
from merkmal.session import cut_lineage
from merkmal.sources import derived as D


def sides(spark, sf):
    """Even vectors are values, odd ones texts; the label is the slot."""
    rows = D.read_table(spark, sf, "embeddings").select("label", "vec_id", F.col("embedding").alias("vec"))
    texts = rows.filter("vec_id % 2 = 1").select("label", F.col("vec_id").alias("uid"), "vec")
    values = rows.filter("vec_id % 2 = 0").select("label", F.format_string("v%06d", "vec_id").alias("value"), "vec")
    return texts, values


def normalised(spark, sf):
    rows = D.read_table(spark, sf, "embeddings")
    return rows.select("vec_id", F.posexplode(V.normalised(F.col("embedding"))).alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x")
    )


def best_in_slot(threshold):
    def query(spark, sf):
        texts, values = sides(spark, sf)
        return V.best_in_slot(texts, values, ["label"], threshold).select("label", "uid", "value", F.round("similarity", 6).alias("similarity"))

    return query


def title_vectors(spark, sf):
    found = D.products(spark, sf).select("uid", F.posexplode(V.trigram_vector(F.col("title"))).alias("pos", "x"))
    return found.filter("x > 0").select("uid", F.col("pos").cast("bigint").alias("pos"), "x")


def semantic_layer(spark, sf):
    known, products = slots(spark, sf), D.products(spark, sf)
    lookup = L.title_lookup(D.labels(spark, sf).filter("split = 'train'"), products)
    rows = predict_by_rules(D.request_rows(products, known), known, lookup, fuzzy=False)
    rows = cut_lineage(rows.select("uid", "category", "feature_name", "title", "predicted_value", "confidence", "layer"))  # read twice, as in ``predict``
    done = V.semantic_layer(rows, known, threshold=0.3)
    return done.select("uid", "feature_name", "predicted_value", F.round("confidence", 6).alias("confidence"), "layer")


def _vector(text):
    padded = f"(' ' || lower({text}) || ' ')"
    code = lambda k: f"unicode(substring({padded}, i + {k}, 1))"
    gram = f"list_transform(range(1, length({padded}) - 1), lambda i: ({code(0)} * 961 + {code(1)} * 31 + {code(2)}) % 64)"
    return f"list_transform(range(0, 64), lambda d: CAST(len(list_filter({gram}, lambda b: b = d)) AS DOUBLE))"


_V = {
    "asked_titles": "SELECT DISTINCT w.category, w.feature_name, p.title FROM waterfall w JOIN products p USING (uid) WHERE predicted_value IS NULL",
    "title_vec": f"SELECT title, {_vector('title')} AS v FROM (SELECT DISTINCT title FROM asked_titles)",
    "value_vec": f"SELECT value, {_vector('value')} AS v FROM (SELECT DISTINCT value FROM slot_values)",
    "closest": """SELECT category, feature_name, title, value, similarity FROM (
        SELECT a.category, a.feature_name, a.title, s.value, list_cosine_similarity(t.v, u.v) AS similarity,
          row_number() OVER (PARTITION BY a.category, a.feature_name, a.title ORDER BY round(list_cosine_similarity(t.v, u.v), 9) DESC, s.value) AS rn
        FROM asked_titles a JOIN title_vec t USING (title) JOIN slot_values s USING (category, feature_name) JOIN value_vec u ON u.value = s.value) WHERE rn = 1 AND similarity >= 0.3""",
}
_N = {"asked_titles": ["waterfall", "products"], "title_vec": ["asked_titles"], "value_vec": ["slot_values"], "closest": ["title_vec", "value_vec"]}
VECTORS = {"extra": {**LAYERS["extra"], **_V}, "needs": {**LAYERS["needs"], **_N}}


def _best_sql(threshold):
    return f"""SELECT t.label, t.vec_id AS uid, CASE WHEN s >= {threshold} THEN value END AS value, round(s, 6) AS similarity FROM (
        SELECT t.label, t.vec_id, printf('v%06d', v.vec_id) AS value, s, row_number() OVER (PARTITION BY t.vec_id ORDER BY s DESC, v.vec_id) AS rn
        FROM (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 2 = 1) t
        JOIN (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 2 = 0) v USING (label),
        LATERAL (SELECT list_cosine_similarity(t.e, v.e) AS s)) t WHERE rn = 1"""


PAIRS = {
    "normalised_vectors": (normalised, """SELECT vec_id, CAST(generate_subscripts(e, 1) - 1 AS BIGINT) AS pos, round(unnest(e), 6) AS x FROM (
        SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS e FROM embeddings)"""),
    "closest_vector_in_slot": (best_in_slot(V.SEMANTIC_THRESHOLD), _best_sql(V.SEMANTIC_THRESHOLD)),
    "closest_vector_any_similarity": (best_in_slot(-1.0), _best_sql(-1.0)),
    "title_trigram_vectors": (title_vectors, with_relations(
        f"SELECT * FROM (SELECT uid, CAST(generate_subscripts(v, 1) - 1 AS BIGINT) AS pos, unnest(v) AS x FROM (SELECT uid, {_vector('title')} AS v FROM products)) WHERE x > 0", "products")),
    "semantic_layer": (semantic_layer, with_relations(
        """SELECT uid, w.feature_name, coalesce(predicted_value, c.value) AS predicted_value, round(CASE WHEN predicted_value IS NULL AND c.value IS NOT NULL THEN similarity ELSE confidence END, 6) AS confidence,
             CASE WHEN predicted_value IS NULL AND c.value IS NOT NULL THEN 'semantic' ELSE layer END AS layer
           FROM waterfall w JOIN products p USING (uid) LEFT JOIN closest c ON c.category = w.category AND c.feature_name = w.feature_name AND c.title = p.title AND w.predicted_value IS NULL""",
        "waterfall", "closest", **VECTORS)),
}
