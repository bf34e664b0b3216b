"""Hard rows, prompt batches, replies and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.layers import LAYERS, rule_waterfall, slots
from checks.relations import with_relations
from merkmal.operators import batches as B
from merkmal.sources import derived as D


def predicted(spark, sf):
    return rule_waterfall(spark, sf)


def hard_rows(spark, sf):
    return B.hard_rows(predicted(spark, sf)).select("hard_rank", "uid", "feature_name")


def batches(spark, sf):
    """All products in batches."""
    return B.product_batches(D.products(spark, sf))


def product_batches(spark, sf):
    found = batches(spark, sf)
    return found.select("batch_id", "idx", "category", "uid", F.col("within_budget").cast("int").alias("within_budget"))


def prompts(spark, sf):
    return B.prompts(batches(spark, sf), slots(spark, sf)).select("batch_id", "category", "n_products", "instruction", "prompt")


def replies(spark, sf):
    """Replies made from the batches by rule: an array, an array inside other text,
    one object short, broken. Tokens follow the prompt's length."""
    line = F.concat(F.lit('{"Material": "M'), F.col("uid").cast("string"), F.lit('", "Farbe": null}'))
    grouped = batches(spark, sf).groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("idx", line.alias("l")))).alias("o"))
    lines = F.transform("o", lambda x: x["l"])
    whole = F.concat(F.lit("["), F.array_join(lines, ", "), F.lit("]"))
    short = F.concat(F.lit("["), F.array_join(F.slice(lines, 2, 100), ", "), F.lit("]"))
    kind = F.col("batch_id") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), whole, F.lit("\n")))
        .when(kind == 1, F.concat(F.lit("Here it is:\n```json\n"), whole, F.lit("\n```")))
        .when(kind == 2, short)
        .otherwise(F.concat(F.lit("["), F.array_join(lines, ", ")))
    )
    return grouped.select("batch_id", text.alias("response"), F.length(text).cast("bigint").alias("input_tokens"), (F.size("o") * 12).cast("bigint").alias("output_tokens"))


def parsed_replies(spark, sf):
    found = replies(spark, sf).select("batch_id", F.coalesce(F.size(B.parse_reply(F.col("response"))), F.lit(-1)).alias("n"))
    return found.select("batch_id", F.when(F.col("n") >= 0, F.col("n")).cast("bigint").alias("n_objects"))


def accepted(spark, sf):
    return B.accepted_values(batches(spark, sf), replies(spark, sf)).select("uid", "feature_name", "value")


def cost_report(spark, sf):
    return B.cost_report(replies(spark, sf))


_B = {
    "placed": "SELECT category, uid, title, row_number() OVER (PARTITION BY category ORDER BY uid) AS place FROM products",
    "batched": """SELECT dense_rank() OVER (ORDER BY category, (place - 1) // 30) AS batch_id, (place - 1) % 30 + 1 AS idx, category, uid, title FROM placed""",
    "feature_line": """SELECT category, string_agg(CASE WHEN slot_type = 'categorical'
          THEN '  "' || feature_name || '" (categorical): [' || array_to_string(list_transform(listed[1:50], lambda v: CAST(to_json(v) AS VARCHAR)), ', ') || ']'
          ELSE '  "' || feature_name || '" (numeric, e.g. ' || array_to_string(listed[1:5], ', ') || ')' END, chr(10) ORDER BY feature_name) AS features FROM slots GROUP BY category""",
    "reply": """SELECT batch_id, n, 2 * n AS k, CASE batch_id % 4 WHEN 0 THEN length(w) + 2 WHEN 1 THEN length(w) + 24 WHEN 2 THEN length(short) ELSE length(w) - 1 END AS n_chars FROM (
        SELECT batch_id, count(*) AS n, '[' || string_agg(l, ', ' ORDER BY idx) || ']' AS w, '[' || coalesce(string_agg(l, ', ' ORDER BY idx) FILTER (idx > 1), '') || ']' AS short
        FROM (SELECT batch_id, idx, '{"Material": "M' || uid || '", "Farbe": null}' AS l FROM batched) GROUP BY batch_id)""",
}
_N = {"placed": ["products"], "batched": ["placed"], "feature_line": ["slots"], "reply": ["batched"]}
BATCHES = {"extra": {**LAYERS["extra"], **_B}, "needs": {**LAYERS["needs"], **_N}}


def sql(body, *names):
    return with_relations(body, *names, **BATCHES)


PAIRS = {
    "hard_rows": (hard_rows, sql(
        """SELECT hard_rank, uid, feature_name FROM (SELECT uid, feature_name, row_number() OVER (ORDER BY confidence, uid, feature_name) AS hard_rank FROM waterfall WHERE predicted_value IS NULL)
           WHERE hard_rank <= (SELECT floor(count(*) * 0.02) FROM waterfall)""", "waterfall")),
    "product_batches": (product_batches, sql(
        "SELECT batch_id, idx, category, uid, 1 AS within_budget FROM batched", "batched")),
    "batch_prompts": (prompts, sql(
        """SELECT batch_id, category, count(*) AS n_products, 'Category: ' || category || chr(10) || 'Features to extract:' || chr(10) || any_value(features) || chr(10) || chr(10) || 'Products:' || chr(10)
             || string_agg('  ' || idx || '. ' || coalesce(title, ''), chr(10) ORDER BY idx) || chr(10) || chr(10) || 'Return JSON array. Object keys = feature names. Example format:' || chr(10)
             || '[{"feature1": "value1", "feature2": "value2"}, ...]' AS prompt, '""" + B.INSTRUCTION.replace("'", "''") + """' AS instruction
           FROM batched JOIN feature_line USING (category) GROUP BY batch_id, category""", "batched", "feature_line")),
    "parsed_replies": (parsed_replies, sql(
        "SELECT batch_id, CASE batch_id % 4 WHEN 2 THEN n - 1 WHEN 3 THEN NULL ELSE n END AS n_objects FROM reply", "reply")),
    "accepted_values": (accepted, sql(
        """SELECT uid, f.n AS feature_name, CASE f.n WHEN 'Material' THEN 'M' || uid END AS value FROM batched, (VALUES ('Material'), ('Farbe')) f(n) WHERE batch_id % 4 IN (0, 1)""", "batched")),
    "cost_report": (cost_report, sql(
        """SELECT count(*) AS total_calls, CAST(sum(n_chars) AS BIGINT) AS total_input_tokens, CAST(sum(n * 12) AS BIGINT) AS total_output_tokens, round(sum(n_chars) * 0.8 / 1000000, 4) AS input_cost_usd,
             round(sum(n * 12) * 4.0 / 1000000, 4) AS output_cost_usd, round(sum(n_chars) * 0.8 / 1000000 + sum(n * 12) * 4.0 / 1000000, 4) AS total_cost_usd FROM reply""", "reply")),
}
