"""Hard rows as prompt batches, and replies back into rows. Tables in, tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.operators.scale import global_rank, rank_within
from merkmal.session import cut_lineage

ESCALATION_RATE = 0.02
BATCH_SIZE = 30
LISTED_VALUES, EXAMPLE_VALUES = 50, 5
INPUT_USD, OUTPUT_USD = 0.80, 4.00  # per million tokens


def hard_rows(rows: DataFrame, rate: float = ESCALATION_RATE) -> DataFrame:
    """``uid, feature_name, confidence, hard_rank`` of the open rows of lowest confidence, at most ``rate`` of all rows.

    ``rows`` are computed once: their four narrow columns are written to the shared folder, and both the count
    and the range-partitioned ranking read that copy, never the wide rows (join back by key where texts are needed).
    """
    narrow = cut_lineage(
        rows.select("uid", "feature_name", "confidence", F.col("predicted_value").isNull().alias("open"))
    )
    budget = narrow.agg(F.floor(F.count("*") * F.lit(rate)).alias("n")).first()["n"]
    ranked = global_rank(narrow.filter("open").drop("open"), ["confidence", "uid", "feature_name"], "hard_rank")
    return ranked.filter(F.col("hard_rank") <= budget)


def product_batches(rows: DataFrame, size: int = BATCH_SIZE, max_batches: int | None = None) -> DataFrame:
    """Products of the rows in batches of one category: batch_id, idx, within_budget.

    Batches are numbered by category and uid. Those beyond the budget stay in the
    table and are marked; they get empty results later.
    """
    products = rows.select("category", "uid", "title").distinct()
    placed = rank_within(products, ["category"], ["uid"], "place").withColumn(
        "batch_no", F.floor((F.col("place") - 1) / size)
    )
    counts = placed.groupBy("category").agg((F.max("batch_no") + 1).alias("n_batches"))
    ordered = global_rank(counts, ["category"], "category_no")
    # Running total over categories without a single-task window: a category starts
    # after the batches of all categories before it.
    starts = _running_total(ordered, "category_no", "n_batches", "first_batch")
    return (
        placed.join(starts.select("category", "first_batch"), "category")
        .withColumn("batch_id", F.col("first_batch") + F.col("batch_no") + 1)
        .withColumn("idx", (F.col("place") - 1) % size + 1)
        .withColumn("within_budget", F.lit(True) if max_batches is None else F.col("batch_id") <= max_batches)
        .select("batch_id", "idx", "category", "uid", "title", "within_budget")
    )


def _running_total(df: DataFrame, position: str, amount: str, out: str, width: int = 4096) -> DataFrame:
    """Sum of ``amount`` over smaller positions: totals per stretch of ``width``
    positions first, then inside each stretch."""
    from pyspark.sql import Window

    cut = df.withColumn("_stretch", F.floor((F.col(position) - 1) / width))
    totals = cut.groupBy("_stretch").agg(F.sum(amount).alias("_n"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_stretch").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(F.broadcast(base), "_stretch")  # one row per 4096 categories
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_stretch", "_base")
    )


def _json_list(values: Column) -> Column:
    """JSON array text with a blank after each comma."""
    quoted = F.transform(values, lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def feature_lines(slots: DataFrame) -> DataFrame:
    """One prompt line per slot: values for categorical, examples for numeric features."""
    name = F.concat(F.lit('  "'), F.col("feature_name"), F.lit('"'))
    categorical = F.concat(name, F.lit(" (categorical): "), _json_list(F.slice("listed", 1, LISTED_VALUES)))
    numeric = F.concat(name, F.lit(" (numeric, e.g. "), F.array_join(F.slice("listed", 1, EXAMPLE_VALUES), ", "), F.lit(")"))
    return slots.select(
        "category", "feature_name", F.when(F.col("slot_type") == "categorical", categorical).otherwise(numeric).alias("line")
    )


# Fixed value: the instruction that goes beside every prompt.
INSTRUCTION = """You extract product attributes from German product catalog titles.

RULES:
1. Output ONLY valid JSON — an array of objects, one per product.
2. Each object has keys matching the requested feature names.
3. For CATEGORICAL features: use ONLY values from the provided allowed list. If unsure, use null.
4. For NUMERIC features: output as "number unit" (e.g. "125 mm", "0.5 l"). Match the unit shown in examples.
5. If a feature cannot be determined from the title, use null.
6. Never invent values. Never explain. JSON only."""


def prompts(batches: DataFrame, slots: DataFrame) -> DataFrame:
    """Instruction and prompt text per batch within the budget. A batch holds at most its size in
    products, a category its taxonomy features; both lists are bounded."""
    joined = lambda order, line: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda s: s["l"]), "\n"
    )
    features = feature_lines(slots).groupBy("category").agg(joined("feature_name", F.col("line")).alias("features"))
    product = F.concat(F.lit("  "), F.col("idx").cast("string"), F.lit(". "), F.coalesce("title", F.lit("")))
    grouped = batches.filter("within_budget").groupBy("batch_id", "category").agg(
        F.count("*").alias("n_products"), joined("idx", product).alias("products")
    )
    # Fixed value: the wording of the request.
    text = F.concat(
        F.lit("Category: "), F.col("category"),
        F.lit("\nFeatures to extract:\n"), F.col("features"),
        F.lit("\n\nProducts:\n"), F.col("products"),
        F.lit("\n\nReturn JSON array. Object keys = feature names. Example format:\n"
              '[{"feature1": "value1", "feature2": "value2"}, ...]'),
    )
    return grouped.join(features, "category").select(
        "batch_id", "category", "n_products", F.lit(INSTRUCTION).alias("instruction"), text.alias("prompt")
    )


def parse_reply(reply: Column) -> Column:
    """JSON array of objects, or the outermost bracket inside other text; else null.

    The text is read as a member of an object: the JSON reader ignores what
    follows a bare array, while inside an object it makes the text unreadable.
    """
    read = lambda text: F.from_json(F.concat(F.lit('{"r":'), text, F.lit("}")), "r array<map<string,string>>")["r"]
    return F.coalesce(read(reply), read(F.regexp_extract(reply, r"(?s)\[.*\]", 0)))


def accepted_values(batches: DataFrame, replies: DataFrame) -> DataFrame:
    """(uid, feature_name, value) of replies whose length equals their batch.

    Replies of another length, unreadable replies and batches without a reply
    give nothing.
    """
    sizes = batches.groupBy("batch_id").agg(F.count("*").alias("n_products"))
    read = replies.select("batch_id", parse_reply(F.col("response")).alias("objects"))
    fitting = read.join(sizes, "batch_id").filter(F.size("objects") == F.col("n_products"))
    items = fitting.select("batch_id", F.posexplode("objects").alias("place", "object")).select(
        "batch_id", (F.col("place") + 1).cast("bigint").alias("idx"), F.explode("object").alias("feature_name", "value")
    )
    return items.join(batches.select("batch_id", "idx", "uid"), ["batch_id", "idx"]).select("uid", "feature_name", "value")


def cost_report(replies: DataFrame, input_usd: float = INPUT_USD, output_usd: float = OUTPUT_USD) -> DataFrame:
    """Calls, tokens and cost."""
    totals = replies.agg(
        F.count("*").alias("total_calls"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("total_input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("total_output_tokens"),
    )
    paid_in = F.col("total_input_tokens") * input_usd / 1_000_000
    paid_out = F.col("total_output_tokens") * output_usd / 1_000_000
    return totals.select(
        "*",
        F.round(paid_in, 4).alias("input_cost_usd"),
        F.round(paid_out, 4).alias("output_cost_usd"),
        F.round(paid_in + paid_out, 4).alias("total_cost_usd"),
    )
