"""Work rows joined to their slot, with the text columns the layers share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from merkmal.functions.patterns import keep_if
from merkmal.functions.text import blank_if_null, german_decimals, rule_text
from merkmal.operators.lookups import values_by_title
from merkmal.operators.pairs import clean_pairs
from merkmal.operators.scale import group_tasks
from merkmal.operators.taxonomy import with_slots

SLOT_COLUMNS = ["slot_type", "allowed", "entries", "unit", "unit_pattern", "has_mm", "terms"]


#: What the layers read of a product alone, whichever feature is asked.
PRODUCT_TEXTS = ["text", "text_lower", "text_number", "title_number", "clean_pairs"]
#: Feature to value the title lookup knows for the product's title.
TITLE_VALUES = "title_values"


def with_texts(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("text", rule_text())
        .withColumn("text_lower", F.lower("text"))
        .withColumn("text_number", german_decimals(F.col("text")))
    )


def product_texts(products: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Products with ``PRODUCT_TEXTS``, made once per product and not once per feature asked of it.

    With a lookup (one row per feature and title) they also carry ``TITLE_VALUES``: one row per product meets
    one row per title, so the work rows need not be shuffled by title. The shuffle at the end keeps the texts
    from being made again behind the join that turns a product into work rows, and spreads products of one title.
    """
    made = with_texts(products).withColumns({
        "title_number": german_decimals(blank_if_null("title")),
        "clean_pairs": F.when(F.col("description").contains(":"), clean_pairs(F.col("description"))),
    })
    if lookup is not None:
        known = values_by_title(lookup, TITLE_VALUES).hint("merge")
        made = made.join(known, "title", "left").select(*made.columns, TITLE_VALUES)
    return group_tasks(made, ["uid", "title"])


def has_texts(rows: DataFrame) -> bool:
    """Whether the rows come from ``product_texts``."""
    return set(PRODUCT_TEXTS) <= set(rows.columns)


def prepare(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Columns of the work rows plus slot and text columns; narrow after the join."""
    texts = rows if has_texts(rows) else with_texts(rows)
    return with_slots(texts, slots.select("category", "feature_name", *SLOT_COLUMNS))


def is_allowed(value):
    return F.array_contains("allowed", value)


def if_allowed(value):
    """The value when the slot lists it, else null."""
    return keep_if(value, is_allowed)


def first_allowed(*values):
    return F.coalesce(*[if_allowed(v) for v in values])
