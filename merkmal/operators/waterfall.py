"""Layers in order of precedence: the first one that yields a value wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.operators.described import described_value
from merkmal.operators.domain_rules import domain_rule
from merkmal.operators.lookups import add_candidate, fitting
from merkmal.operators.prepare import PRODUCT_TEXTS, TITLE_VALUES, has_texts, prepare
from merkmal.operators.text_layers import (
    contained_value,
    dimension,
    longest_contained,
    measured_number,
    only_value,
    special_drive,
    special_format,
)

# Confidence of a value by the layer it comes from.
CONFIDENCE = {
    "title_lookup": 0.95,
    "domain_rule": 0.93,
    "described": 0.92,
    "special_format": 0.95,
    "drive_size": 0.90,
    "dimension": 0.90,
    "contained": 0.88,
    "measured": 0.85,
    "substring": 0.75,
    "single_value": 0.50,
}


def predict_by_rules(rows: DataFrame, slots: DataFrame, lookup: DataFrame | None = None, fuzzy: bool = True) -> DataFrame:
    """Work rows plus ``predicted_value``, ``confidence`` and ``layer``.

    After the joins to slots and lookup all layers are row-local. They are the branches of one ``coalesce``: a
    layer is computed only where the layers before it found nothing, and a row with its texts and slot is read
    once, where a column per layer would write it anew for every layer. Each value carries the position of its
    layer in front. Rows of products that come from ``product_texts`` bring texts and looked-up values. Other rows
    meet the lookup first, as they came: a shuffle on the title moves neither prepared texts nor slots.
    """
    made = has_texts(rows)
    kept = [c for c in rows.columns if not (made and c in (*PRODUCT_TEXTS, TITLE_VALUES))]
    layers = {}
    if lookup is not None and made and TITLE_VALUES in rows.columns:
        ready = prepare(rows, slots)
        layers["title_lookup"] = fitting(F.try_element_at(TITLE_VALUES, F.col("feature_name")))
    elif lookup is not None:
        ready = prepare(add_candidate(rows, lookup, "_candidate"), slots)
        layers["title_lookup"] = fitting("_candidate")
    else:
        ready = prepare(rows, slots)
    layers |= {
        "domain_rule": domain_rule(),
        "described": described_value(made, fuzzy),
        "special_format": special_format(),
        "drive_size": special_drive(),
        "dimension": dimension(),
        "contained": contained_value(),
        "measured": measured_number(F.col("title_number") if made else None),
        "substring": longest_contained(),
        "single_value": only_value(),
    }
    marked = F.coalesce(*[F.concat(F.lit(f"{i}"), value) for i, value in enumerate(layers.values())])
    found = ready.select(*kept, marked.alias("_marked"))

    # Unpacking through a generator keeps a later filter on the prediction from
    # being pushed down as a second copy of all layers.
    place = F.substring("_marked", 1, 1).cast("int")
    pick = lambda values, nothing: F.coalesce(F.get(F.array(*[F.lit(v) for v in values]), place), F.lit(nothing))
    hit = F.struct(
        F.expr("substring(_marked, 2)").alias("value"),
        pick([CONFIDENCE[name] for name in layers], 0.0).alias("confidence"),
        pick(layers, "none").alias("layer"),
    )
    return found.select(*kept, F.inline_outer(F.array(hit)).alias("predicted_value", "confidence", "layer"))


def needs_classifier() -> Column:
    """Unresolved, or categorical with a confidence under 0.90."""
    return F.col("predicted_value").isNull() | ((F.col("confidence") < 0.90) & (F.col("feature_type") == "categorical"))
