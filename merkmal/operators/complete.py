"""Fallbacks for open rows and the final check against the slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from merkmal.functions.patterns import strip
from merkmal.operators.fuzzy import closest_listed
from merkmal.operators.scale import best_per_key
from merkmal.operators.taxonomy import slot_values, with_slots

VALIDATION_CUTOFF = 0.75


def commonest_slot_value(slots: DataFrame) -> DataFrame:
    """Per slot the listed value that most slots of the feature list.

    A window counts the slots, so that a broadcast hint of small slots holds for the result as well.
    """
    slots_with = F.count("*").over(Window.partitionBy("feature_name", "value"))
    counted = slot_values(slots).filter("feature_name is not null").withColumn("n", slots_with)
    return best_per_key(counted, ["category", "feature_name"], [-F.col("n"), F.col("value")], ["value", "n"])


def apply_fallbacks(rows: DataFrame, slots: DataFrame, mode: DataFrame) -> DataFrame:
    """Fill open rows: label mode of the feature if it fits the slot, else the
    slot's commonest value. (Any listed value has a count, so nothing is left
    for a third step.)
    """
    common = commonest_slot_value(slots).select("category", "feature_name", F.col("value").alias("_common"))
    modes = mode.select("feature_name", F.col("value").alias("_mode"))
    joined = with_slots(rows, slots, ["allowed"])
    joined = joined.join(modes, "feature_name", "left")
    joined = joined.join(common, ["category", "feature_name"], "left")
    fits = F.col("_mode").isNotNull() & ((F.size("allowed") == 0) | F.array_contains("allowed", F.col("_mode")))
    is_open = F.col("predicted_value").isNull()
    step = F.when(~is_open, F.lit("keep")).when(fits, F.lit("mode")).when(F.col("_common").isNotNull(), F.lit("common"))
    stepped = joined.withColumn("_step", F.coalesce(step, F.lit("keep")))
    pick = lambda kept, by_mode, by_common: (
        F.when(F.col("_step") == "mode", by_mode).when(F.col("_step") == "common", by_common).otherwise(kept)
    )
    return (
        stepped.withColumn("predicted_value", pick(F.col("predicted_value"), F.col("_mode"), F.col("_common")))
        .withColumn("confidence", pick(F.col("confidence"), F.lit(0.20), F.lit(0.15)))
        .withColumn("layer", pick(F.col("layer"), F.lit("fallback_mode"), F.lit("fallback_common")))
        .drop("_step", "_mode", "_common", "allowed")
    )


def snap_number(value: Column) -> Column:
    """Listed as it is or with white space collapsed; else unchanged."""
    flat = F.regexp_replace(strip(value), r"(?U)\s+", " ")
    return F.when(F.array_contains("allowed", flat) & ~F.array_contains("allowed", value), flat).otherwise(value)


def same_in_any_case(value: Column) -> Column:
    """Listed value that equals ``value`` but for case; the first in binary order."""
    return F.when(
        F.array_contains("allowed", value), value
    ).otherwise(F.array_min(F.filter("allowed", lambda a: F.lower(a) == F.lower(value))))


def add_snapped(rows: DataFrame, value: str, out: str, cutoff: float, fuzzy: bool = True) -> DataFrame:
    """Categorical snapping on rows that carry ``allowed``: exact, any case, closest."""
    word = F.col(value)
    close = [closest_listed(word, F.col("allowed"), cutoff)] if fuzzy else []
    return rows.withColumn(out, F.coalesce(same_in_any_case(word), *close))


def validate(rows: DataFrame, slots: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Snap predictions to their slot; adds ``corrected``.

    Rows without prediction or with an empty slot pass unchanged, and so does a
    categorical value nothing is close to.
    """
    joined = with_slots(rows, slots, ["allowed"])
    value = F.col("predicted_value")
    open_value = F.when((F.size("allowed") > 0) & ~F.array_contains("allowed", value), value)
    staged = joined.withColumn("_open", F.when(F.col("feature_type") == "categorical", open_value))
    staged = add_snapped(staged, "_open", "_snapped", VALIDATION_CUTOFF, fuzzy)
    number = F.when((F.col("feature_type") != "categorical") & open_value.isNotNull(), snap_number(value))
    final = F.coalesce(F.col("_snapped"), number, value)
    return (
        staged.withColumn("_final", final)
        .withColumn("corrected", F.coalesce(F.col("_final") != value, F.lit(False)))
        .withColumn("predicted_value", F.col("_final"))
        .drop("_final", "_open", "_snapped", "allowed")
    )
