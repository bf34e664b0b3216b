"""Taxonomy table to slots: one row per (category, feature_name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.functions.patterns import WORD, number_with_unit, strip

# Other names under which a feature appears in descriptions.
FEATURE_ALIASES = {
    "Felgenmaterial": ["Radkörper"],
    "Ladeflächenlänge": ["Ladeflächen-Länge"],
    "Ladeflächenbreite": ["Ladeflächen-Breite"],
    "Für Modell": ["Geeignet für", "Passend für"],
    "Spannutenlänge": ["Spirallänge"],
    "Gewindeausführung": ["Gewindeform"],
    "Körnung": ["Korngröße"],
    "SW von": ["Schlüsselweite"],
    "Dornmaterial": ["Material (Dorn)"],
    "Laufbelag": ["Reifen", "Bandage"],
}


def parse_values(cell: Column) -> Column:
    """All non-empty ``[...]`` groups of the cell in order; null gives an empty array."""
    found = F.regexp_extract_all(cell, F.lit(r"\[([^\]]*)\]"), F.lit(1))
    return F.coalesce(F.filter(found, lambda v: v != ""), F.array().cast("array<string>"))


def dominant_unit(values: Column) -> Column:
    """Most frequent text behind a number; the unit seen first wins a tie."""
    units = F.filter(
        F.transform(values, lambda v: F.regexp_extract(strip(v), r"(?U)^[\d.,\s\-+/ca.]+\s+(.+)$", 1)),
        lambda u: u != "",
    )
    counted = F.transform(
        F.array_distinct(units),
        lambda u, i: F.struct(F.size(F.filter(units, lambda x: x == u)).alias("n"), (-i).alias("seen"), u.alias("unit")),
    )
    return F.array_max(counted)["unit"]


def by_length(values: Column) -> Column:
    """Longest value first, equal lengths in binary order."""
    keyed = F.array_sort(F.transform(values, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    return F.transform(keyed, lambda s: s["v"])


def value_entry(value: Column) -> Column:
    """What the matching layers need to know about one allowed value."""
    compound = r"^(.+?)\s*\((.+?)\)$"
    graded = rf"(?U)^(.+?)\s+([\d.]+)$"
    is_compound = value.rlike("(?U)" + compound)
    pattern = lambda group: F.when(is_compound, F.regexp_extract(value, "(?U)" + compound, group)).when(
        value.rlike(graded), F.regexp_extract(value, graded, group)
    )
    return F.struct(
        value.alias("value"),
        F.lower(value).alias("lower"),
        F.size(F.split(strip(value), r"(?U)\s+")).alias("tokens"),
        F.lower(strip(pattern(1))).alias("base"),
        F.lower(strip(pattern(2))).alias("grade"),
    )


def search_terms(feature_name: Column, aliases: dict[str, list[str]]) -> Column:
    """Lower-case names a description may use for the feature."""
    none = F.array().cast("array<string>")
    listed = F.lit(None).cast("array<string>")
    for name, others in aliases.items():
        listed = F.when(feature_name == name, F.array(*[F.lit(o) for o in others])).otherwise(listed)
    names = F.concat(
        F.array(feature_name),
        F.when(feature_name.contains("Ø"), F.array(F.replace(feature_name, F.lit("Ø"), F.lit("Durchmesser")))).otherwise(none),
        F.when(feature_name.contains("Durchmesser"), F.array(F.replace(feature_name, F.lit("Durchmesser"), F.lit("Ø")))).otherwise(none),
        F.coalesce(listed, none),
    )
    lower = F.transform(names, F.lower)
    spelled = F.transform(lower, lambda t: F.replace(F.replace(t, F.lit("-"), F.lit(" ")), F.lit("ø"), F.lit("durchmesser")))
    return F.array_distinct(F.concat(lower, spelled))


def build_slots(taxonomy: DataFrame, order: str = "row_pos", aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per slot; of duplicate taxonomy rows the last one counts.

    ``allowed`` is sorted longest first, ``listed`` keeps the taxonomy's order.
    Everything that depends on the slot alone is computed here once, so that the
    row layers only read it.
    """
    latest = taxonomy.groupBy("category", "feature_name").agg(
        F.max_by(F.struct("feature_type", "aggregated_feature_values"), F.col(order)).alias("last")
    )
    parsed = latest.select(
        "category",
        "feature_name",
        F.col("last.feature_type").alias("slot_type"),
        parse_values(F.col("last.aggregated_feature_values")).alias("parsed"),
    )
    unit = F.when(F.col("slot_type") != "categorical", dominant_unit(F.col("parsed")))
    listed = parsed.withColumn("listed", F.array_distinct("parsed")).withColumn("unit", unit)
    ordered = listed.withColumn("allowed", by_length(F.col("listed")))
    return ordered.select(
        "category",
        "feature_name",
        "slot_type",
        "listed",
        "allowed",
        F.transform("allowed", value_entry).alias("entries"),
        "unit",
        number_with_unit(F.col("unit")).alias("unit_pattern"),
        F.exists("allowed", lambda v: v.contains("mm")).alias("has_mm"),
        search_terms(F.col("feature_name"), {**FEATURE_ALIASES, **(aliases or {})}).alias("terms"),
    )


def slot_values(slots: DataFrame) -> DataFrame:
    """One row per slot and allowed value."""
    return slots.select(
        "category", "feature_name", "slot_type", F.posexplode("allowed").alias("pos", "value")
    ).withColumn("value_lower", F.lower("value"))


def with_slots(rows: DataFrame, slots: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Left join of work rows to their slot; a missing slot gives an empty ``allowed``."""
    keys = ["category", "feature_name"]
    side = slots.select(*keys, *columns) if columns else slots
    joined = rows.join(side, keys, "left")
    if "allowed" in side.columns:
        joined = joined.withColumn("allowed", F.coalesce("allowed", F.array().cast("array<string>")))
    return joined


def value_frequency(slots: DataFrame) -> DataFrame:
    """In how many slots of its feature a value is listed."""
    return slot_values(slots).groupBy("feature_name", "value").agg(F.count("*").alias("n"))


def taxonomy_sizes(slots: DataFrame) -> DataFrame:
    """Number of slots, categories and distinct categorical values."""
    values = F.when(F.col("slot_type") == "categorical", F.col("allowed"))
    tall = slots.select("category", "feature_name", F.explode_outer(values).alias("value"))
    return tall.agg(
        F.count_distinct(F.struct("category", "feature_name")).alias("n_slots"),
        F.count_distinct("category").alias("n_categories"),
        F.count_distinct("value").alias("n_categorical_values"),
    )


def reverse_index(slots: DataFrame) -> DataFrame:
    """Lower-case value to its slots, one row per slot, with the number of slots.

    Kept as rows: a value may be listed by a large share of all slots.
    """
    rows = slot_values(slots).select("value_lower", "category", "feature_name").distinct()
    counts = rows.groupBy("value_lower").agg(F.count("*").alias("n_slots"))
    return rows.join(counts, "value_lower")


def distinct_values(slots: DataFrame) -> DataFrame:
    """Every value of every slot once."""
    return slots.select(F.explode("allowed").alias("value")).distinct()


def rows_outside_taxonomy(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows naming a feature the product's category does not have."""
    keys = ["category", "feature_name"]
    return rows.join(slots.select(*keys), keys, "left_anti")


def format_violations(rows: DataFrame, slots: DataFrame, value: str = "feature_value") -> DataFrame:
    """Categorical values outside the slot; numeric values without the slot's unit."""
    joined = with_slots(rows, slots, ["allowed", "unit"])
    categorical = F.col("feature_type") == "categorical"
    not_listed = categorical & (F.size("allowed") > 0) & ~F.array_contains("allowed", F.col(value))
    no_unit = ~categorical & F.col("unit").isNotNull() & ~F.endswith(F.col(value), F.concat(F.lit(" "), F.col("unit")))
    problem = F.when(not_listed, F.lit("value not listed")).when(no_unit, F.lit("unit missing"))
    return joined.withColumn("problem", problem).filter("problem is not null").drop("allowed", "unit")
