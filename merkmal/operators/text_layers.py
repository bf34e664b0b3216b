"""Layers for short formats, dimensions, contained values and measured numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merkmal.functions.measures import drive_size, scale, thread_size
from merkmal.functions.patterns import all_groups, any_case, exact, first_group, once
from merkmal.functions.text import blank_if_null, german_decimals, rule_text, substrings
from merkmal.operators.prepare import if_allowed
from merkmal.session import cut_lineage

THREAD_FEATURES = ["Gewinde-Ø", "Gewindegröße"]
SCALE_FEATURES = ["Maßstab"]
DRIVE_FEATURES = ["Größe", "Antriebsgröße", "Antriebsprofil"]

# Letter a feature reads from a dimension string.
DIMENSION_LETTER = {
    "Höhe": "H", "Gesamthöhe": "H", "Breite": "B", "Gesamtbreite": "B",
    "Tiefe": "T", "Gesamttiefe": "T", "Länge": "L",
}

# Labels of dimension strings in order, with their letters.
TRIPLE_LABELS = ["HxBxT", "BxTxH", "BxHxT", "LxBxH"]
BRACKET_PAIRS = ["LB", "BH"]

LAST_NUMBER_FEATURES = ["Länge", "Gesamtlänge", "Klingenlänge", "Schneidenlänge", "Gewindelänge"]


def special_format() -> Column:
    """Thread sizes and scales, when listed."""
    name = F.col("feature_name")
    value = F.when(name.isin(THREAD_FEATURES), thread_size(F.col("text"))).when(name.isin(SCALE_FEATURES), scale(F.col("text")))
    return if_allowed(value)


def special_drive() -> Column:
    """Drive sizes of numeric features, when listed."""
    applies = F.col("feature_name").isin(DRIVE_FEATURES) & (F.col("feature_type") == "numeric")
    return F.when(applies, if_allowed(drive_size(F.col("text"))))


def dimension_patterns() -> list[tuple[str, str, str]]:
    """(lower-case text every match contains, pattern, letters) in the order they are tried."""
    by = r"\s*[xX×]\s*"
    table = [
        (label.lower(), any_case(rf"{label}\s*[:=]?\s*(\d+){by}(\d+){by}(\d+)\s*mm"), label.replace("x", ""))
        for label in TRIPLE_LABELS
    ]
    table.append(("lxb", any_case(rf"LxB\s*[:=]?\s*(\d+){by}(\d+)\s*mm"), "LB"))
    for a, b in BRACKET_PAIRS:
        table.append((f"({a.lower()}", any_case(rf"\({a}{by}{b}\)\s*(\d+)\s*mm{by}(\d+)\s*mm"), a + b))
    bare = exact(rf"(\d{{3,4}}){by}(\d{{2,4}}){by}(\d{{2,4}})\s*mm(?![\p{{L}}\p{{N}}_])")
    table.append(("mm", bare, "HBT"))
    return table


def dimension() -> Column:
    """Number of the feature's letter in the first dimension string that has it.

    A listed value holds ``mm``, and so does a slot that takes unlisted numbers:
    one flag of the slot decides for both. The plain text check in front of each
    pattern spares most rows the pattern.
    """
    result = F.lit(None).cast("string")
    for letter in sorted(set(DIMENSION_LETTER.values())):
        names = [n for n, l in DIMENSION_LETTER.items() if l == letter]
        numbers = [
            F.when(
                F.col("text_lower").contains(sign),
                first_group(F.col("text_number"), pattern, letters.index(letter) + 1),
            )
            for sign, pattern, letters in dimension_patterns()
            if letter in letters
        ]
        result = F.when(F.col("feature_name").isin(names), F.concat(F.coalesce(*numbers), F.lit(" mm"))).otherwise(result)
    return F.when((F.col("feature_type") == "numeric") & F.col("has_mm"), result)


def contained_entries() -> Column:
    return F.filter("entries", lambda e: F.col("text_lower").contains(e["lower"]))


def contained_value() -> Column:
    """Categorical: the contained value with most words, then the longest, then
    the one standing first in the text."""
    ranked = F.transform(
        contained_entries(),
        lambda e: F.struct(
            (-1000 * e["tokens"] - F.length(e["value"])).alias("rank"),
            F.instr(F.col("text_lower"), e["lower"]).alias("at"),
            e["value"].alias("value"),
        ),
    )
    return F.when(F.col("feature_type") == "categorical", F.array_min(ranked)["value"])


def longest_contained() -> Column:
    """Longest contained value of either type; ``entries`` are sorted that way."""
    return F.get(contained_entries(), F.lit(0))["value"]


def only_value() -> Column:
    return F.when(F.size("allowed") == 1, F.get("allowed", F.lit(0)))


def measured_number(title_number: Column | None = None) -> Column:
    """Number with the slot's unit: listed and in the title, listed, in the title, any.

    Whether a number stands in the title is decided by its digits, so a number
    repeated in the description counts as well. ``title_number`` is the title with
    German decimals turned, where it is known already.
    """
    if title_number is None:
        title_number = german_decimals(blank_if_null("title"))
    dotted = lambda found: F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit(".")))
    numbers = dotted(all_groups(F.col("text_number"), F.col("unit_pattern")))
    in_title = dotted(all_groups(title_number, F.col("unit_pattern")))
    value = lambda n: F.concat(n, F.lit(" "), F.col("unit"))
    listed = lambda n: F.array_contains("allowed", value(n))
    last = F.col("feature_name").isin(LAST_NUMBER_FEATURES)

    def choose(found: Column) -> Column:
        titled = lambda n: F.array_contains(found["titled"], n)
        first = lambda test: F.get(F.filter(found["all"], test), F.lit(0))
        return F.coalesce(
            first(lambda n: listed(n) & titled(n)),
            first(listed),
            F.when(last, F.try_element_at(F.filter(found["all"], titled), F.lit(-1))).otherwise(first(titled)),
            F.get(found["all"], F.lit(0)),
        )

    usable = (F.col("feature_type") == "numeric") & F.col("unit").isNotNull()
    return F.when(usable, value(once(F.struct(numbers.alias("all"), in_title.alias("titled")), choose)))


def anchored(values: DataFrame) -> DataFrame:
    """Values with their anchor: the three-character piece fewest values share.

    A value shorter than three characters is its own anchor.
    """
    words = values.select("value", F.lower("value").alias("lower")).filter(F.length("lower") > 0).distinct()
    pieces = F.when(F.length("lower") >= 3, F.array_distinct(substrings(F.col("lower"), 3))).otherwise(F.array("lower"))
    spread = words.select("value", "lower", F.explode(pieces).alias("anchor"))
    shared = spread.groupBy("anchor").agg(F.count("*").alias("n"))
    return (
        spread.join(shared, "anchor")
        .groupBy("value", "lower")
        .agg(F.min_by("anchor", F.struct("n", "anchor")).alias("anchor"))
    )


#: A dictionary up to this many values is sent to all executors; the rows found are the same beyond it.
BROADCAST_WORDS = 100_000


def dictionary_hits(products: DataFrame, values: DataFrame, key: str = "uid") -> DataFrame:
    """Every dictionary value found in a product's text, whatever the slot: one row per input row and value.

    Each text is cut into its distinct short pieces, which meet the values on
    their anchor in an equi-join; a hit is then verified on the whole text. A
    text has the anchor of every value it holds, so nothing is missed. Rows get a
    number of their own in a checkpointed table, so repeated and null keys count
    as different rows; only (row, piece) meets the values, and the text joins by row.
    """
    texts = cut_lineage(products.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias(key), F.lower(rule_text()).alias("text_lower")))
    words = cut_lineage(anchored(values))
    sizes = words.groupBy(F.length("anchor").alias("n")).agg(F.count("*").alias("words")).collect()  # at most 3 rows
    if not sizes:
        return texts.select(key, F.lit(None).cast("string").alias("value")).filter("false")
    if sum(r["words"] for r in sizes) <= BROADCAST_WORDS:
        words = F.broadcast(words)
    pieces = F.array_distinct(F.concat(*[substrings(F.col("text_lower"), r["n"]) for r in sorted(sizes)]))
    # The outer form, because the other one computes all pieces a second time to drop empty texts; the join drops them too.
    met = texts.select("_row", F.explode_outer(pieces).alias("anchor")).join(words, "anchor").select("_row", "value", "lower")
    holds = F.col("text_lower").contains(F.col("lower"))
    return met.join(texts, "_row").filter(holds).select(key, "value")
