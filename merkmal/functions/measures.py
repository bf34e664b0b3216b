"""Numbers, units and the short formats built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merkmal.functions.patterns import (
    WORD_END,
    WORD_START,
    all_groups,
    any_case,
    exact,
    first_group,
    number_with_unit,
    quoted,
)
from merkmal.functions.text import german_decimals

# Units of one kind with their size in the kind's smallest unit,
# in the order in which source units are tried.
UNIT_KINDS = {
    "length": {"mm": 1, "cm": 10, "m": 1000},
    "volume": {"ml": 1, "cl": 10, "l": 1000},
    "weight": {"g": 1, "kg": 1000},
    "power": {"W": 1, "kW": 1000},
    "charge": {"mAh": 1, "Ah": 1000},
    "voltage": {"mV": 1, "V": 1000},
}


def unit_factor_rows() -> list[tuple[str, str, float, int]]:
    """(from, to, factor, order) for every pair of units of one kind."""
    rows = []
    for units in UNIT_KINDS.values():
        for source, size in units.items():
            for target, target_size in units.items():
                rows.append((source, target, size / target_size, len(rows)))
    return rows


def unit_factors(spark: SparkSession) -> DataFrame:
    """The conversion table; its size is fixed by the constant above."""
    return spark.createDataFrame(unit_factor_rows(), "from_unit string, to_unit string, factor double, source_order int")


def format_number(number: Column) -> Column:
    """Whole numbers under 1e12 without a point, others with up to four decimals."""
    short = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", number), "0+$", ""), r"\.$", "")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e12)
    return F.when(whole, number.cast("bigint").cast("string")).when(number.isNotNull(), short)


def convert_units(rows: DataFrame, number: str, source: str, target: str) -> DataFrame:
    """Add ``converted``: equal units keep the number, unknown pairs give null."""
    factors = unit_factors(rows.sparkSession).drop("source_order")
    joined = rows.join(
        F.broadcast(factors),
        (F.col(source) == F.col("from_unit")) & (F.col(target) == F.col("to_unit")),
        "left",
    )
    value = F.when(F.col(source) == F.col(target), F.col(number)).otherwise(F.col(number) * F.col("factor"))
    return joined.withColumn("converted", value).drop("from_unit", "to_unit", "factor")


def measurements(text: Column, unit: str) -> Column:
    """Array of measurements in ``unit``.

    Every direct hit counts. Without one, the first number of the first
    convertible unit found in the text is converted.
    """
    clean = german_decimals(text)
    number = r"\d+\.?\d*"
    literal = F.lit(unit)
    direct = all_groups(clean, number_with_unit(literal, number))
    converted = []
    for source, target, factor, _ in unit_factor_rows():
        if target == unit and source != unit:
            found = F.regexp_extract(clean, any_case(rf"({number})\s*{source}{WORD_END}"), 1)
            scaled = F.nullif(found, F.lit("")).cast("double") * F.lit(factor)
            converted.append(F.concat(format_number(scaled), F.lit(" " + unit)))
    fallback = F.coalesce(*converted) if converted else F.lit(None).cast("string")
    return F.when(F.size(direct) > 0, F.transform(direct, lambda n: F.concat(n, F.lit(" "), literal))).otherwise(
        F.array_compact(F.array(fallback))
    )


def thread_size(text: Column) -> Column:
    """``M12`` or ``M 12`` as ``M 12``."""
    number = first_group(german_decimals(text), exact(rf"{WORD_START}M\s*(\d+(?:\.\d+)?){WORD_END}"))
    return F.concat(F.lit("M "), number)


def scale(text: Column) -> Column:
    """``1:10`` or ``1/10`` as ``:10``."""
    return F.concat(F.lit(":"), first_group(text, exact(r"1\s*[:/]\s*(\d+)")))


def drive_size(text: Column) -> Column:
    """``PZ1``, ``PH2``, ``TX25`` as ``PZ 1``, ``PH 2``, ``T 25``."""
    pattern = any_case(rf"{WORD_START}(PZ|PH|TX|T)\s*(\d+){WORD_END}")
    kind = F.upper(first_group(text, pattern, 1))
    kind = F.when(kind == "TX", F.lit("T")).otherwise(kind)
    return F.concat(kind, F.lit(" "), first_group(text, pattern, 2))


def prefixed_value(text: Column, prefix: str, unit: str) -> Column:
    """Prefix, number and unit such as ``ca. 700 g``; the prefix brings its own blank."""
    pattern = F.concat(
        F.lit("(?U)"), quoted(F.lit(prefix)), F.lit(r"\s*(\d+[.,]?\d*)\s*"), quoted(F.lit(unit))
    )
    number = F.get(all_groups(text, pattern), F.lit(0))
    return F.concat(F.lit(prefix), german_decimals(number), F.lit(" " + unit))

