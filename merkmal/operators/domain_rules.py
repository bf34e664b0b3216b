"""Rules bound to one feature name each. A rule is a column: the value or null.

Every rule reads the columns of ``prepare``. A feature name selects at most one
rule, so the whole set is one ``CASE`` on the name and only the matching rule is
evaluated for a row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from merkmal.functions.patterns import any_case, exact, first_group, keep_if
from merkmal.functions.text import blank_if_null, german_decimals
from merkmal.operators.prepare import first_allowed, if_allowed, is_allowed

# Terms in the text and the drive they stand for, in order.
DRIVE_TERMS = [
    ("t-profil|t-star|torx|innensechsrund", "Torx"),
    (r"kreuzschlitz\s*phillips|phillips", "Kreuzschlitz (Phillips)"),
    (r"kreuzschlitz\s*pozidriv|pozidriv", "Kreuzschlitz (Pozidriv)"),
    ("innensechskant|inbus", "Innensechskant"),
    ("sechskant|außensechskant", "Sechskant"),
    ("schlitz", "Schlitz"),
]

# Which number of a pair "a x b" a feature takes.
PAIR_POSITION = {"Länge": 2, "Gesamtlänge": 2, "Gewindelänge": 2, "Durchmesser": 1, "Schaft-Ø": 1}

RANGE_FEATURES = ["Spannbereich von", "Spannbereich bis", "Schneidbereich min.", "Schneidbereich max."]

NUMBER = r"\d+(?:\.\d+)?"
TIMES = r"\s*[xX×]\s*"


def text() -> Column:
    return F.col("text")


def text_lower() -> Column:
    return F.col("text_lower")


def text_number() -> Column:
    return F.col("text_number")


def smallest(values: Column) -> Column:
    """Of several equally good values the one first in binary order."""
    return F.array_min(values)


def compartments() -> Column:
    pattern = exact(rf"(\d+){TIMES}(\d+)\s*Fächer")
    count = lambda group: first_group(text(), pattern, group).try_cast("decimal(18,0)")
    return if_allowed(F.concat((count(1) * count(2)).cast("string"), F.lit(" Fächer")))


def letter_sign() -> Column:
    letter = F.upper(first_group(text(), any_case(r"""Buchstabe\s*["']?\s*([A-Za-z0-9])\s*["']?""")))
    return first_allowed(F.concat(letter, F.lit(" •")), F.concat(letter, F.lit(" ·")), letter)


def heat_source() -> Column:
    sources = ["Sole", "Luft", "Wasser"]
    return F.coalesce(*[F.when(text_lower().contains(s.lower()), if_allowed(F.lit(s))) for s in sources])


def screw_drive() -> Column:
    def listed(value: str) -> Column:
        wider = F.filter("allowed", lambda a: F.lower(a).contains(value.lower()))
        return F.coalesce(if_allowed(F.lit(value)), smallest(wider))

    return F.coalesce(*[F.when(text_lower().rlike(exact(terms)), listed(value)) for terms, value in DRIVE_TERMS])


def pack_size() -> Column:
    in_title = first_group(blank_if_null("title"), exact(r"(\d+)\s*St\.?\s*$"))
    in_text = first_group(text(), any_case(r"Verpackungseinheit[:\s]+(\d+)\s*(?:Stück|St\.?)"))
    return F.coalesce(
        *[first_allowed(F.concat(n, F.lit(" Stück")), F.concat(n, F.lit(" St."))) for n in (in_title, in_text)]
    )


def material() -> Column:
    """Longest listed material in the text; a material with a grade also counts
    when both parts occur apart from each other."""
    whole = lambda e: text_lower().contains(e["lower"])
    parts = lambda e: F.coalesce(text_lower().contains(e["base"]) & text_lower().contains(e["grade"]), F.lit(False))
    found = F.filter("entries", lambda e: whole(e) | parts(e))
    scored = F.transform(
        found,
        lambda e: F.struct((-10 * F.length(e["value"]) - F.when(whole(e), 1).otherwise(2)).alias("s"), e["value"].alias("v")),
    )
    return F.array_min(scored)["v"]


def inner_diameter() -> Column:
    number = r"\d+(?:[.,]\d+)?"
    pattern = exact(rf"({number}){TIMES}{number}\s*[xX×]?\s*\d*(?:[.,]\d+)?\s*mm")
    value = F.concat(german_decimals(first_group(text(), pattern)), F.lit(" mm"))
    return F.when(text_lower().contains("flansch"), if_allowed(value))


def ral_colour(part: str) -> Column:
    code = first_group(text(), any_case(rf"{part}\s*RAL\s*(\d{{4}})"))
    return smallest(F.filter("allowed", lambda a: F.replace(a, F.lit(" "), F.lit("")).contains(code)))


def floor_type() -> Column:
    feet = text_lower().contains("füße") | text_lower().contains("fuß") | text_lower().contains("füssen")
    return F.coalesce(
        F.when(text_lower().contains("sockel"), if_allowed(F.lit("mit Sockel"))),
        F.when(feet, if_allowed(F.lit("mit Füßen"))),
    )


def column_type() -> Column:
    inner = first_group(text(), exact(rf"EC\s+\d+/({NUMBER})")).cast("double")
    return F.coalesce(
        F.when(inner <= 4.6, if_allowed(F.lit("Analytisch"))),
        F.when((inner > 4.6) & (inner <= 10), if_allowed(F.lit("Semipräparativ"))),
        F.when(text().rlike(any_case("Vorsäule|Guard")), if_allowed(F.lit("Vorsäule"))),
    )


def pair_member(position: int) -> Column:
    """One number of the first ``a x b``, as written or as a whole number."""
    number = first_group(text_number(), exact(rf"({NUMBER}){TIMES}({NUMBER})"), position)
    unit = F.coalesce("unit", F.lit("mm"))
    whole = keep_if(number.cast("double"), lambda n: n == F.floor(n)).try_cast("decimal(38,0)").cast("string")
    return first_allowed(F.concat(number, F.lit(" "), unit), F.concat(whole, F.lit(" "), unit))


def label_width() -> Column:
    number = first_group(text_number(), exact(rf"({NUMBER}){TIMES}({NUMBER})\s*mm"))
    is_label = text().rlike(any_case("etikett|label|aufkleber|schild"))
    return F.when(is_label, if_allowed(F.concat(number, F.lit(" "), F.coalesce("unit", F.lit("mm")))))


def range_end(position: int) -> Column:
    pattern = exact(rf"({NUMBER})\s*[-–]\s*({NUMBER})\s*(mm|cm|m)(?![\p{{L}}\p{{N}}_])")
    return if_allowed(F.concat(first_group(text_number(), pattern, position), F.lit(" "), first_group(text_number(), pattern, 3)))


def rules() -> dict[str, tuple[str | None, Column]]:
    """Feature name to (required row type or any, rule)."""
    table = {
        "Fächeranzahl": (None, compartments()),
        "Einzelzeichen": (None, letter_sign()),
        "Wärmequelle": (None, heat_source()),
        "Antrieb": ("categorical", screw_drive()),
        "Verpackungseinheit": (None, pack_size()),
        "Material": ("categorical", material()),
        "Innen-Ø": (None, inner_diameter()),
        "Korpusfarbe": ("categorical", ral_colour("Korpus")),
        "Frontfarbe": ("categorical", ral_colour("Front")),
        "Bodenausführung": ("categorical", floor_type()),
        "Säulentyp": ("categorical", column_type()),
        "Breite": ("numeric", label_width()),
    }
    table.update({name: ("numeric", pair_member(p)) for name, p in PAIR_POSITION.items()})
    table.update({name: (None, range_end(1 if "von" in name or "min" in name else 2)) for name in RANGE_FEATURES})
    return table


def domain_rule() -> Column:
    """Value of the rule bound to the row's feature, null without one."""
    result = F.lit(None).cast("string")
    for name, (row_type, rule) in reversed(list(rules().items())):
        applies = F.col("feature_name") == name
        if row_type:
            applies = applies & (F.col("feature_type") == row_type)
        result = F.when(applies, rule).otherwise(result)
    return result
