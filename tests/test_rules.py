"""Hand-worked rows for the rule layers, with Unicode and tie cases."""

import pytest
from pyspark.sql import functions as F

from merkmal.functions import measures as M
from merkmal.operators.complete import validate
from merkmal.operators.taxonomy import build_slots
from merkmal.operators.waterfall import predict_by_rules

TAXONOMY = "category string, feature_name string, feature_type string, aggregated_feature_values string, row_pos bigint"
ROWS = "uid bigint, category string, feature_name string, feature_type string, title string, description string"


def cell(*values):
    return "{" + ",".join(f"'[{v}]'" for v in values) + "}"


CASES = [
    # feature, type, allowed, title, description, value, layer
    ("Gewinde-Ø", "numeric", ["M 12", "M 8"], "Schraube M12 x 80", None, "M 12", "special_format"),
    ("Gewinde-Ø", "numeric", ["M 12", "M 8"], "Schraube M12x80", None, None, "none"),
    ("Volumen", "numeric", ["4 m³"], "Tank 5 m³ x", None, "5 m³", "measured"),
    ("Anteil", "numeric", ["40 %", "41 %"], "Alkohol 50 % a", None, None, "none"),
    ("Anteil", "numeric", ["40 %"], "Alkohol 50%a", None, "50 %", "measured"),
    ("Dicke", "numeric", ["7 mm"], "Blech 5 mm", None, "5 mm", "measured"),
    ("Material", "categorical", ["Edelstahl", "Edelstahl (A2)"], "Schraube A2 Edelstahl", None, "Edelstahl (A2)", "domain_rule"),
    ("Antrieb", "categorical", ["Sechskant", "Torx"], "Schraube Innensechskant", None, "Sechskant", "domain_rule"),
    ("Höhe", "numeric", ["100 mm"], "Schrank HxBxT 1950x900x480mm", None, "1950 mm", "dimension"),
    ("Drahtmaß", "numeric", ["5 mm"], "Draht 7 mm", None, "7 mm", "measured"),
    ("Länge", "numeric", ["50 mm"], "Stift 3 mm 16 mm", None, "16 mm", "measured"),
    ("Fächeranzahl", "numeric", ["20 Fächer"], "Kasten 4×5 Fächer", None, "20 Fächer", "domain_rule"),
    ("Größe", "categorical", ["klein"], "x", "GRÖßE: KLEIN.", "klein", "described"),
    ("Farbe", "categorical", ["Grünlichgrau", "Rot"], "x", "Farbe: Grünlichgraw", "Grünlichgrau", "described"),
    # Two edits in 13 characters are under the cutoff of 0.85; a sequence-match ratio (0.88) would have taken it.
    ("Farbe", "categorical", ["Grünlichgrau", "Rot"], "x", "Farbe: Gruenlichgrau", None, "none"),
    ("Körnung", "numeric", ["80", "60"], "x", "Art: a • - Korngröße: 80", "80", "described"),
    ("Form", "categorical", ["rund", "rund und flach", "flach"], "Griff rund und flach", None, "rund und flach", "contained"),
    ("Norm", "categorical", ["DIN 933"], "nichts", None, "DIN 933", "single_value"),
    ("Oberfläche", "categorical", ["blank", "matt!"], "blank? matt!", "", "blank", "contained"),
]


@pytest.fixture(scope="module")
def predicted(spark):
    taxonomy = [(f"c{i}", c[0], c[1], cell(*c[2]), i) for i, c in enumerate(CASES)]
    rows = [(i, f"c{i}", c[0], c[1], c[3], c[4]) for i, c in enumerate(CASES)]
    slots = build_slots(spark.createDataFrame(taxonomy, TAXONOMY))
    found = predict_by_rules(spark.createDataFrame(rows, ROWS), slots)
    return {r["uid"]: (r["predicted_value"], r["layer"]) for r in found.collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{c[0]}-{c[3]}" for c in CASES])
def test_layer(predicted, i):
    assert predicted[i] == (CASES[i][5], CASES[i][6])


def test_result_does_not_depend_on_partitions(spark):
    taxonomy = [(f"c{i}", c[0], c[1], cell(*c[2]), i) for i, c in enumerate(CASES)]
    rows = [(i, f"c{i}", c[0], c[1], c[3], c[4]) for i, c in enumerate(CASES)]
    slots = build_slots(spark.createDataFrame(taxonomy, TAXONOMY))
    frame = spark.createDataFrame(rows, ROWS)
    one, many = (sorted(map(tuple, predict_by_rules(frame.repartition(n), slots).select("uid", "predicted_value", "layer").collect())) for n in (1, 7))
    assert one == many


def test_validation_snaps_and_is_idempotent(spark):
    slots = build_slots(spark.createDataFrame([("c", "Farbe", "categorical", cell("abce", "abcf"), 1), ("c", "L", "numeric", cell("5 mm"), 2)], TAXONOMY))
    rows = spark.createDataFrame(
        [(1, "c", "Farbe", "categorical", "abcd"), (2, "c", "Farbe", "categorical", "ABCE"), (3, "c", "Farbe", "categorical", "zzzz"), (4, "c", "L", "numeric", "5  mm"), (5, "c", "L", "numeric", "7 mm"), (6, "c", "L", "numeric", None)],
        "uid bigint, category string, feature_name string, feature_type string, predicted_value string",
    )
    once = validate(rows, slots)
    values = {r["uid"]: r["predicted_value"] for r in once.collect()}
    assert values == {1: "abcf", 2: "abce", 3: "zzzz", 4: "5 mm", 5: "7 mm", 6: None}
    twice = {r["uid"]: (r["predicted_value"], r["corrected"]) for r in validate(once.drop("corrected"), slots).collect()}
    assert twice == {k: (v, False) for k, v in values.items()}


@pytest.mark.parametrize(
    "text, unit, expected",
    [("500 ml", "l", ["0.5 l"]), ("3 mm und 4 MM", "mm", ["3 mm", "4 mm"]), ("12,5 cm", "mm", ["125 mm"]), ("nichts", "mm", [])],
)
def test_measurements(spark, text, unit, expected):
    assert spark.range(1).select(M.measurements(F.lit(text), unit).alias("v")).first()["v"] == expected


@pytest.mark.parametrize(
    "column, text, expected",
    [(M.scale, "1/10", ":10"), (M.drive_size, "Bit tx25", "T 25"), (M.drive_size, "PZ1", "PZ 1"), (M.thread_size, "M 2,5 x", "M 2.5")],
)
def test_short_formats(spark, column, text, expected):
    assert spark.range(1).select(column(F.lit(text)).alias("v")).first()["v"] == expected


def test_german_decimals(spark):
    from merkmal.functions.text import german_decimals

    assert spark.range(1).select(german_decimals(F.lit("1,2,3")).alias("v")).first()["v"] == "1.2,3"
