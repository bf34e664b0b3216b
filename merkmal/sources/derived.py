"""Catalog relations derived from the test tables.

Products come from ``part``: every part is one product. The expressions are SQL
text that Spark and a check engine both read, so that both sides start from the
same relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from merkmal.operators.scale import group_tasks

THREAD = "CAST(4 + 2 * (p_size % 3) AS STRING)"
LENGTH = "CAST(20 + 10 * (p_size % 5) AS STRING)"
HUNDRED = "CAST(100 * (1 + p_size % 5) AS STRING)"
MIX = "((p_partkey + CAST(floor(p_partkey / 16) AS BIGINT)) % 4)"

FAMILY = f"""CASE p_partkey % 16
 WHEN 0 THEN 'DIN 933 M' || {THREAD} || 'x' || {LENGTH}
 WHEN 1 THEN 'DIN 933 M ' || {THREAD} || ' x ' || {LENGTH}
 WHEN 2 THEN 'HxBxT ' || CAST(1700 + 100 * (p_size % 3) AS STRING) || 'x900x480mm Korpus RAL7035 Front RAL 7021 ' || CASE WHEN p_size % 2 = 0 THEN 'mit Sockel' ELSE 'auf Füßen' END
 WHEN 3 THEN CASE p_size % 5 WHEN 0 THEN 'BxTxH: 1200x400x748mm' WHEN 1 THEN 'BxHxT 10 x 200 x 40 mm' WHEN 2 THEN 'LxB 30x50mm' WHEN 3 THEN '(L x B) 20 mm x 900 mm' ELSE '(B x H) 10 mm x 1900 mm' END
 WHEN 4 THEN CAST(1 + p_size % 4 AS STRING) || 'x' || CAST(2 + p_size % 3 AS STRING) || ' Fächer'
 WHEN 5 THEN 'Buchstabe ' || CASE p_size % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'b' WHEN 2 THEN '"C"' WHEN 3 THEN 'D' ELSE 'E' END
 WHEN 6 THEN CASE p_size % 3 WHEN 0 THEN 'Luft/Wasser' WHEN 1 THEN 'Sole-Wasser' ELSE 'Wasser' END
 WHEN 7 THEN 'Flansch ' || CAST(10 + 2 * (p_size % 3) AS STRING) || ',5 x 30 x 2 mm'
 WHEN 8 THEN CASE p_size % 4 WHEN 0 THEN 'EC 250/4' WHEN 1 THEN 'EC 250/4.6' WHEN 2 THEN 'EC 250/8' ELSE 'Guard EC' END
 WHEN 9 THEN CASE p_size % 3 WHEN 0 THEN 'Etikett 50x25mm' WHEN 1 THEN 'Aufkleber 10x25mm' ELSE 'Etikett 19x64mm' END
 WHEN 10 THEN CAST(20 + 2 * (p_size % 2) AS STRING) || ' - ' || CAST(26 + 2 * (p_size % 3) AS STRING) || ' mm'
 WHEN 11 THEN CASE p_size % 3 WHEN 0 THEN '1:10' WHEN 1 THEN '1/50' ELSE '1 : 160' END
 WHEN 12 THEN CASE p_size % 3 WHEN 0 THEN 'PZ1' WHEN 1 THEN 'ph 2' ELSE 'TX3' END
 WHEN 13 THEN CAST(5 + p_size % 4 AS STRING) || ',5 mm ' || CAST(1 + p_size % 6 AS STRING) || ' kg'
 WHEN 14 THEN ''
 ELSE 'Platte' END"""

MATERIAL_TEXT = """CASE p_partkey % 5 WHEN 0 THEN 'Edelstahl A2' WHEN 1 THEN 'Stahl 4.8 verzinkt'
 WHEN 2 THEN 'Messing' WHEN 3 THEN 'Kunststoff' ELSE 'Holz' END"""
DRIVE_TEXT = "CASE p_partkey % 3 WHEN 0 THEN ' Torx' WHEN 1 THEN ' Innensechskant' ELSE '' END"
PACK_TEXT = "CASE WHEN p_partkey % 16 = 14 THEN CASE p_size % 3 WHEN 0 THEN ' 100 St.' WHEN 1 THEN ' 300 St' ELSE ' 50 St.' END ELSE '' END"

TITLE = f"split_part(p_name, ' ', 2) || ' ' || {FAMILY} || ' ' || {MATERIAL_TEXT} || {DRIVE_TEXT} || {PACK_TEXT}"

DESCRIPTION = f"""CASE {MIX}
 WHEN 0 THEN CAST(NULL AS STRING)
 WHEN 1 THEN ''
 WHEN 2 THEN 'Technische Daten: Modell X · Höhe: ' || {HUNDRED} || ' mm · Gewicht: ' || CAST(p_size % 5 AS STRING) || ',5 kg · Farbe: ' ||
   CASE p_size % 4 WHEN 0 THEN 'Gruen' WHEN 1 THEN 'ROT' WHEN 2 THEN 'Blau.' ELSE 'dunkelrot matt' END ||
   ' · Verpackungseinheit: ' || CAST(100 * (1 + p_size % 3) AS STRING) || ' Stück'
 ELSE 'Radkörper: Stahl.' || chr(10) || '- Korngröße: ' || CAST(40 + 20 * (p_size % 4) AS STRING) || ' • Geeignet für: Typ A' ||
   CASE WHEN p_size % 3 = 0 THEN ' • Farbton: hellblau' ELSE '' END END"""

PRODUCT_COLUMNS = {
    "uid": "p_partkey",
    "category": "lower(p_type)",
    "title": TITLE,
    "description": DESCRIPTION,
}

# 0-6 train, 7-8 validation, 9 test
SPLIT = "CASE WHEN CAST(floor(uid / 16) AS BIGINT) % 10 < 7 THEN 'train' WHEN CAST(floor(uid / 16) AS BIGINT) % 10 < 9 THEN 'val' ELSE 'test' END"

# Taxonomy of the derived catalog: feature, type, values in listing order.
FEATURES = [
    ("Material", "categorical", ["Edelstahl (A2)", "Edelstahl", "Stahl 4.8", "Stahl", "Messing", "Kunststoff"]),
    ("Antrieb", "categorical", ["Torx", "Kreuzschlitz (Pozidriv)", "Sechskant"]),
    ("Farbe", "categorical", ["Rot", "Blau", "Grün"]),
    ("Oberfläche", "categorical", ["verzinkt", "blank"]),
    ("Fächeranzahl", "numeric", ["4 Fächer", "6 Fächer", "8 Fächer", "12 Fächer"]),
    ("Einzelzeichen", "categorical", ["A •", "B •", "C", "D"]),
    ("Wärmequelle", "categorical", ["Luft", "Sole", "Wasser"]),
    ("Verpackungseinheit", "numeric", ["100 Stück", "200 Stück", "300 St."]),
    ("Innen-Ø", "numeric", ["10.5 mm", "12.5 mm"]),
    ("Korpusfarbe", "categorical", ["RAL 7035 Lichtgrau", "RAL 7021 Schwarzgrau"]),
    ("Frontfarbe", "categorical", ["RAL 7035 Lichtgrau", "RAL 7021 Schwarzgrau"]),
    ("Bodenausführung", "categorical", ["mit Sockel", "mit Füßen"]),
    ("Säulentyp", "categorical", ["Analytisch", "Semipräparativ", "Vorsäule"]),
    ("Länge", "numeric", ["20 mm", "30 mm", "40 mm"]),
    ("Durchmesser", "numeric", ["4 mm", "6 mm", "8 mm"]),
    ("Höhe", "numeric", ["100 mm", "200 mm", "748 mm", "1900 mm"]),
    ("Breite", "numeric", ["10 mm", "50 mm", "900 mm"]),
    ("Gewicht", "numeric", ["1.5 kg", "2 kg", "5 kg"]),
    ("Spannbereich von", "numeric", ["20 mm", "22 mm"]),
    ("Spannbereich bis", "numeric", ["26 mm", "28 mm"]),
    ("Gewinde-Ø", "numeric", ["M 4", "M 6", "M 8"]),
    ("Maßstab", "categorical", [":10", ":50", ":87"]),
    ("Antriebsgröße", "numeric", ["PZ 1", "PH 2", "T 3"]),
    ("Felgenmaterial", "categorical", ["Stahl", "Aluminium"]),
    ("Körnung", "numeric", ["40", "60", "80"]),
    ("Norm", "categorical", ["DIN 933"]),
]

# Label values per feature; every 11th product carries another listed value.
LABELS = [
    ("Material", "categorical", """CASE WHEN p_partkey % 11 = 0 THEN 'Messing' ELSE CASE p_partkey % 5 WHEN 0 THEN 'Edelstahl (A2)'
      WHEN 1 THEN 'Stahl 4.8' WHEN 2 THEN 'Messing' WHEN 3 THEN 'Kunststoff' ELSE 'Holz' END END"""),
    ("Farbe", "categorical", "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN 'Rot' ELSE CASE p_size % 3 WHEN 0 THEN 'Rot' WHEN 1 THEN 'Blau' ELSE 'Grün' END END"),
    ("Höhe", "numeric", f"CASE WHEN p_partkey % 11 = 0 THEN '748 mm' ELSE {HUNDRED} || ' mm' END"),
    ("Gewinde-Ø", "numeric", f"CASE WHEN p_partkey % 11 = 0 THEN 'M 8' ELSE 'M ' || {THREAD} END"),
    ("Oberfläche", "categorical", "CASE WHEN p_partkey % 5 = 1 THEN 'verzinkt' ELSE 'blank' END"),
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is stored; the scan's splits decide its partitions."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts spread by key: a single file is one partition, and every part becomes many rows with texts."""
    return group_tasks(read_table(spark, sf_dir, "part"), ["p_partkey"])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = part_rows(spark, sf_dir)
    return part.selectExpr(*[f"{text} AS {name}" for name, text in PRODUCT_COLUMNS.items()])


def with_split(df: DataFrame) -> DataFrame:
    return df.withColumn("split", F.expr(SPLIT))


def cell(values: list[str]) -> str:
    return "{" + ",".join(f"'[{v}]'" for v in values) + "}"


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category times feature; two deviations and one repeated slot by rule.

    ``promo`` has no Norm, ``small`` lacks Messing, and Farbe is listed twice for
    ``large`` where the later row counts.
    """
    listed = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(n).alias("feature_name"), F.lit(t).alias("feature_type"), F.lit(cell(v)).alias("cell"))
        for i, (n, t, v) in enumerate(FEATURES + [("Farbe", "categorical", ["Rot", "Blau", "Grün", "Hellblau"])])
    ])
    categories = read_table(spark, sf_dir, "part").select(F.lower("p_type").alias("category")).distinct()
    rows = categories.select("category", F.explode(listed).alias("f")).select("category", "f.*")
    rows = rows.filter(
        ~((F.col("category") == "promo") & (F.col("feature_name") == "Norm"))
        & ((F.col("pos") < len(FEATURES)) | (F.col("category") == "large"))
    )
    text = F.when(
        (F.col("category") == "small") & (F.col("feature_name") == "Material"), F.replace("cell", F.lit(",'[Messing]'"), F.lit(""))
    ).otherwise(F.col("cell"))
    return rows.select(
        "category", "feature_name", "feature_type", text.alias("aggregated_feature_values"), F.col("pos").cast("bigint").alias("row_pos")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of train and validation products."""
    stacked = F.array(*[
        F.struct(F.lit(n).alias("feature_name"), F.expr(v).alias("feature_value"), F.lit(t).alias("feature_type")) for n, t, v in LABELS
    ])
    part = part_rows(spark, sf_dir).withColumn("uid", F.col("p_partkey"))
    return (
        with_split(part)
        .filter("split <> 'test'")
        .select("uid", "split", F.explode(stacked).alias("l"))
        .select("uid", "l.feature_name", "l.feature_value", "l.feature_type", "split")
        .filter("feature_value is not null")
    )


def template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to predict for test products; keys of every 50th product come twice."""
    names = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(n).alias("feature_name"), F.lit(t).alias("feature_type")) for i, (n, t, _) in enumerate(LABELS)
    ])
    copies = F.when(F.col("uid") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = with_split(products(spark, sf_dir)).filter("split = 'test'")
    return (
        rows.select("uid", F.explode(names).alias("f"), F.lit(None).cast("string").alias("feature_value"))
        .select("uid", "f.*", "feature_value", F.explode(copies).alias("copy"))
        .select(
            "uid",
            "feature_name",
            "feature_value",
            "feature_type",
            (F.col("uid") * 100 + F.col("i") * 2 + F.col("copy")).alias("template_pos"),
        )
    )


def request_rows(product_rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Every product asks for every feature of its category."""
    wanted = slots.select("category", "feature_name", F.col("slot_type").alias("feature_type"))
    return product_rows.join(wanted, "category")


def order_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large catalog: one product per order line key, described like its part."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_uid")
    ).agg(F.min("l_partkey").alias("part_uid"))
    described = products(spark, sf_dir).withColumnRenamed("uid", "part_uid")
    return lines.join(described, "part_uid").select(F.col("line_uid").alias("uid"), "category", "title", "description")


def document_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as products: the source is the category, the whole text the description."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("uid"), F.col("source").alias("category"), F.concat_ws(" ", "lang", "source").alias("title"), F.col("text").alias("description")
    )
