"""Rule layers over every product and every feature of its category."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.relations import german, with_relations
from merkmal.operators import described as S, domain_rules as R, lookups as L, text_layers as X
from merkmal.operators.prepare import prepare, product_texts
from merkmal.operators.scale import sent_if_small
from merkmal.operators.scoring import coverage
from merkmal.operators.taxonomy import build_slots, distinct_values
from merkmal.operators.waterfall import needs_classifier, predict_by_rules
from merkmal.plans.predict import learn, predict
from merkmal.sources import derived as D


def slots(spark, sf):
    return sent_if_small(build_slots(D.taxonomy(spark, sf)))


def work(spark, sf):
    known = slots(spark, sf)
    return prepare(D.request_rows(product_texts(D.products(spark, sf)), known), known)


def found(rows):
    """Rows with a value; it leaves through a generator, so that the filter is no second copy of the layer."""
    value = F.explode_outer(F.array("value")).alias("value")
    return rows.select("uid", "feature_name", value).filter("value is not null")


def layer(column, *features):
    """Query: candidates of one layer, for the named features or for all."""

    def query(spark, sf):
        rows = work(spark, sf)
        if features:
            rows = rows.filter(F.col("feature_name").isin(*features))
        return found(rows.withColumn("value", column()))

    return query


def described_native(spark, sf):
    return found(S.add_described(work(spark, sf), "value", fuzzy=False))


def described(spark, sf):
    return found(S.add_described(work(spark, sf), "value"))


def key_profile(spark, sf):
    return S.key_profile(D.products(spark, sf))


def dictionary_hits(spark, sf):
    return X.dictionary_hits(D.products(spark, sf), distinct_values(slots(spark, sf)))


def document_dictionary_hits(spark, sf):
    return X.dictionary_hits(D.document_catalog(spark, sf), distinct_values(slots(spark, sf)))


def rule_waterfall(spark, sf):
    known, products = slots(spark, sf), D.products(spark, sf)
    lookup = L.title_lookup(D.labels(spark, sf).filter("split = 'train'"), products)
    rows = predict_by_rules(D.request_rows(product_texts(products, lookup), known), known, lookup, fuzzy=False)
    return rows.select("uid", "feature_name", "predicted_value", "confidence", "layer")


def rule_waterfall_fuzzy(spark, sf):
    known, products = slots(spark, sf), D.products(spark, sf)
    lookup = L.title_lookup(D.labels(spark, sf).filter("split = 'train'"), products)
    rows = predict_by_rules(D.request_rows(product_texts(products, lookup), known), known, lookup)
    return rows.select("uid", "feature_name", "predicted_value", "confidence", "layer")


def unresolved_rows(spark, sf):
    return rule_waterfall(spark, sf).filter("predicted_value is null").select("uid", "feature_name")


def classifier_candidates(spark, sf):
    known, products = slots(spark, sf), D.products(spark, sf)
    rows = predict_by_rules(D.request_rows(product_texts(products), known), known, fuzzy=False)
    return rows.filter(needs_classifier()).select("uid", "feature_name")


def rule_coverage(spark, sf):
    return coverage(rule_waterfall(spark, sf)).select(F.round("coverage", 6).alias("coverage"), "n")


def full_rule_run(spark, sf):
    products = D.products(spark, sf)
    known = learn(D.taxonomy(spark, sf), products, D.labels(spark, sf).filter("split = 'train'"))
    rows = predict(D.request_rows(product_texts(products, known.lookup), known.slots), known)
    return rows.select("uid", "category", "feature_name", "feature_type", "predicted_value", "confidence", "layer")


# ---- SQL side -----------------------------------------------------------------------


def rx(pattern, group=1, source="text"):
    return f"nullif(regexp_extract({source}, '{pattern}', {group}), '')"


def listed(*values):
    return "CASE " + " ".join(f"WHEN list_contains(allowed, {v}) THEN {v}" for v in values) + " END"


N = r"\d+(?:\.\d+)?"
_PACK = [rx(r"(\d+)\s*St\.?\s*$", 1, "coalesce(title, '')"), rx(r"(?i)Verpackungseinheit[:\s]+(\d+)\s*(?:Stück|St\.?)")]
_DRIVES = [
    ("t-profil|t-star|torx|innensechsrund", "Torx"), (r"kreuzschlitz\s*phillips|phillips", "Kreuzschlitz (Phillips)"),
    (r"kreuzschlitz\s*pozidriv|pozidriv", "Kreuzschlitz (Pozidriv)"), ("innensechskant|inbus", "Innensechskant"),
    ("sechskant|außensechskant", "Sechskant"), ("schlitz", "Schlitz"),
]


def ral(part):
    code = rx(rf"(?i){part}\s*RAL\s*(\d{{4}})")
    return f"list_min(list_filter(allowed, lambda a: contains(replace(a, ' ', ''), {code})))"


def pair(position):
    n = rx(rf"({N})\s*[xX×]\s*({N})", position, "text_number")
    unit = "coalesce(unit, 'mm')"
    whole = f"CASE WHEN CAST({n} AS DOUBLE) = floor(CAST({n} AS DOUBLE)) THEN CAST(CAST(CAST({n} AS DOUBLE) AS BIGINT) AS STRING) END"
    return listed(f"({n} || ' ' || {unit})", f"({whole} || ' ' || {unit})")


def span(position):
    p = rf"({N})\s*[-–]\s*({N})\s*(mm|cm|m)\b"
    return listed(f"({rx(p, position, 'text_number')} || ' ' || {rx(p, 3, 'text_number')})")


_F = r"(\d+)\s*[xX×]\s*(\d+)\s*Fächer"
_LETTER = "upper(" + rx(r"""(?i)Buchstabe\s*["'']?\s*([A-Za-z0-9])\s*["'']?""") + ")"
_MATERIAL = r"""list_min(list_filter(list_transform(allowed, lambda a: {'s': CASE
  WHEN contains(text_lower, lower(a)) THEN -10 * length(a) - 1
  WHEN regexp_matches(a, '^(.+?)\s*\((.+?)\)$') AND contains(text_lower, lower(trim(regexp_extract(a, '^(.+?)\s*\((.+?)\)$', 1))))
    AND contains(text_lower, lower(trim(regexp_extract(a, '^(.+?)\s*\((.+?)\)$', 2)))) THEN -10 * length(a) - 2
  WHEN regexp_matches(a, '^(.+?)\s+([\d.]+)$') AND contains(text_lower, lower(trim(regexp_extract(a, '^(.+?)\s+([\d.]+)$', 1))))
    AND contains(text_lower, regexp_extract(a, '^(.+?)\s+([\d.]+)$', 2)) THEN -10 * length(a) - 2 END, 'v': a}), lambda e: e.s IS NOT NULL)).v"""
_INNER = rx(r"(\d+(?:[.,]\d+)?)\s*[xX×]\s*\d+(?:[.,]\d+)?\s*[xX×]?\s*\d*(?:[.,]\d+)?\s*mm")
_EC = f"CAST({rx(rf'EC{chr(92)}s+{chr(92)}d+/({N})')} AS DOUBLE)"

DOMAIN = {
    "compartments": (["Fächeranzahl"], listed(f"(CAST(CAST({rx(_F)} AS BIGINT) * CAST({rx(_F, 2)} AS BIGINT) AS STRING) || ' Fächer')")),
    "letter_sign": (["Einzelzeichen"], listed(f"({_LETTER} || ' •')", f"({_LETTER} || ' ·')", _LETTER)),
    "heat_source": (["Wärmequelle"], "CASE " + " ".join(
        f"WHEN contains(text_lower, '{v.lower()}') AND list_contains(allowed, '{v}') THEN '{v}'" for v in ("Sole", "Luft", "Wasser")) + " END"),
    "screw_drive": (["Antrieb"], "coalesce(" + ", ".join(
        f"CASE WHEN regexp_matches(text_lower, '{p}') THEN CASE WHEN list_contains(allowed, '{v}') THEN '{v}' ELSE list_min(list_filter(allowed, lambda a: contains(lower(a), '{v.lower()}'))) END END"
        for p, v in _DRIVES) + ")"),
    "pack_size": (["Verpackungseinheit"], "coalesce(" + ", ".join(listed(f"({n} || ' Stück')", f"({n} || ' St.')") for n in _PACK) + ")"),
    "material": (["Material"], _MATERIAL),
    "inner_diameter": (["Innen-Ø"], "CASE WHEN contains(text_lower, 'flansch') THEN " + listed(f"({german(_INNER)} || ' mm')") + " END"),
    "corpus_colour": (["Korpusfarbe"], ral("Korpus")),
    "front_colour": (["Frontfarbe"], ral("Front")),
    "floor_type": (["Bodenausführung"], """CASE WHEN contains(text_lower, 'sockel') AND list_contains(allowed, 'mit Sockel') THEN 'mit Sockel'
        WHEN regexp_matches(text_lower, 'füße|fuß|füssen') AND list_contains(allowed, 'mit Füßen') THEN 'mit Füßen' END"""),
    "column_type": (["Säulentyp"], f"""CASE WHEN {_EC} <= 4.6 AND list_contains(allowed, 'Analytisch') THEN 'Analytisch'
        WHEN {_EC} > 4.6 AND {_EC} <= 10 AND list_contains(allowed, 'Semipräparativ') THEN 'Semipräparativ'
        WHEN regexp_matches(text, '(?i)Vorsäule|Guard') AND list_contains(allowed, 'Vorsäule') THEN 'Vorsäule' END"""),
    "pair_length": (["Länge"], pair(2)),
    "pair_diameter": (["Durchmesser"], pair(1)),
    "label_width": (["Breite"], "CASE WHEN regexp_matches(text, '(?i)etikett|label|aufkleber|schild') THEN "
                    + listed(f"({rx(rf'({N}){chr(92)}s*[xX×]{chr(92)}s*({N}){chr(92)}s*mm', 1, 'text_number')} || ' ' || coalesce(unit, 'mm'))") + " END"),
    "range_start": (["Spannbereich von"], span(1)),
    "range_end": (["Spannbereich bis"], span(2)),
}

DOMAIN_SQL = "CASE feature_name " + " ".join(f"WHEN '{n}' THEN {e}" for names, e in DOMAIN.values() for n in names) + " END"

_THREAD = "'M ' || " + rx(r"\bM\s*(\d+(?:\.\d+)?)\b", 1, "text_number")
_SCALE = "':' || " + rx(r"1\s*[:/]\s*(\d+)")
_DP = r"(?i)\b(PZ|PH|TX|T)\s*(\d+)\b"
SPECIAL_SQL = f"CASE feature_name WHEN 'Gewinde-Ø' THEN {listed('(' + _THREAD + ')')} WHEN 'Maßstab' THEN {listed('(' + _SCALE + ')')} END"
_DRIVE_VALUE = f"(replace(upper({rx(_DP)}), 'TX', 'T') || ' ' || {rx(_DP, 2)})"
DRIVE_SQL = f"CASE WHEN feature_name = 'Antriebsgröße' AND feature_type = 'numeric' THEN {listed(_DRIVE_VALUE)} END"


def _dimensions():
    by, d = r"\s*[xX×]\s*", r"(\d+)"
    triple = lambda label: rf"(?i){label}\s*[:=]?\s*{d}{by}{d}{by}{d}\s*mm"
    patterns = [(triple(l), l.replace("x", "")) for l in ("HxBxT", "BxTxH", "BxHxT", "LxBxH")]
    patterns += [(rf"(?i)LxB\s*[:=]?\s*{d}{by}{d}\s*mm", "LB")]
    patterns += [(rf"(?i)\({a}{by}{b}\)\s*{d}\s*mm{by}{d}\s*mm", a + b) for a, b in ("LB", "BH")]
    patterns += [(rf"(\d{{3,4}}){by}(\d{{2,4}}){by}(\d{{2,4}})\s*mm\b", "HBT")]
    cases = ""
    for name, letter in (("Höhe", "H"), ("Breite", "B"), ("Länge", "L")):
        tries = ", ".join(rx(p, ls.index(letter) + 1, "text_number") for p, ls in patterns if letter in ls)
        cases += f" WHEN '{name}' THEN coalesce({tries}) || ' mm'"
    return f"CASE WHEN feature_type = 'numeric' AND len(list_filter(allowed, lambda a: contains(a, 'mm'))) > 0 THEN CASE feature_name {cases} END END"


DIMENSION_SQL = _dimensions()
CONTAINED_SQL = r"""CASE WHEN feature_type = 'categorical' THEN list_min(list_transform(list_filter(allowed, lambda a: contains(text_lower, lower(a))),
  lambda a: {'s': -1000 * len(regexp_split_to_array(trim(a), '\s+')) - length(a), 'p': instr(text_lower, lower(a)), 'v': a})).v END"""
SUBSTRING_SQL = "list_filter(allowed, lambda a: contains(text_lower, lower(a)))[1]"
SINGLE_SQL = "CASE WHEN len(allowed) = 1 THEN allowed[1] END"


def closest_sql(word, cutoff):
    """Most similar listed value by edits, at or over the cutoff."""
    return f"""list_sort(list_filter(list_transform(list_filter(allowed, lambda a: least(length(a), length({word})) >= {cutoff} * greatest(length(a), length({word}))),
      lambda a: {{'s': (CASE WHEN greatest(length(a), length({word})) > 0 THEN 1 - levenshtein({word}, a) / greatest(length(a), length({word})) ELSE 1.0 END), 'v': a}}), lambda e: e.s >= {cutoff}))[-1].v"""


def _described(close):
    return rf"""SELECT uid, feature_name, arg_min(answer, pos) AS value FROM (
        SELECT uid, feature_name, pos, CASE
            WHEN list_contains(allowed, value) THEN value
            WHEN feature_type = 'numeric' AND list_contains(allowed, again) THEN again
            WHEN feature_type = 'numeric' AND list_contains(allowed, regexp_extract(again, '^([\d.]+\s+\S+)', 1)) THEN regexp_extract(again, '^([\d.]+\s+\S+)', 1)
            WHEN feature_type = 'numeric' AND list_contains(allowed, regexp_extract(again, '^([\d.]+)\s*(\S+)', 1) || ' ' || regexp_extract(again, '^([\d.]+)\s*(\S+)', 2))
              THEN regexp_extract(again, '^([\d.]+)\s*(\S+)', 1) || ' ' || regexp_extract(again, '^([\d.]+)\s*(\S+)', 2)
            ELSE coalesce(list_min(list_filter(allowed, lambda a: lower(a) = lower(value))), {close}list_filter(allowed, lambda a: contains(lower(value), lower(a)))[1]) END AS answer
        FROM (SELECT *, {german("trim(value)")} AS again FROM work JOIN clean_pairs USING (uid))
        WHERE length(key) >= 3 AND len(list_filter(terms, lambda t: length(t) >= 3 AND (contains(key, t) OR contains(t, key)))) > 0)
      WHERE answer IS NOT NULL GROUP BY uid, feature_name"""


# Numbers with the slot's unit, ranked by listed and in title, listed, in title, any.
_NUMBERS = {
    "numbers": rf"""SELECT uid, category, feature_name, allowed, unit,
        list_transform(regexp_extract_all(text_number, '(?i)(\d+[.,]?\d*)\s*' || regexp_escape(unit) || '\b', 1), lambda n: replace(n, ',', '.')) AS ns,
        list_transform(regexp_extract_all({german("coalesce(title, '')")}, '(?i)(\d+[.,]?\d*)\s*' || regexp_escape(unit) || '\b', 1), lambda n: replace(n, ',', '.')) AS ts
      FROM work WHERE feature_type = 'numeric' AND unit IS NOT NULL""",
    "measured": """SELECT uid, feature_name, n || ' ' || unit AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY uid, feature_name ORDER BY
            CASE WHEN listed AND titled THEN 0 WHEN listed THEN 1 WHEN titled THEN 2 ELSE 3 END,
            CASE WHEN titled AND NOT listed AND feature_name IN ('Länge', 'Gesamtlänge', 'Klingenlänge', 'Schneidenlänge', 'Gewindelänge') THEN -pos ELSE pos END) AS rn
        FROM (SELECT *, list_contains(allowed, n || ' ' || unit) AS listed, list_contains(ts, n) AS titled
              FROM (SELECT *, unnest(ns) AS n, generate_subscripts(ns, 1) AS pos FROM numbers))) WHERE rn = 1""",
    "pairs": r"""SELECT uid, unnest(k) AS key, unnest(v) AS raw, generate_subscripts(k, 1) AS pos FROM (
        SELECT uid, regexp_extract_all(description, '([^·•<>\n]{2,60}?)\s*:\s*([^·•<>\n]{1,100})', 1) AS k,
          regexp_extract_all(description, '([^·•<>\n]{2,60}?)\s*:\s*([^·•<>\n]{1,100})', 2) AS v FROM products WHERE contains(description, ':'))""",
    "clean_pairs": rf"""SELECT uid, pos, lower(trim(ltrim(trim(key, ' ' || chr(10)), '- '), ' ' || chr(10))) AS key,
        {german("rtrim(trim(raw, ' ' || chr(10)), '.')")} AS value FROM pairs""",
    "described": _described(""),
    "described_fuzzy": _described(closest_sql("value", 0.85) + ", "),
    "by_rules": f"""SELECT uid, feature_name, feature_type, category, CASE WHEN len(allowed) = 0 OR list_contains(allowed, l.value) THEN l.value END AS c0, {DOMAIN_SQL} AS c1, d.value AS c2,
        {SPECIAL_SQL} AS c3, {DRIVE_SQL} AS c4, {DIMENSION_SQL} AS c5, {CONTAINED_SQL} AS c6, m.value AS c7, {SUBSTRING_SQL} AS c8, {SINGLE_SQL} AS c9
      FROM work LEFT JOIN described d USING (uid, feature_name) LEFT JOIN measured m USING (uid, feature_name) LEFT JOIN title_lookup l USING (feature_name, title)""",
    "no_lookup": """SELECT uid, feature_name, feature_type, coalesce(c1, c2, c3, c4, c5, c6, c7, c8, c9) AS predicted_value,
        CASE WHEN c1 IS NOT NULL THEN 0.93 WHEN c2 IS NOT NULL THEN 0.92 WHEN c3 IS NOT NULL THEN 0.95 WHEN c4 IS NOT NULL OR c5 IS NOT NULL THEN 0.9 ELSE 0.0 END AS sure FROM by_rules""",
    "waterfall": """SELECT uid, category, feature_name, feature_type, coalesce(c0, c1, c2, c3, c4, c5, c6, c7, c8, c9) AS predicted_value,
        CAST(CASE WHEN c0 IS NOT NULL THEN 0.95 WHEN c1 IS NOT NULL THEN 0.93 WHEN c2 IS NOT NULL THEN 0.92 WHEN c3 IS NOT NULL THEN 0.95 WHEN c4 IS NOT NULL THEN 0.90
          WHEN c5 IS NOT NULL THEN 0.90 WHEN c6 IS NOT NULL THEN 0.88 WHEN c7 IS NOT NULL THEN 0.85 WHEN c8 IS NOT NULL THEN 0.75 WHEN c9 IS NOT NULL THEN 0.5 ELSE 0 END AS DOUBLE) AS confidence,
        CASE WHEN c0 IS NOT NULL THEN 'title_lookup' WHEN c1 IS NOT NULL THEN 'domain_rule' WHEN c2 IS NOT NULL THEN 'described' WHEN c3 IS NOT NULL THEN 'special_format'
          WHEN c4 IS NOT NULL THEN 'drive_size' WHEN c5 IS NOT NULL THEN 'dimension' WHEN c6 IS NOT NULL THEN 'contained' WHEN c7 IS NOT NULL THEN 'measured'
          WHEN c8 IS NOT NULL THEN 'substring' WHEN c9 IS NOT NULL THEN 'single_value' ELSE 'none' END AS layer FROM by_rules""",
}
_NEEDS = {
    "numbers": ["work"], "measured": ["numbers"], "pairs": ["products"], "clean_pairs": ["pairs"], "described": ["work", "clean_pairs"],
    "by_rules": ["work", "described", "measured", "title_lookup"], "waterfall": ["by_rules"], "no_lookup": ["by_rules"],
}
for _name in ("by_rules", "waterfall"):  # the same with similar values taken
    _NUMBERS[_name + "_fuzzy"] = _NUMBERS[_name].replace("described d", "described_fuzzy d").replace("FROM by_rules", "FROM by_rules_fuzzy")
_NEEDS |= {"described_fuzzy": _NEEDS["described"], "by_rules_fuzzy": ["work", "described_fuzzy", "measured", "title_lookup"], "waterfall_fuzzy": ["by_rules_fuzzy"]}
LAYERS = {"extra": _NUMBERS, "needs": _NEEDS}


def layer_sql(expression, *features):
    where = "WHERE feature_name IN (" + ", ".join(f"'{f}'" for f in features) + ")" if features else ""
    return with_relations(f"SELECT * FROM (SELECT uid, feature_name, {expression} AS value FROM work {where}) WHERE value IS NOT NULL", "work")


_COLUMNS = {
    "compartments": R.compartments, "letter_sign": R.letter_sign, "heat_source": R.heat_source, "screw_drive": R.screw_drive,
    "pack_size": R.pack_size, "material": R.material, "inner_diameter": R.inner_diameter,
    "corpus_colour": lambda: R.ral_colour("Korpus"), "front_colour": lambda: R.ral_colour("Front"), "floor_type": R.floor_type,
    "column_type": R.column_type, "pair_length": lambda: R.pair_member(2), "pair_diameter": lambda: R.pair_member(1),
    "label_width": R.label_width, "range_start": lambda: R.range_end(1), "range_end": lambda: R.range_end(2),
}

_HITS = "SELECT uid, value FROM (SELECT uid, lower(coalesce(title, '') || ' ' || coalesce(description, '')) AS t FROM {}) JOIN (SELECT DISTINCT value FROM slot_values) ON contains(t, lower(value))"

PAIRS = {
    **{f"rule_{name}": (layer(_COLUMNS[name], *features), layer_sql(sql, *features)) for name, (features, sql) in DOMAIN.items()},
    "domain_rules": (layer(R.domain_rule), layer_sql(DOMAIN_SQL)),
    "described_pairs": (described_native, with_relations("SELECT uid, feature_name, value FROM described", "described", **LAYERS)),
    "described_pairs_fuzzy": (described, with_relations("SELECT uid, feature_name, value FROM described_fuzzy", "described_fuzzy", **LAYERS)),
    "described_key_profile": (key_profile, with_relations("SELECT key, count(*) AS n FROM clean_pairs GROUP BY key", "clean_pairs", **LAYERS)),
    "special_formats": (layer(X.special_format), layer_sql(SPECIAL_SQL)),
    "special_drive_sizes": (layer(X.special_drive), layer_sql(DRIVE_SQL)),
    "dimensions": (layer(X.dimension), layer_sql(DIMENSION_SQL)),
    "contained_values": (layer(X.contained_value), layer_sql(CONTAINED_SQL)),
    "dictionary_hits": (dictionary_hits, with_relations(_HITS.format("products"), "products", "slot_values")),
    "dictionary_hits_documents": (document_dictionary_hits, with_relations(_HITS.format("document_catalog"), "document_catalog", "slot_values")),
    "measured_numbers": (layer(lambda: X.measured_number(F.col("title_number"))), with_relations("SELECT * FROM measured", "measured", **LAYERS)),
    "longest_contained": (layer(X.longest_contained), layer_sql(SUBSTRING_SQL)),
    "single_values": (layer(X.only_value), layer_sql(SINGLE_SQL)),
    "rule_waterfall": (rule_waterfall, with_relations("SELECT uid, feature_name, predicted_value, confidence, layer FROM waterfall", "waterfall", **LAYERS)),
    "rule_waterfall_fuzzy": (rule_waterfall_fuzzy, with_relations("SELECT uid, feature_name, predicted_value, confidence, layer FROM waterfall_fuzzy", "waterfall_fuzzy", **LAYERS)),
    "unresolved_rows": (unresolved_rows, with_relations("SELECT uid, feature_name FROM waterfall WHERE predicted_value IS NULL", "waterfall", **LAYERS)),
    "classifier_candidates": (classifier_candidates, with_relations(
        "SELECT uid, feature_name FROM no_lookup WHERE predicted_value IS NULL OR (feature_type = 'categorical' AND sure < 0.9)", "no_lookup", **LAYERS)),
    "rule_coverage": (rule_coverage, with_relations(
        "SELECT round(avg(CASE WHEN predicted_value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS coverage, count(*) AS n FROM waterfall", "waterfall", **LAYERS)),
}
