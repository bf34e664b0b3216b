"""Relations of the derived catalog for the check engine, as SQL text.

The product, label and split expressions are shared with the Spark side; slots
and work rows are written here on their own.
"""

from __future__ import annotations

from merkmal.operators.taxonomy import FEATURE_ALIASES
from merkmal.sources.derived import DESCRIPTION, FEATURES, LABELS, SPLIT, TITLE, cell


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def german(expression: str) -> str:
    return rf"regexp_replace({expression}, '(\d),(\d)', '\1.\2', 'g')"


_FEATURES = ",\n ".join(
    f"({i}, {text(n)}, {text(t)}, {text(cell(v))})"
    for i, (n, t, v) in enumerate(FEATURES + [("Farbe", "categorical", ["Rot", "Blau", "Grün", "Hellblau"])])
)
_LABELS = " UNION ALL ".join(
    f"SELECT p_partkey AS uid, {text(n)} AS feature_name, {v} AS feature_value, {text(t)} AS feature_type FROM part" for n, t, v in LABELS
)
_ALIASES = "CASE feature_name " + " ".join(
    f"WHEN {text(n)} THEN [{', '.join(text(a) for a in others)}]" for n, others in FEATURE_ALIASES.items()
) + " ELSE [] END"

RELATIONS = {
    "products": f"SELECT p_partkey AS uid, lower(p_type) AS category, {TITLE} AS title, {DESCRIPTION} AS description FROM part",
    "taxonomy": f"""SELECT category, feature_name, feature_type,
        CASE WHEN category = 'small' AND feature_name = 'Material' THEN replace(cell, ',''[Messing]''', '') ELSE cell END AS aggregated_feature_values,
        CAST(pos AS BIGINT) AS row_pos
      FROM (SELECT DISTINCT lower(p_type) AS category FROM part), (VALUES {_FEATURES}) f(pos, feature_name, feature_type, cell)
      WHERE NOT (category = 'promo' AND feature_name = 'Norm') AND (pos < {len(FEATURES)} OR category = 'large')""",
    "labels": f"SELECT uid, feature_name, feature_value, feature_type, {SPLIT} AS split FROM ({_LABELS}) WHERE feature_value IS NOT NULL AND {SPLIT} <> 'test'",
    "template": f"""SELECT uid, feature_name, CAST(NULL AS STRING) AS feature_value, feature_type, uid * 100 + i * 2 + copy AS template_pos
      FROM (SELECT uid, unnest(CASE WHEN uid % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM products WHERE {SPLIT} = 'test'),
           (VALUES {', '.join(f"({i}, {text(n)}, {text(t)})" for i, (n, t, _) in enumerate(LABELS))}) f(i, feature_name, feature_type)""",
    "listed_slots": r"""SELECT category, feature_name, feature_type AS slot_type,
        list_filter(regexp_extract_all(aggregated_feature_values, '\[([^\]]*)\]', 1), lambda v: v <> '') AS listed
      FROM (SELECT *, row_number() OVER (PARTITION BY category, feature_name ORDER BY row_pos DESC) AS rn FROM taxonomy) WHERE rn = 1""",
    "slot_units": r"""SELECT category, feature_name, unit FROM (
        SELECT category, feature_name, unit, row_number() OVER (PARTITION BY category, feature_name ORDER BY count(*) DESC, min(pos)) AS rn
        FROM (SELECT category, feature_name, pos, regexp_extract(trim(v), '^[\d.,\s\-+/ca.]+\s+(.+)$', 1) AS unit
              FROM (SELECT category, feature_name, unnest(listed) AS v, generate_subscripts(listed, 1) AS pos FROM listed_slots WHERE slot_type <> 'categorical'))
        WHERE unit <> '' GROUP BY category, feature_name, unit) WHERE rn = 1""",
    "slots": f"""SELECT category, feature_name, slot_type, listed,
        list_transform(list_sort(list_transform(list_distinct(listed), lambda v: {{'n': -length(v), 'v': v}})), lambda s: s.v) AS allowed,
        unit,
        [lower(feature_name), replace(replace(lower(feature_name), '-', ' '), 'ø', 'durchmesser'),
         lower(replace(feature_name, 'Ø', 'Durchmesser')), lower(replace(feature_name, 'Durchmesser', 'Ø'))]
          || list_transform({_ALIASES}, lambda a: lower(a)) || list_transform({_ALIASES}, lambda a: replace(replace(lower(a), '-', ' '), 'ø', 'durchmesser')) AS terms
      FROM listed_slots LEFT JOIN slot_units USING (category, feature_name)""",
    "slot_values": "SELECT category, feature_name, slot_type, unnest(allowed) AS value, generate_subscripts(allowed, 1) - 1 AS pos FROM slots",
    "work": f"""SELECT uid, category, title, description, feature_name, slot_type AS feature_type, allowed, unit, terms, body AS text, lower(body) AS text_lower,
        {german('body')} AS text_number
      FROM (SELECT *, coalesce(title, '') || ' ' || coalesce(description, '') AS body FROM products) JOIN slots USING (category)""",
    "title_lookup": """SELECT feature_name, title, value, n FROM (
        SELECT feature_name, title, feature_value AS value, count(*) AS n,
          row_number() OVER (PARTITION BY feature_name, title ORDER BY count(*) DESC, feature_value) AS rn
        FROM labels JOIN products USING (uid) WHERE split = 'train' GROUP BY feature_name, title, feature_value) WHERE rn = 1""",
    "feature_mode": """SELECT feature_name, value, n FROM (
        SELECT feature_name, feature_value AS value, count(*) AS n, row_number() OVER (PARTITION BY feature_name ORDER BY count(*) DESC, feature_value) AS rn
        FROM labels WHERE split = 'train' GROUP BY feature_name, feature_value) WHERE rn = 1""",
    "order_catalog": """SELECT l.line_uid AS uid, category, title, description
      FROM (SELECT l_orderkey * 10 + l_linenumber AS line_uid, min(l_partkey) AS part_uid FROM lineitem GROUP BY 1) l JOIN products p ON p.uid = l.part_uid""",
    "document_catalog": "SELECT doc_id AS uid, source AS category, lang || ' ' || source AS title, text AS description FROM documents",
}

NEEDS = {
    "template": ["products"],
    "listed_slots": ["taxonomy"],
    "slot_units": ["listed_slots"],
    "slots": ["listed_slots", "slot_units"],
    "slot_values": ["slots"],
    "work": ["products", "slots"],
    "title_lookup": ["labels", "products"],
    "feature_mode": ["labels"],
    "order_catalog": ["products"],
}


def with_relations(body: str, *names: str, extra: dict[str, str] | None = None, needs: dict[str, list[str]] | None = None) -> str:
    """``body`` behind the named relations and everything they need."""
    relations = {**RELATIONS, **(extra or {})}
    required = {**NEEDS, **(needs or {})}
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in required.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({relations[n]})" for n in ordered) + "\n" + body
