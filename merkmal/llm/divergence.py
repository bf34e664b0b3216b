"""Source divergence audit: how far each source's term distribution lies from its language and from the other sources.

Term counts and document frequencies are aggregates with map-side combine, so a source holding a third of all
rows costs no more than its number of distinct terms. The top terms of a source come from a dominance skyband:
a term with a higher (or equal) count in the source, a lower (or equal) count in the language and an earlier
UTF-8 spelling always scores at least as high and wins ties, so a term that at least ``TOP`` others dominate can
never be among the first ``TOP``. Each source's candidate terms are split into cells by hash; every cell keeps
its local skyband (a term dominated by ``TOP`` others inside a cell is dominated by as many overall), the
skybands of a source are merged, and only those few terms are scored and ranked exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from merkmal.llm.common import _POWERS, _SPREAD, ascii_lower, mixed, read_table, small_batches, split_words
from merkmal.operators.scale import sent_if_small
from merkmal.session import cut_lineage

# Fixed values of the contract.
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000

#: candidate terms of one source per skyband cell, so no Python task holds a whole hot source
CELL_TERMS = 20_000
#: hash buckets of the document-frequency sketch per language, summed in chunks; the bitmap sent to tasks is
#: languages x SKETCH bits (256 KB a language)
SKETCH, CHUNK = 1 << 21, 1 << 16


def terms(text: Column) -> Column:
    """Terms of a text: runs of letters and non-ASCII characters, A-Z lower-cased; null has none."""
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), NOT_TERM)


def share(count: str, total: str, kept: str) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact; 38 digits where a long can't hold the product."""
    wide = f"(CAST({SCALE} AS DECIMAL(38,0)) * CAST({count} + 2 AS DECIMAL(38,0))) div CAST({total} + 2 * {kept} AS DECIMAL(38,0))"
    fits = (2**63 - 1) // SCALE - 2
    return F.expr(f"1 + CASE WHEN {count} <= {fits}L THEN ({SCALE}L * ({count} + 2)) div ({total} + 2 * {kept}) ELSE CAST({wide} AS BIGINT) END").cast("long")


def apart(p: str, q: str) -> Column:
    """f = floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})").cast("long")


class _Counted:
    """Terms of a batch as numbers: distinct ``terms``, and per (term, row) that occurs its ``code``, ``row`` and ``times``.

    ``lang`` and ``source`` of every row read null as ''; so does the text.
    """

    def __init__(self, batch: pa.RecordBatch):
        self.lang, self.source = (pc.fill_null(batch.column(c), "").dictionary_encode() for c in ("lang", "source"))
        words = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(batch.column("text"), "")), NOT_TERM)
        flat, row = pc.list_flatten(words), pc.list_parent_indices(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = flat.dictionary_encode()
        self.terms = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        blank = pc.index(self.terms, "").as_py()  # what stands before the first and after the last gap
        if blank >= 0:
            code, row = code[code != blank], row[code != blank]
        at, self.times = _runs(code * batch.num_rows + row)
        self.code, self.row = at // max(batch.num_rows, 1), at % max(batch.num_rows, 1)


def _runs(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their number (or the sum of their ``weights``)."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys)) if weights is None else np.add.reduceat(weights, first)


def _buckets(terms: pa.Array, size: int) -> np.ndarray:
    """Bucket of every (non-empty) string, from a hash of its UTF-8 bytes computed on the Arrow buffers."""
    terms = terms.cast(pa.large_string()) if not pa.types.is_large_string(terms.type) else terms
    if not len(terms):
        return np.empty(0, np.int64)
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(data)) - np.repeat(starts, np.diff(offsets))
    summed = np.add.reduceat(_SPREAD[data] * _POWERS[place & 0xFFFF], starts)
    return (mixed(summed) % np.uint64(size)).astype(np.int64)


def sketch_counts(batches, size: int = SKETCH, rows: int = 500):
    """Per task and language: documents per hash bucket of terms, as ``lang, chunk, counts`` (chunks of ``CHUNK``).

    Counts are kept up to ``MIN_DOCS`` (more cannot change the decision), as bytes compressed with zstd, so a
    task sends at most languages x ``size`` bytes before compression. A bucket's total over all tasks, so
    capped, reaches ``MIN_DOCS`` whenever the document frequency of any term in it does.
    """
    held: dict[str, np.ndarray] = {}
    for batch in small_batches(batches, rows):
        found = _Counted(batch)
        if not len(found.code):
            continue
        buckets = _buckets(found.terms, size)
        of_row = found.lang.indices.to_numpy(zero_copy_only=False)
        for number, lang in enumerate(found.lang.dictionary.to_pylist()):
            terms, docs = _runs(found.code[of_row[found.row] == number])
            counts = held.setdefault(lang, np.zeros(size, np.int64))
            np.add.at(counts, buckets[terms], docs)
    pack = zstandard.ZstdCompressor(level=1)
    for lang, counts in held.items():
        capped = np.minimum(counts, MIN_DOCS).astype(np.uint8).reshape(-1, CHUNK)
        used = np.flatnonzero(capped.any(1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array([pack.compress(capped[c].tobytes()) for c in used], pa.binary())],
                names=["lang", "chunk", "counts"],
            )


def frequent_buckets(docs: DataFrame, size: int = SKETCH) -> dict[str, np.ndarray]:
    """Per language, a bitmap of the buckets whose document total reaches ``MIN_DOCS``; languages x ``size`` bits."""
    partial = docs.select("lang", "source", "text").mapInArrow(
        lambda b: sketch_counts(b, size), "lang string, chunk int, counts binary"
    )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        total = np.zeros(CHUNK, np.int64)
        for blob in frame["counts"]:
            total += np.frombuffer(unpack.decompress(blob), np.uint8)
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "chunk": frame["chunk"].iloc[:1], "bits": [np.packbits(total >= MIN_DOCS).tobytes()]})

    summed = partial.groupBy("lang", "chunk").applyInPandas(add, "lang string, chunk int, bits binary")
    out: dict[str, np.ndarray] = {}
    for row in summed.collect():  # at most languages x size / CHUNK rows of CHUNK bits
        bits = out.setdefault(row["lang"], np.zeros(size, bool))
        bits[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return out


def batch_counts(batches, frequent: dict[str, np.ndarray], rows: int = 500, held_rows: int = 500_000):
    """Per task: ``lang, source, term, count, n_docs`` of the terms whose bucket may be frequent.

    Texts are taken ``rows`` at a time; partial counts are merged again whenever more than ``held_rows`` lines
    are held (half as many beyond the distinct ones), so memory follows the task's distinct lines however long the texts.
    """
    held, size, limit = [], 0, held_rows

    def merged(tables):
        table = pa.concat_tables(tables)
        summed = table.group_by(["lang", "source", "term"]).aggregate([("count", "sum"), ("n_docs", "sum")])
        return summed.rename_columns(["lang", "source", "term", "count", "n_docs"]).cast(_COUNTS)

    for batch in small_batches(batches, rows):
        found = _Counted(batch)
        if not len(found.code):
            continue
        buckets = _buckets(found.terms, SKETCH)
        langs, sources = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (found.lang, found.source))
        keep = np.zeros(len(found.code), bool)
        for number, lang in enumerate(found.lang.dictionary.to_pylist()):
            if lang in frequent:
                mine = np.flatnonzero(langs[found.row] == number)
                keep[mine] = frequent[lang][buckets[found.code[mine]]]
        if not keep.any():
            continue
        n_sources = len(found.source.dictionary)
        group = langs * n_sources + sources
        n_groups = len(found.lang.dictionary) * n_sources
        keys = found.code[keep] * n_groups + group[found.row[keep]]
        at, count = _runs(keys, found.times[keep])
        _, n_docs = _runs(keys)
        of = at % n_groups
        held.append(pa.Table.from_arrays([
            found.lang.dictionary.take(pa.array(of // n_sources)), found.source.dictionary.take(pa.array(of % n_sources)),
            found.terms.take(pa.array(at // n_groups)), pa.array(count), pa.array(n_docs)], names=_COUNTS.names).cast(_COUNTS))
        size += len(at)
        if size > limit:
            held = [merged(held)]
            size = held[0].num_rows
            limit = max(held_rows, size + held_rows // 2)
    if held:
        yield from merged(held).to_batches(max_chunksize=100_000)


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("n_docs", pa.int64())])


def counted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``groups (lang, source)``, ``kept (lang, term, lang_count)`` and ``held (lang, source, term, count, lang_count)``.

    Null lang, source and text read as ''. A term is kept in a language when at least ``MIN_DOCS`` of its rows
    hold it; ``held`` has only kept terms that occur in the source (count > 0). A first pass sums, per language,
    documents per hash bucket of terms over all tasks; a term whose bucket holds fewer than ``MIN_DOCS`` documents
    cannot be kept. The second pass splits texts again (Arrow compute inside tasks) and sends on partial counts of
    the other terms only; Spark adds them up after one shuffle by term, the exact frequency decides, and ``held`` is written to the shared folder, so later parts read it instead of the texts.
    """
    lang = F.coalesce(F.col("lang"), F.lit("")).alias("lang")
    source = F.coalesce(F.col("source"), F.lit("")).alias("source")
    groups = cut_lineage(docs.select(lang, source).distinct())
    frequent = frequent_buckets(docs)
    partial = docs.select("lang", "source", "text").mapInArrow(
        lambda b: batch_counts(b, frequent), "lang string, source string, term string, count long, n_docs long"
    )
    per_source = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("n_docs").alias("n_docs")
    )
    whole = Window.partitionBy("lang", "term")  # at most one line per source
    held = per_source.select(
        "lang", "source", "term", "count", F.sum("n_docs").over(whole).alias("in_docs"), F.sum("count").over(whole).alias("lang_count")
    ).filter(F.col("in_docs") >= MIN_DOCS).drop("in_docs")
    held = cut_lineage(held)
    kept = held.groupBy("lang", "term").agg(F.first("lang_count").alias("lang_count"))
    return groups, kept, held


def scored(groups: DataFrame, kept: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sources`` (lang, source, n_kept, n_terms, zero) and ``cells`` (held rows with p and q).

    ``n_kept`` is V of the language, ``n_terms`` the kept terms the source holds, ``zero`` the p of a term absent
    from it (null where V = 0).
    """
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("lang_count").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("n_terms"))
    sources = (
        groups.join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"),
            F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"),
            F.coalesce("total", F.lit(0)).cast("long").alias("total"),
            F.coalesce("lang_total", F.lit(0)).cast("long").alias("lang_total"),
        )
    )
    sources = sources.withColumn(
        "zero", F.when(F.col("n_kept") > 0, share("0", "total", "n_kept"))
    )
    sources = cut_lineage(sources)
    cells = held.join(sent_if_small(sources), ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "count",
        "lang_count",
        "zero",
        share("count", "total", "n_kept").alias("p"),
        share("lang_count", "lang_total", "n_kept").alias("q"),
    )
    return sources.drop("total", "lang_total"), cells


def local_skyband(frame: pd.DataFrame, k: int = TOP, block: int = 256) -> pd.DataFrame:
    """Rows of one cell that fewer than ``k`` others dominate (count >=, lang_count <=, term earlier in UTF-8).

    Rows are visited by count descending, lang_count ascending and term: only earlier rows can dominate a row,
    and a row with ``k`` dominators always has ``k`` of them inside the band. Rows are decided ``block`` at a
    time: dominators are counted among the band and the earlier rows of the block, which decides alike, since
    an earlier row outside the band brings ``k`` dominators of its own.
    """
    if frame.empty:
        return frame
    spelling = frame["term"].map(lambda t: t.encode("utf-8"))
    place = np.empty(len(frame), np.int64)
    place[np.argsort(spelling.to_numpy(), kind="stable")] = np.arange(len(frame))
    order = np.lexsort((place, frame["lang_count"].to_numpy(), -frame["count"].to_numpy()))
    lang_count = frame["lang_count"].to_numpy()[order]
    spelled = place[order]
    band_lc, band_sp, keep = np.empty(0, np.int64), np.empty(0, np.int64), []
    for first in range(0, len(order), block):
        lc, sp = lang_count[first : first + block], spelled[first : first + block]
        outside = ((band_lc[None, :] <= lc[:, None]) & (band_sp[None, :] <= sp[:, None])).sum(1)
        inside = np.tril((lc[None, :] <= lc[:, None]) & (sp[None, :] <= sp[:, None]), -1).sum(1)
        chosen = outside + inside < k
        band_lc, band_sp = np.concatenate([band_lc, lc[chosen]]), np.concatenate([band_sp, sp[chosen]])
        keep.append(order[first : first + block][chosen])
    return frame.iloc[np.sort(np.concatenate(keep))]


def top_terms(cells: DataFrame, k: int = TOP, cell_terms: int = CELL_TERMS) -> DataFrame:
    """Part ``term``: per source, the first ``k`` kept terms with count > 0 and p > q by f, then UTF-8 term."""
    candidates = cells.filter(F.col("p") > F.col("q"))
    sizes = candidates.groupBy("lang", "source").agg(
        F.ceil(F.count("*") / F.lit(cell_terms)).cast("long").alias("n_cells")
    )
    cut = candidates.join(sizes, ["lang", "source"]).withColumn(
        "cell", F.pmod(F.xxhash64("term"), F.col("n_cells"))
    )
    schema = "lang string, source string, term string, count long, lang_count long, p long, q long"
    band = cut.select("lang", "source", "term", "count", "lang_count", "p", "q", "cell").groupBy(
        "lang", "source", "cell"
    ).applyInPandas(lambda frame: local_skyband(frame.drop(columns=["cell"]), k), schema)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = band.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value")
    ).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def source_pairs(sources: DataFrame, cells: DataFrame) -> DataFrame:
    """Part ``pair``: for each other source of the language, f summed over all kept terms.

    Only terms held by both sources meet in a join; terms held by one of them are summed from a histogram of
    its p values against the other's ``zero``, and terms held by neither count ``zero`` against ``zero``.
    """
    a = cells.select("lang", "term", F.col("source").alias("source"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    b = cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    half = (
        a.join(b, ["lang", "term"])
        .filter(F.col("source") < F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(apart("pa", "pb") - apart("pa", "zb") - apart("pb", "za")).alias("both"),
            F.count("*").alias("n_both"),
        )
    )
    half = cut_lineage(half)  # a line per pair; both ways round they are equal
    shared = half.union(half.select("lang", "item", "source", "both", "n_both"))
    other = sources.select("lang", F.col("source").alias("item"), F.col("zero").alias("zb"), F.col("n_terms").alias("n_b"))
    histogram = cells.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    alone = (
        histogram.join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("times") * apart("p", "zb")).alias("alone"))
    )
    pairs = sources.join(other, "lang").filter(F.col("source") != F.col("item"))
    flipped = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_b"))
    whole = (
        pairs.join(shared, ["lang", "source", "item"], "left")
        .join(alone, ["lang", "source", "item"], "left")
        .join(flipped, ["lang", "source", "item"], "left")
    )
    neither = F.col("n_kept") - F.col("n_terms") - F.col("n_b") + F.coalesce(F.col("n_both"), F.lit(0))
    value = F.when(F.col("n_kept") == 0, F.lit(0)).otherwise(
        F.coalesce(F.col("both"), F.lit(0))
        + F.coalesce(F.col("alone"), F.lit(0))
        + F.coalesce(F.col("alone_b"), F.lit(0))
        + neither * apart("zero", "zb")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return whole.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn(
        "rank", F.row_number().over(order)
    )


def divergence(docs: DataFrame, k: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every occurring (lang, source).

    Reads ``lang``, ``source`` and ``text`` only; other columns, whatever their names, are ignored. Null lang,
    source or text is ''. Repeated rows count as often as they occur. A source with no kept term gives pair rows
    (their value is the sum over the language's terms absent from both) and no term rows; a language with no
    kept term gives value 0 for every pair. A language with one source gives no pair rows. Empty tables give no
    rows. Ties in value go to the item first in UTF-8 order. Very long texts are split like any other.
    """
    groups, kept, held = counted(docs)
    sources, cells = scored(groups, kept, held)
    return source_pairs(sources, cells).unionByName(top_terms(cells, k)).select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts over every document."""
    return divergence(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH rows AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words,
         row_number() OVER () AS rid
  FROM documents),
words AS (SELECT lang, source, rid, unnest(words) AS term FROM rows),
occ AS (SELECT * FROM words WHERE term <> ''),
in_docs AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
held AS (SELECT o.lang, o.source, o.term, count(*) AS cnt FROM occ o JOIN in_docs USING (lang, term) GROUP BY ALL),
kept AS (SELECT lang, term, sum(cnt) AS lcnt FROM held GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lcnt) AS ltot FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM rows),
totals AS (SELECT lang, source, sum(cnt) AS tot, count(*) AS nt FROM held GROUP BY ALL),
src AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(t.nt, 0) AS nt, coalesce(t.tot, 0) AS tot,
         coalesce(l.ltot, 0) AS ltot
  FROM groups g LEFT JOIN langs l USING (lang) LEFT JOIN totals t USING (lang, source)),
dense AS (
  SELECT s.lang, s.source, k.term, coalesce(h.cnt, 0) AS cnt, k.lcnt, s.v, s.tot, s.ltot
  FROM src s JOIN kept k USING (lang) LEFT JOIN held h ON h.lang = s.lang AND h.source = s.source AND h.term = k.term),
pq AS (
  SELECT lang, source, term, cnt,
         1 + (CAST(1000000000 AS HUGEINT) * (cnt + 2)) // (tot + 2 * v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (lcnt + 2)) // (ltot + 2 * v) AS q
  FROM dense),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p))
                   FROM pq x JOIN pq y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM src a JOIN src b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM pq WHERE cnt > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
