"""Benchmark decontamination by winnowed k-gram fingerprints, joined and extended to whole windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from merkmal.llm.common import ALNUM_TABLE, WordHashes, read_table, rolling, small_batches
from merkmal.session import cut_lineage

WINDOW = 10
GRAM = 5
FILTER_BITS = 23

_PRINT = "h long, k int, p int, gram string, before array<string>, after array<string>"
_PRINT_ARROW = pa.list_(pa.struct([("h", pa.int64()), ("k", pa.int32()), ("p", pa.int32()), ("gram", pa.string()),
                                   ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the rightmost minimum of every ``width`` consecutive hashes, each once."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    return np.unique(np.arange(len(view)) + (width - 1) - np.argmin(view, axis=1))


def fingerprints(words: list[bytes], cache: WordHashes, window: int, gram: int, member=None) -> list[dict]:
    """Winnowed fingerprints of a text with the words around them.

    Any span of ``window`` words has a k-gram that is chosen alike wherever the
    span stands. ``member`` tells which hashes are worth keeping; the choice
    itself is made over all k-grams.
    """
    grams = rolling(cache.of(words), gram)
    keep = None if member is None else member(grams)
    if keep is not None and not keep.any():
        return []
    places = winnowed(grams, window - gram + 1)
    if keep is not None:
        places = places[keep[places]]
    reach = window - gram
    text = lambda a, b: [w.decode() for w in words[max(0, a):b]]
    return [
        {"h": int(grams[p].view(np.int64)), "k": 0, "p": int(p), "gram": " ".join(text(p, p + gram)),
         "before": text(p - reach, p)[::-1], "after": text(p + gram, p + gram + reach)}
        for p in places
    ]


def whole_grams(words: list[bytes], cache: WordHashes, k: int, member=None) -> list[dict]:
    """Every run of ``k`` words, for items that have just ``k`` words."""
    grams = rolling(cache.of(words), k) ^ np.uint64(k)
    places = range(len(grams)) if member is None else np.flatnonzero(member(grams))
    return [
        {"h": int(grams[p].view(np.int64)), "k": k, "p": int(p), "gram": b" ".join(words[p:p + k]).decode(), "before": [], "after": []}
        for p in places
    ]


def _words(value: bytes | None) -> list[bytes]:
    return value.translate(ALNUM_TABLE).split() if value else []


def item_fingerprints(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Fingerprints of the items; an item of fewer than ``window`` words has one, of all its words.

    Items shorter than the window carry ``k`` = their word count, others 0.
    """

    def run(batches):
        cache = WordHashes()
        for batch in small_batches(batches):
            ids, out = [], []
            for item, value in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = _words(value)
                if not words:
                    continue
                ids.append(item)
                if len(words) >= window:
                    out.append(fingerprints(words, cache, window, gram))
                else:
                    out.append(whole_grams(words, cache, len(words)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, _PRINT_ARROW)], names=["item_id", "prints"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, f"item_id long, prints array<struct<{_sql(_PRINT)}>>")
    return rows.select("item_id", F.explode("prints").alias("f")).select("item_id", "f.*")


def _sql(fields: str) -> str:
    return ", ".join(f"{a}: {b}" for a, b in (x.strip().split(" ", 1) for x in fields.split(", ")))


def hash_filter(prints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of ``2**bits`` positions (1 MB at 23 bits, whatever the benchmark holds) for fingerprint hashes.

    It only spares shuffling documents' fingerprints that cannot join; the join is exact.
    """
    at = F.shiftrightunsigned("h", 64 - bits)
    lines = prints.groupBy(F.shiftright(at, 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(h, %d) & 63 as int)))" % (64 - bits)).alias("b"))
    table = np.zeros(2 ** (bits - 6), np.int64)
    for row in lines.collect():  # at most 2**(bits - 6) lines
        table[row["w"]] = row["b"]
    return table.view(np.uint64)


def document_fingerprints(docs: DataFrame, table: np.ndarray, short: list[int], window: int = WINDOW, gram: int = GRAM,
                          bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_words and the fingerprints that pass the filter, one row per document."""
    handle = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        cache, bitmap = WordHashes(), handle.value

        def member(h):
            at = h >> np.uint64(64 - bits)
            return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0

        for batch in small_batches(batches):
            counts, out = [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                words = _words(value)
                counts.append(len(words))
                out.append(_document(words, cache, window, gram, short, member))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(out, _PRINT_ARROW)],
                                             names=["doc_id", "n_words", "prints"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, prints array<struct<{_sql(_PRINT)}>>")


def _document(words, cache, window, gram, short, member) -> list[dict]:
    found = fingerprints(words, cache, window, gram, member) if len(words) >= window else []
    for k in short:
        found += whole_grams(words, cache, k, member)
    return found


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of ``docs``.

    Fingerprints are joined on hash and text, then extended to both sides; a run
    of at least ``window`` equal words hits all of its words. Winnowing with
    k-grams of ``gram`` words in windows of ``window`` words cannot miss one.
    Null or empty texts have no words. Items without words hit nothing; items
    without id hit words but are not listed. Rows with equal ids stay apart.
    """
    if not 0 < gram < window:
        raise ValueError("a gram must be shorter than the window")
    prints = cut_lineage(item_fingerprints(items, window, gram))
    short = sorted(r["k"] for r in prints.filter("k > 0").select("k").distinct().collect())  # fewer than window lengths
    base = cut_lineage(
        document_fingerprints(docs, hash_filter(prints), short, window, gram).withColumn("row", F.monotonically_increasing_id())
    )
    own = base.filter(F.size("prints") > 0).select("row", F.explode("prints").alias("d")).select(
        "row", F.col("d.h").alias("h"), F.col("d.k").alias("k"), F.col("d.p").alias("p"), F.col("d.gram").alias("gram"),
        F.col("d.before").alias("d_before"), F.col("d.after").alias("d_after"))
    theirs = prints.select("h", "k", "gram", "item_id", F.col("before").alias("i_before"), F.col("after").alias("i_after"))
    both = own.join(theirs, ["h", "k", "gram"])
    steps = F.array(*[F.lit(i) for i in range(1, window - gram + 1)])

    def run(a: str, b: str):
        equal = lambda i: (F.size(a) >= i) & (F.size(b) >= i) & (F.slice(a, 1, i) == F.slice(b, 1, i))
        return F.size(F.filter(steps, equal))

    size = F.when(F.col("k") > 0, F.col("k")).otherwise(F.lit(gram))
    spans = both.withColumn("l", run("d_before", "i_before")).withColumn("r", run("d_after", "i_after")).select(
        "row", "item_id", "k", (F.col("p") - F.col("l")).alias("start"), (F.col("p") + size + F.col("r")).alias("end"))
    spans = cut_lineage(spans.filter(f"k > 0 or end - start >= {window}").select("row", "item_id", "start", "end").distinct())

    seen = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.col("seen"), F.lit(0))))
    hits = spans.select("row", "start", "end").distinct().withColumn("seen", seen).groupBy("row").agg(F.sum(fresh).alias("n_hit"))
    listed = spans.filter("item_id is not null").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("ids"))
    none = F.array().cast("array<string>")
    ids = F.coalesce("ids", none)
    return (
        base.select("row", "doc_id", "n_words").join(hits, "row", "left").join(listed, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
