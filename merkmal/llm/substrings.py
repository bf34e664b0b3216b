"""Exact substring removal by fixed-block anchors.

Documents are spread over homes. Every home indexes the non-overlapping blocks
of its documents (``BLOCK`` words at multiples of ``BLOCK``) and probes with
every rolling window of as many words: blocks and probes meet by hash. A span of
``WINDOW = 2 * BLOCK - 1`` words holds a whole block of whatever document it
stands in, so a span that repeats in another document has a probe that hits.
Hits are extended: only the spans around them are compared, by 80 bits of hash, and the smallest
doc_id of each decides; what is covered by overlapping repeated spans is a maximal repeat.

A home sends each distinct hash once, and a bucket of hashes answers each home
once, so the most frequent passage costs one entry per home, not one per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from merkmal.llm.common import lean_memory, read_table, rolling, text_hashes
from merkmal.llm.packed import (
    from_planes, group_bits, packed_by_home, packed_sorted, planes, unpacked_sorted, unpacked_table,
)

BLOCK = 7
WINDOW = 2 * BLOCK - 1
_OTHER = np.uint64(0xD6E8FEB86659FD93)


class Texts:
    """Word hashes of the documents of one home end to end, documents in order of doc_id."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by([("doc_id", "ascending")])
        ids = self.table.column("doc_id")
        self.known = np.array(ids.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        self.ids = np.array([i or 0 for i in ids.to_pylist()], dtype=np.int64)
        texts = self.table.column("text").cast(pa.binary()).to_pylist()
        self.hashes, self.sizes = text_hashes([t or b"" for t in texts])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def words(self, i: int) -> list[bytes]:
        value = self.table.column("text")[i]
        return value.as_buffer().to_pybytes().split() if value.is_valid else []

    def places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat place and document of every run of ``k`` words that can belong to a window of a document with an id."""
        long = (self.sizes >= WINDOW) & self.known
        counts = np.where(long, self.sizes - k + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        return np.arange(counts.sum()) - first[doc] + self.starts[doc], doc


def _texts(payloads: pa.Table) -> Texts:
    return Texts(unpacked_table(payloads.column("payload").to_pylist()))


def _split(values: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Buckets (the highest ``bits``) of ascending 64-bit hashes and their slices."""
    buckets, starts = np.unique((values >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
    return [(int(b), slice(s, e)) for b, s, e in zip(buckets, starts, [*starts[1:], len(values)])]


def _residues(values: np.ndarray, bits: int) -> np.ndarray:
    """32 bits after the bucket bits; ascending inside a bucket. Buckets have a bounded size, so 32 bits are enough to
    keep false hits few; hits are compared in full later."""
    return ((values >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _table(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({k: pa.array(v, types[k]) for k, v in columns.items()})


_INT, _BIN = pa.int32(), pa.binary()


def probes(packed: DataFrame, bits: int) -> DataFrame:
    """Per home and bucket: hashes of its indexed blocks, and of its other rolling windows."""

    def run(key, table):
        lean_memory()
        texts = _texts(table)
        flat, doc = texts.places(BLOCK)
        grams = rolling(texts.hashes, BLOCK)[flat] if len(flat) else np.empty(0, np.uint64)
        aligned = (flat - texts.starts[doc]) % BLOCK == 0 if len(flat) else np.empty(0, bool)
        indexed = np.unique(grams[aligned])
        others = np.setdiff1d(np.unique(grams), indexed, assume_unique=True)
        out: dict[int, list] = {}
        for place, values in ((0, indexed), (1, others)):
            for bucket, part in _split(values, bits):
                out.setdefault(bucket, [b"", b""])[place] = packed_sorted(_residues(values[part], bits))
        home = key[0].as_py()
        return _table({"home": [home] * len(out), "bucket": list(out), "blocks": [x[0] for x in out.values()], "others": [x[1] for x in out.values()]},
                      {"home": _INT, "bucket": _INT, "blocks": _BIN, "others": _BIN})

    return packed.groupBy("home").applyInArrow(run, "home int, bucket int, blocks binary, others binary")


def hits(probed: DataFrame) -> DataFrame:
    """Per bucket and home: hashes of the home that are a block somewhere and stand in another home too."""

    def run(key, table):
        lean_memory()
        blocks = [unpacked_sorted(x, np.uint32) for x in table.column("blocks").to_pylist()]
        others = [unpacked_sorted(x, np.uint32) for x in table.column("others").to_pylist()]
        index = np.unique(np.concatenate(blocks))
        met = [np.concatenate([b, o[np.isin(o, index, assume_unique=True)]]) for b, o in zip(blocks, others)]
        values, homes = np.unique(np.concatenate(met), return_counts=True)
        values = values[homes > 1]
        found = [np.sort(m[np.isin(m, values)]) for m in met]
        rows = [(h, packed_sorted(f)) for h, f in zip(table.column("home").to_pylist(), found) if len(f)]
        return _table({"home": [r[0] for r in rows], "bucket": [key[0].as_py()] * len(rows), "hits": [r[1] for r in rows]},
                      {"home": _INT, "bucket": _INT, "hits": _BIN})

    return probed.groupBy("bucket").applyInArrow(run, "home int, bucket int, hits binary")


def _windows(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat, doc = texts.places(WINDOW)
    return flat, doc, rolling(texts.hashes, WINDOW)[flat] if len(flat) else np.empty(0, np.uint64)


def spans(packed: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """Per home and bucket: the distinct windows around hits, and the smallest doc_id of each in the home."""

    def run(key, left, right):
        lean_memory()
        out: dict[str, list] = {"home": [], "bucket": [], "spans": [], "checks": [], "ids": []}
        types = {"home": _INT, "bucket": _INT, "spans": _BIN, "checks": _BIN, "ids": _BIN}
        if not left.num_rows or not right.num_rows:
            return _table(out, types)
        texts = _texts(left)
        flat, doc = texts.places(BLOCK)
        grams = rolling(texts.hashes, BLOCK)
        hot = np.concatenate([
            (np.uint64(b) << np.uint64(32)) | unpacked_sorted(x, np.uint32).astype(np.uint64)
            for b, x in zip(right.column("bucket").to_pylist(), right.column("hits").to_pylist())])
        short = grams[flat] >> np.uint64(32 - bits)
        hit = np.zeros(len(texts.hashes) + 1, np.int32)
        hit[flat[np.isin(short, hot)] + 1] = 1
        before = np.cumsum(hit)
        flat, doc, values = _windows(texts)
        chosen = before[flat + WINDOW - BLOCK + 1] > before[flat]  # a hit inside the window
        flat, doc, values = flat[chosen], doc[chosen], values[chosen]
        values, first = np.unique(values, return_index=True)  # documents are in order, so the first place has the smallest id
        checks = rolling(texts.hashes, WINDOW, _OTHER)[flat[first]] if len(first) else values
        ids = texts.ids[doc[first]]
        for bucket, part in _split(values, bits):
            out["home"].append(key[0].as_py())
            out["bucket"].append(bucket)
            out["spans"].append(packed_sorted(values[part]))
            out["checks"].append(planes((checks[part] >> np.uint64(48)).astype(np.uint16)))
            out["ids"].append(planes(ids[part]))
        return _table(out, types)

    return packed.groupBy("home").cogroup(found.groupBy("home")).applyInArrow(
        run, "home int, bucket int, spans binary, checks binary, ids binary")


def repeats(windows: DataFrame) -> DataFrame:
    """Per bucket and home: windows of the home that start in a smaller document of another home."""

    def run(table):
        lean_memory()
        homes = table.column("home").to_pylist()
        parts = [unpacked_sorted(x, np.uint64) for x in table.column("spans").to_pylist()]
        home = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        value = np.concatenate(parts)
        check = np.concatenate([from_planes(x, np.uint16) for x in table.column("checks").to_pylist()])
        ids = np.concatenate([from_planes(x, np.int64) for x in table.column("ids").to_pylist()])
        order = np.lexsort((ids, check, value))
        value, check, ids, home = value[order], check[order], ids[order], home[order]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (check[1:] != check[:-1])])
        least = ids[np.flatnonzero(new)[np.cumsum(new) - 1]]
        gone = ids > least
        rows = [(homes[h], packed_sorted(value[gone & (home == h)])) for h in np.unique(home[gone])]
        return _table({"home": [r[0] for r in rows], "spans": [r[1] for r in rows]}, {"home": _INT, "spans": _BIN})

    return windows.groupBy("bucket").applyInArrow(run, "home int, spans binary")


def _cut(table: pa.Table, far: list[bytes]) -> tuple[Texts, np.ndarray]:
    """The documents of a home, and which of their words a repeated window covers."""
    texts = Texts(table)
    flat, doc, values = _windows(texts)
    known = [unpacked_sorted(x, np.uint64) for x in far]
    gone = np.isin(values, np.concatenate(known)) if known else np.zeros(len(values), bool)
    order = np.argsort(values, kind="stable")  # documents are in order, so a group starts with its smallest id
    new = np.concatenate([[True], values[order][1:] != values[order][:-1]]) if len(values) else np.empty(0, bool)
    ids = texts.ids[doc[order]]
    gone[order] |= ids > ids[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(values) else False
    edge = np.zeros(len(texts.hashes) + 1, np.int64)
    np.add.at(edge, flat[gone], 1)
    np.add.at(edge, flat[gone] + WINDOW, -1)
    return texts, np.cumsum(edge)[:-1] > 0


def without_repeats(docs: DataFrame, carry: list[str], digest: bool = False) -> DataFrame:
    """Per row: the ``carry`` columns, n_words, n_removed, and the kept words.

    A word is removed if a window of ``WINDOW`` words over it starts in a
    document with a smaller doc_id as well. Kept words are joined by one space
    into ``kept`` (with ``digest`` into their SHA-256, kept_sha256). Null texts have
    no words. Rows without doc_id neither lose words nor cost others any; rows
    with equal ids are one document and do not repeat each other.
    """
    rows = docs.select("doc_id", "text", *[c for c in carry if c not in ("doc_id", "text")])
    bits = group_bits(rows)
    packed = packed_by_home(rows, bits)
    far = repeats(spans(packed, hits(probes(packed, bits)), bits))
    fields = [rows.schema[c] for c in carry]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_words long, n_removed long", "kept_sha256 string" if digest else "kept string"])

    def run(left, right):
        lean_memory()
        table = unpacked_table(left.column("payload").to_pylist()) if left.num_rows else None
        if table is None:
            raise ValueError("an answer without its home")
        texts, covered = _cut(table, right.column("spans").to_pylist())
        removed, kept = [], []
        for i in range(texts.table.num_rows):
            words, part = texts.words(i), covered[texts.starts[i] : texts.starts[i] + texts.sizes[i]]
            n = int(part.sum())
            left_over = b" ".join([w for w, gone in zip(words, part) if not gone] if n else words)
            removed.append(n)
            kept.append(hashlib.sha256(left_over).hexdigest() if digest else left_over.decode("utf-8", "surrogatepass"))
        columns = {c: texts.table.column(c) for c in carry}
        return pa.table({**columns, "n_words": pa.array(texts.sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "kept_sha256" if digest else "kept": pa.array(kept, pa.string())})

    return packed.groupBy("home").cogroup(far.groupBy("home")).applyInArrow(run, schema)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; an empty table gives no rows."""
    return without_repeats(read_table(spark, sf_dir, "documents"), ["doc_id"], digest=True)
