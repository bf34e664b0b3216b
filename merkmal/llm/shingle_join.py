"""Jaccard join of word shingles by partitioning the universe (pigeonhole) with one-deletion neighbourhoods.

Two sets link when ``100 * |A & B| >= 75 * |A | B|``. Then they differ in at most
``H = (|A| + |B|) // 7`` elements. The elements are hashed into segments, their number set
by the size band of the smaller set. If the smaller set gives its segments thresholds e with
``sum(e + 1) > H``, some segment differs in at most e elements. A threshold of 0 costs one
lookup, of 1 also its one-deletion neighbourhood; empty segments get none. Which
segments a set uses is chosen by cost: the number of sets that hold the same segment.
Segments nobody else holds cost nothing, so a set with more than H of them has no partner.
What shares a chosen segment is compared in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from merkmal.llm.common import components, distinct, lean_memory, mixed, read_table, rolling, small_batches, text_hashes
from merkmal.llm.packed import from_planes, group_bits, packed_by_home, packed_sorted, planes, unpacked_sorted, unpacked_table
from merkmal.session import cut_lineage

SHINGLE = 5
PERCENT = 75
SMALL, SMALL_BITS, BAND_BITS = 48, 5, 7
FILTER_BITS = 23
SEEDS = 6
SKETCH = 8
#: smallest entries of a set by which a pair knows that it meets at an earlier entry too
FIRST = 12

_INT, _BIN, _LONG = pa.int32(), pa.binary(), pa.int64()


def shingle_sets(texts: list[bytes | None], chunk: int = 1 << 20) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending; fewer words than a shingle are one shingle, no words none.

    About ``chunk`` bytes are hashed at a time, so memory follows the result and the longest text.
    """
    out, held, size = [], [], 0
    for i, text in enumerate(texts):
        held.append(text.lower() if text else b"")
        size += len(held[-1])
        if size >= chunk or i == len(texts) - 1:
            out += _shingle_sets(held)
            held, size = [], 0
    return out


def _shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    hashes, sizes = text_hashes(texts)
    grams = rolling(hashes, SHINGLE)
    out, start = [], 0
    for n in sizes:
        if n >= SHINGLE:
            out.append(distinct(grams[start : start + n - SHINGLE + 1]))
        elif n:
            out.append(rolling(hashes[start : start + n], int(n)) ^ np.uint64(n))
        else:
            out.append(np.empty(0, np.uint64))
        start += n
    return out


def band(n: int) -> int:
    """Size band: 0 below ``SMALL``, then four times as wide each."""
    b = 0
    while n >= SMALL * 4 ** b:
        b += 1
    return b


def band_floor(b: int) -> int:
    return 0 if b == 0 else SMALL * 4 ** (b - 1)


def most_difference(n: int) -> int:
    """H for a set of n elements and a partner that is not smaller."""
    return (n + n * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT)


class Entries:
    """Index entries of many sets in flat arrays, ordered by set.

    A set has an entry per non-empty segment (WHOLE) in its own band and, if a
    partner can be there, in the band below. Sets of band 0 also have one per
    segment and element left out of it (LACKING) and one per element (SINGLE).
    """

    WHOLE, LACKING, SINGLE = 0, 1, 2

    def __init__(self, sets: list[np.ndarray], seed: int):
        self.sizes = np.array([len(x) for x in sets], dtype=np.int64)
        self.bands = np.array([band(n) for n in self.sizes], dtype=np.int64)
        floors = np.array([band_floor(b) for b in self.bands], dtype=np.int64)
        doc = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        below = (self.bands > 0) & (-(-self.sizes * PERCENT // 100) < floors)
        parts = [self._of(doc, tokens, self.bands, seed, True), self._of(doc[below[doc]], tokens[below[doc]], self.bands - 1, seed, False)]
        self.doc, self.kind, self.own, self.segment, self.value = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.argsort(self.doc, kind="stable")
        self.doc, self.kind, self.own, self.segment, self.value = (x[order] for x in (self.doc, self.kind, self.own, self.segment, self.value))
        self.starts = np.searchsorted(self.doc, np.arange(len(sets) + 1))

    @staticmethod
    def _of(doc, tokens, bands, seed: int, own: bool):
        if not len(doc):
            empty = np.empty(0, np.int64)
            return empty.astype(np.int32), empty.astype(np.int8), empty.astype(bool), empty.astype(np.int32), np.empty(0, np.uint64)
        b = bands[doc]
        bits = np.where(b == 0, SMALL_BITS, BAND_BITS + 2 * (b - 1)).astype(np.uint64)
        at = mixed(tokens + np.uint64(0x51ED27 * (seed + 1))) >> (np.uint64(64) - bits)
        order = np.argsort((doc.astype(np.uint64) << np.uint64(32)) | at, kind="stable")
        doc, at, b, spread = doc[order], at[order], b[order], mixed(tokens[order] ^ np.uint64(0xA5A5A5A5))
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
        size = np.diff(first, append=len(at))
        whole = np.add.reduceat(spread, first) + mixed(at[first] + ((b[first].astype(np.uint64) + np.uint64(1)) << np.uint64(40)) + np.uint64(seed << 50))
        segment = np.repeat(np.arange(len(first)), size)
        wide = (b == 0) & (size[segment] > 1)
        small = b == 0
        docs = np.concatenate([doc[first], doc[wide], doc[small]])
        kinds = np.repeat([Entries.WHOLE, Entries.LACKING, Entries.SINGLE], [len(first), wide.sum(), small.sum()])
        segments = np.concatenate([np.arange(len(first)), segment[wide], segment[small]])
        values = np.concatenate([mixed(whole), mixed(whole[segment[wide]] - spread[wide]), mixed(spread[small] + np.uint64(0x77777777))])
        return docs.astype(np.int32), kinds.astype(np.int8), np.full(len(docs), own), segments.astype(np.int32), values


def allocation(kind: np.ndarray, segment: np.ndarray, value: np.ndarray, cost: np.ndarray, n: int) -> np.ndarray | None:
    """Entries of one set (in its own band) to look up: the cheapest that fill ``H + 1`` units.

    ``cost`` is the number of sets per entry; entries of cost 1 fill a unit
    without a lookup. Empty if no partner is possible. Small sets that run short of segments
    take one-deletion neighbourhoods, then single elements; None if units are short even so.
    """
    units = most_difference(n) + 1
    whole = np.flatnonzero(kind == Entries.WHOLE)
    need = units - int((cost[whole] <= 1).sum())
    if need <= 0:
        return value[:0]
    shared = whole[cost[whole] > 1]
    shared = shared[np.argsort(cost[shared], kind="stable")]
    chosen = [value[shared[:need]]]
    need -= len(shared[:need])
    lacking = np.flatnonzero(kind == Entries.LACKING)
    if need > 0 and len(lacking):
        wide, place = np.unique(segment[lacking], return_inverse=True)
        wide = wide[np.argsort(np.bincount(place, weights=cost[lacking]), kind="stable")][:need]
        chosen += [value[lacking[np.isin(segment[lacking], wide)]], value[whole[np.isin(segment[whole], wide)]]]
        need -= len(wide)
    if need > 0:
        single = np.flatnonzero(kind == Entries.SINGLE)
        if not len(single):
            return None
        chosen = [value[single[np.argsort(cost[single], kind="stable")][:units]]]
    return distinct(np.concatenate(chosen))


def parity_sketch(tokens: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """``words * 64`` bits, each the parity of the elements hashed to it.

    Every bit in which two sketches differ comes from another element that only one of the sets has, so the
    number of such bits never exceeds the difference of the sets.
    """
    at = (mixed(tokens ^ np.uint64(0x5EED)) % np.uint64(words * 64)).astype(np.int64)
    odd = np.bincount(at, minlength=words * 64).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def set_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and a 128-bit hash of the set of every row."""

    def run(batches):
        for batch in small_batches(batches):
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
            one = [int(mixed(s).sum(dtype=np.uint64)) - (1 << 63) for s in sets]
            two = [int(mixed(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64)) - (1 << 63) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], _LONG), pa.array(one, _LONG), pa.array(two, _LONG)],
                names=["doc_id", "n_shingles", "s1", "s2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long")


def _home_sets(payloads: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and sets of a home, one of each group of equal sets (the smallest id), rows without id or words left out."""
    table = unpacked_table(payloads.column("payload").to_pylist())
    ids, seen = table.column("doc_id").to_pylist(), {}
    for i, tokens in zip(ids, shingle_sets(table.column("text").cast(pa.binary()).to_pylist())):
        if i is not None and len(tokens):
            key = (len(tokens), int(tokens[0]), int(mixed(tokens).sum(dtype=np.uint64)))
            if key not in seen or i < seen[key][0]:
                seen[key] = (i, tokens)
    kept = sorted(seen.values(), key=lambda x: x[0])
    return np.array([k[0] for k in kept], dtype=np.int64), [k[1] for k in kept]


def index_counts(packed: DataFrame, bits: int, seed: int) -> DataFrame:
    """Per home and bucket: the entries of the home and how many of its sets hold each."""

    def run(key, table):
        lean_memory()
        _, sets = _home_sets(table)
        values, counts = np.unique(Entries(sets, seed).value, return_counts=True)
        buckets, starts = np.unique((values >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
        ends = np.append(starts[1:], len(values)).astype(np.int64)
        short = ((values >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({
            "home": pa.array([key[0].as_py()] * len(buckets), _INT), "bucket": pa.array(buckets, _INT),
            "held": pa.array([packed_sorted(short[a:b]) for a, b in zip(starts, ends)], _BIN),
            "counts": pa.array([planes(counts[a:b].astype(np.uint32)) for a, b in zip(starts, ends)], _BIN)})

    return packed.groupBy("home").applyInArrow(run, "home int, bucket int, held binary, counts binary")


def shared_counts(counted: DataFrame) -> DataFrame:
    """Per bucket and home: entries of the home that other homes hold too, with their counts over all homes."""

    def run(key, table):
        lean_memory()
        held = [unpacked_sorted(x, np.uint32) for x in table.column("held").to_pylist()]
        counts = [from_planes(x, np.uint32) for x in table.column("counts").to_pylist()]
        values, place, homes = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        total = np.bincount(place, weights=np.concatenate(counts)).astype(np.uint32)
        rows, start = [], 0
        for home, own in zip(table.column("home").to_pylist(), held):
            at = place[start : start + len(own)]
            start += len(own)
            shared = homes[at] > 1
            if shared.any():
                rows.append((home, packed_sorted(own[shared]), planes(total[at[shared]])))
        return pa.table({
            "home": pa.array([r[0] for r in rows], _INT), "bucket": pa.array([key[0].as_py()] * len(rows), _INT),
            "held": pa.array([r[1] for r in rows], _BIN), "counts": pa.array([r[2] for r in rows], _BIN)})

    return counted.groupBy("bucket").applyInArrow(run, "home int, bucket int, held binary, counts binary")


def allocated(packed: DataFrame, shared: DataFrame, bits: int, seed: int) -> DataFrame:
    """Per set that shares entries: those it looks up (chosen), those that others hold (held), and whether units were short.

    ``common`` is the share of its own segments that others hold.
    """

    def run(key, left, right):
        lean_memory()
        ids, sets = _home_sets(left)
        own = Entries(sets, seed)
        values, place, counts = np.unique(own.value, return_inverse=True, return_counts=True)
        short = values >> np.uint64(32 - bits)
        for bucket, held, total in zip(*(right.column(c).to_pylist() for c in ("bucket", "held", "counts"))):
            known = (np.uint64(bucket) << np.uint64(32)) | unpacked_sorted(held, np.uint32).astype(np.uint64)
            low, high = np.searchsorted(short, known, "left"), np.searchsorted(short, known, "right")
            totals = from_planes(total, np.uint32)
            for step in range(int((high - low).max(initial=0))):
                there = low + step < high
                counts[(low + step)[there]] = totals[there]
        cost = counts[place]
        base = own.own & (own.kind == Entries.WHOLE)
        segments = np.bincount(own.doc[base], minlength=len(sets))
        free = np.bincount(own.doc[base & (cost == 1)], minlength=len(sets))
        some = np.bincount(own.doc[cost > 1], minlength=len(sets)) > 0
        out: dict[str, list] = {"doc": [], "n": [], "band": [], "common": [], "chosen": [], "held": [], "failed": [], "sketch": []}
        for i in np.flatnonzero(some | (free < [most_difference(int(n)) + 1 for n in own.sizes])):
            part = slice(own.starts[i], own.starts[i + 1])
            mine = own.own[part]
            chosen = allocation(own.kind[part][mine], own.segment[part][mine], own.value[part][mine], cost[part][mine], int(own.sizes[i]))
            held = distinct(own.value[part][cost[part] > 1])
            if chosen is None or len(held):
                out["doc"].append(int(ids[i]))
                out["n"].append(int(own.sizes[i]))
                out["band"].append(int(own.bands[i]))
                out["common"].append(1.0 - free[i] / max(1, segments[i]))
                out["chosen"].append([] if chosen is None else np.intersect1d(chosen, held, assume_unique=True).view(np.int64))
                out["held"].append(held.view(np.int64))
                out["failed"].append(chosen is None)
                out["sketch"].append(parity_sketch(sets[i]))
        types = {"doc": _LONG, "n": _LONG, "band": _INT, "common": pa.float64(), "chosen": pa.list_(_LONG), "held": pa.list_(_LONG), "failed": pa.bool_(), "sketch": pa.list_(_LONG)}
        return pa.table({k: pa.array(v, types[k]) for k, v in out.items()})

    return packed.groupBy("home").cogroup(shared.groupBy("home")).applyInArrow(
        run, "doc long, n long, band int, common double, chosen array<long>, held array<long>, failed boolean, sketch array<long>")


def needed_filter(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of fixed size (1 MB) over hashed ids; it spares reading out sets that no pair asks for. The join is exact."""
    slot = F.pmod(F.xxhash64("doc"), F.lit(1 << bits))
    lines = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("b"))
    table = np.zeros(1 << (bits - 6), np.int64)
    for row in lines.toArrow().to_pylist():  # at most 2**(bits - 6) lines
        table[row["w"]] = row["b"]
    return table.view(np.uint64)


def sets_of(docs: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``(doc, tokens)``: packed sets of the documents in ``ids``."""
    handle = docs.sparkSession.sparkContext.broadcast(needed_filter(ids, bits))

    def run(batches):
        table = handle.value
        for batch in small_batches(batches):
            slots = batch.column("slot").to_numpy()
            keep = np.flatnonzero((table[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1))
            part = batch.take(pa.array(keep))
            sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array([packed_sorted(s) for s in sets], _BIN)], names=["doc", "tokens"])

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("doc"), F.lit(1 << bits)))
    return rows.mapInArrow(run, "doc long, tokens binary").join(ids, "doc", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link, by exact counts. Equi-joins, so a set that many pairs ask for can be split."""
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in small_batches(batches):
            keep, last, y = [], None, None
            for i in range(batch.num_rows):
                x = unpacked_sorted(batch.column("x")[i].as_py(), np.uint64)
                raw = batch.column("y")[i].as_py()
                if raw != last:
                    last, y = raw, unpacked_sorted(raw, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and 100 * common >= PERCENT * (len(x) + len(y) - common):
                    keep.append(i)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def telling(placed: DataFrame) -> DataFrame:
    """Rows of the entries whose holders lie in several components; of entries with the same holders and choosers only the smallest.

    Near copies share most of their entries, and every entry that all of them hold would bring the same pairs again.
    Holders are compared by their number and two sums of 64-bit hashes; a holder is its id with size and openness, as
    rows with equal ids may have several sets (sketches meet every set of an id).
    """
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "doc", "n", "open", "chose").cast("decimal(20,0)"))
    held = placed.groupBy("entry").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"), mark(1).alias("m1"), mark(2).alias("m2"), F.max("chose").alias("chosen"))
    kept = held.filter("low < high and chosen").groupBy("n", "m1", "m2").agg(F.min("entry").alias("entry")).select("entry")
    return placed.join(kept, "entry", "left_semi")


def with_first_entries(open_: DataFrame) -> DataFrame:
    """Rows with the smallest entries that their set chose (mine) and holds (theirs)."""
    one_set = ["doc", "n", "open"]  # rows with equal ids may have several sets
    mine = F.slice(F.array_sort(F.collect_list(F.when(F.col("chose"), F.col("entry")))), 1, FIRST)
    theirs = F.slice(F.array_sort(F.collect_list("entry")), 1, 2 * FIRST)
    return open_.join(open_.groupBy(*one_set).agg(mine.alias("mine"), theirs.alias("theirs")), one_set)


def meeting(open_: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of holders of an entry that may link, tested inside the join.

    Near copies share many entries; a pair is left out where it meets at a smaller entry among the first ones of both
    sets. The smallest entry at which it meets always makes it.
    """
    one, two = open_.filter("chose").drop("theirs").alias("one"), open_.drop("mine").alias("two")
    apart = sum((F.bit_count(F.col(f"one.k{i}").bitwiseXOR(F.col(f"two.k{i}"))) for i in range(SKETCH)), F.lit(0))
    unlike = (
        (F.col("one.entry") == F.col("two.entry")) & (F.col("one.part") != F.col("two.part")) & (F.col("two.n") >= F.col("one.n"))
        & (F.col("two.n") * PERCENT <= F.col("one.n") * 100) & (F.col("two.open") | (F.col("two.band") != F.col("one.band")))
        & (apart * (100 + PERCENT) <= (F.col("one.n") + F.col("two.n")) * (100 - PERCENT))
        & ~F.exists("one.mine", lambda e: (e < F.col("one.entry")) & F.array_contains("two.theirs", e))
    )
    return one.join(two, unlike).select(F.col("one.doc").alias("a"), F.col("two.doc").alias("b"))


def linked_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, s1, s2 and component_id of every row.

    Rows with equal sets are one class, kept by its smallest doc_id. Sets that
    share a chosen entry are first compared with one of its holders, that of
    which most segments are held by others: the original of near copies. Then
    all pairs of holders are compared that are still in different components,
    agree in size and in their parity sketches, and of which the smaller chose the entry and the larger may
    have partners; all this is tested inside the join, which makes a pair at few of the entries that it
    shares. So no link between classes is missed, while a large group of near copies costs one comparison each.
    Rows without words link with nothing; rows without doc_id take part only
    through equal sets. Rows with equal ids are one node.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = cut_lineage(set_classes(rows))
    reps = base.filter("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep"))

    bits = group_bits(rows)
    packed = packed_by_home(rows, bits)
    for seed in range(SEEDS):
        shared = shared_counts(index_counts(packed, bits, seed))
        found = cut_lineage(allocated(packed, shared, bits, seed))
        if found.filter("failed").isEmpty():
            break
    else:
        raise RuntimeError("no hash seed gave every set enough segments")

    found = found.join(reps.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")  # equal sets of other homes
    looked = found.select(F.explode("chosen").alias("entry")).distinct()
    holders = found.select("doc", "n", "band", "common", "chosen", F.explode("held").alias("entry")).select(
        "entry", "doc", "n", "band", "common", F.array_contains("chosen", F.col("entry")).alias("chose"), (F.size("chosen") > 0).alias("open"))
    holders = holders.join(looked, "entry", "left_semi")
    hubs = holders.groupBy("entry").agg(
        F.max_by(F.struct("doc", "n"), F.struct("common", -F.col("doc"))).alias("hub"), F.count("*").alias("n_holders")
    ).filter("n_holders > 1").select("entry", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("hub_n"))
    members = cut_lineage(holders.join(hubs, "entry"))
    alike = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * PERCENT
    first = members.filter((F.col("doc") != F.col("hub")) & alike).select(F.greatest("doc", "hub").alias("a"), F.least("doc", "hub").alias("b"))
    first = cut_lineage(first.distinct())
    ids = cut_lineage(members.select("doc").distinct())
    sets = cut_lineage(sets_of(rows, ids))
    links = cut_lineage(verified(first, sets))
    parts = components(links)

    part = F.coalesce("component", "doc")
    placed = members.drop("hub", "hub_n").join(parts.withColumnRenamed("id", "doc"), "doc", "left").withColumn("part", part).drop("component")
    open_ = cut_lineage(telling(placed))
    bits_of = found.select("doc", *[F.get("sketch", F.lit(i)).alias(f"k{i}") for i in range(SKETCH)])
    open_ = cut_lineage(with_first_entries(open_).join(bits_of, "doc"))
    rest = meeting(open_).select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
    rest = cut_lineage(rest.select("a", "b").join(first, ["a", "b"], "left_anti"))
    parts = components(links.union(verified(rest, sets))).select(F.col("id").alias("rep"), "component")

    classes = reps.join(parts, "rep", "left").select(
        F.col("n_shingles").alias("n"), F.col("s1").alias("k1"), F.col("s2").alias("k2"), F.coalesce("component", "rep").alias("class_component"))
    same = (F.col("n_shingles") == F.col("n")) & (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2"))
    return base.join(classes, same, "left").select(
        "doc_id", "n_shingles", "s1", "s2", F.coalesce("class_component", "doc_id").alias("component_id"))


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return linked_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
