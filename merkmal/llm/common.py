"""Words, row keys, range widths and links shared by the operators of this package."""

from __future__ import annotations

import ctypes
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from merkmal.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITE_SPACE = r"[\x20\x09-\x0D]+"

#: bytes -> lower-cased bytes with everything but a-z, 0-9 and non-ASCII bytes turned into a space
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters; null has none."""
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM)


def split_words(text: Column, gaps: str) -> Column:
    """Words between ``gaps``. Splitting is linear in the text; extracting all matches is not."""
    return F.array_remove(F.split(text, gaps), "")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_LEAN = False


def lean_memory() -> None:
    """Have freed arrays returned to the system at once; worker processes live on and serve later stages.

    Blocks of 1 MB and more are mapped on their own (mallopt's M_MMAP_THRESHOLD, -3), and Arrow takes its
    memory from there as well.
    """
    global _LEAN
    if not _LEAN:
        _LEAN = True
        try:
            ctypes.CDLL(None).mallopt(-3, 1 << 20)
        except AttributeError:  # another C library
            return
        pa.set_memory_pool(pa.system_memory_pool())


def small_batches(batches, rows: int = 500):
    """Record batches of at most ``rows`` rows, so that few texts are Python objects at a time."""
    lean_memory()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class WordHashes(dict):
    """64-bit hash of a word; at most ``limit`` are remembered, so memory is bounded."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self[w] for w in words), dtype=np.uint64, count=len(words))


_SPREAD = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))
_WORD_SPREAD = _SPREAD.copy()
_WORD_SPREAD[[9, 10, 11, 12, 13, 32]] = 0
_CHUNK = 1 << 20


def text_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of all texts end to end, and the number of words of each.

    A word's hash is a sum over its bytes of a random value per byte value times a power per place, mixed. Chunks of
    texts are hashed at once without making an object per word.
    """
    hashes, sizes, held, size = [], [], [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text) + 1
        if size >= _CHUNK or i == len(texts) - 1:
            h, n = _chunk_hashes(held)
            hashes.append(h)
            sizes.append(n)
            held, size = [], 0
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(sizes)


def _chunk_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    inside = (data != 32) & (data - np.uint8(9) > 4)  # 9 to 13 are white space too
    first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) + 1
    sizes = np.diff(np.searchsorted(first, ends), prepend=0)
    if not len(first):
        return np.empty(0, np.uint64), sizes
    data, start = data[first[0] :], first - first[0]
    at = np.arange(len(data)) - np.repeat(start, np.diff(start, append=len(data)))
    at &= 0xFFFF
    spread = _WORD_SPREAD.take(data)  # white space after a word adds nothing
    spread *= _POWERS.take(at)
    return mixed(np.add.reduceat(spread, start)), sizes


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit value spread over the whole value (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending, as ``np.unique`` gives them; on small arrays several times as fast."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def rolling(words: np.ndarray, k: int, multiplier: np.uint64 = _MULTIPLIER) -> np.ndarray:
    """Hash of each ``k`` consecutive word hashes; empty if there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * multiplier + words[j : j + n]
    return mixed(out)


def lowest_by_hash(df: DataFrame, keys: list[str], rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows of a table of ``total``, those with the lowest hash of ``keys``.

    Hashes are even, so a bound on them leaves little more than ``rows`` rows in all; without
    it the last task would merge ``rows`` rows of every partition. Rows with equal keys pass together.
    """
    mark = F.xxhash64(*keys)
    share = (rows + 8 * math.sqrt(rows) + 16) / max(total, 1)
    if share < 1:
        df = df.filter(mark <= F.lit(int(share * 2**64) - 2**63))
    return df.orderBy(mark, keys[0]).limit(rows)


def in_cells(df: DataFrame, cell: str, order: list[Column], offsets: DataFrame, position: str) -> DataFrame:
    """Gapless position of a row: the offset of its cell plus its rank inside the cell.

    ``offsets`` has ``cell`` and ``offset`` and a fixed number of rows, so it can
    be broadcast. Ranks run inside cells only, so no task sorts a whole group.
    """
    rank = F.row_number().over(Window.partitionBy(cell).orderBy(*order))
    return (
        df.withColumn("_rank", rank)
        .join(F.broadcast(offsets), cell)
        .withColumn(position, (F.col("offset") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "offset")
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every end of ``edges (a, b)``: the smallest id reachable.

    Alternating large and small stars: each round points the larger neighbours
    of a node, then its smaller ones and itself, at the smallest neighbour, until
    nothing changes. Neighbour lists are never gathered; a round is aggregates
    and equi-joins, which adaptive execution splits at hot nodes. Each round is
    a checkpoint, so neither lineage nor plans grow.
    """
    a, b = F.col("a"), F.col("b")

    def down(df: DataFrame) -> DataFrame:
        return df.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()

    def mark(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    current = cut_lineage(down(edges))
    before = mark(current)
    for _ in range(max_rounds):
        both = current.union(current.select(b.alias("a"), a.alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.filter(b > a).join(lowest, "a").select(b.alias("a"), F.col("low").alias("b"))
        large = down(large)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(b.alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        current = cut_lineage(down(small))
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return current.select(a.alias("id"), b.alias("component")).union(roots).distinct()
