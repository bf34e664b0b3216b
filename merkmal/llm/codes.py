"""Vector code compression: product quantisation of integer vectors, nearest entries found by slice-and-intersect bitmasks.

Each part of a vector is assigned to the nearest entry of its part's codebook. The nearest entry is searched
without comparing a part with every entry: per dimension the entries are sorted by their coordinate and each
sorted place carries the bitmask of all entries before it (uint64 words). A radius ``r`` turns every dimension
into a range of sorted places, found by binary search, and the difference of two prefix masks is the set of
entries inside that slice; ANDing the slices of all dimensions leaves the entries inside the cube of half-width
``r``. The first non-empty cube gives a distance ``d``; a second cube of half-width ``isqrt(d)`` holds every entry
at least as near (coordinates are integers), so comparing only those gives the exact nearest entry.

Lloyd rounds are Spark jobs over a checkpointed table of integer vectors: tasks assign their rows and emit sums
per (part, entry, position); an aggregate adds them, and the driver, which only ever holds the codebooks
(parts x entries x part length numbers), computes the new entries with exact integer floors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merkmal.llm.common import read_table
from merkmal.session import cut_lineage

# Fixed values of the contract.
PARTS = 4
ENTRIES = 256
ROUNDS = 4
STEP = 1024

#: first half-width of the search cube, in integer units; it doubles for parts whose cube is empty
START_RADIUS = 64
BATCH_ROWS = 4096


def usable(vector: Column) -> Column:
    """A vector that is not null and has no null, NaN or infinite component (an empty vector is usable)."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    )


def integer_rows(vectors: DataFrame, dims: int) -> DataFrame:
    """``vec_id, label, ints``: floor(STEP * x) of every component, padded with zeros or cut to ``dims``."""
    at = F.sequence(F.lit(0), F.lit(dims - 1)) if dims else F.array().cast("array<int>")
    ints = F.transform(at, lambda i: F.coalesce(F.floor(F.get(F.col("embedding"), i).cast("double") * STEP), F.lit(0)).cast("long"))
    return vectors.select("vec_id", "label", ints.alias("ints"))


class Codebooks:
    """Entries of every part position with their sorted coordinates and prefix masks."""

    def __init__(self, books: np.ndarray):
        self.books = books  # parts x entries x width, int64
        parts, entries, width = books.shape
        self.words = (entries + 63) // 64
        self.order, self.sorted, self.prefix = [], [], []
        for p in range(parts):
            order = np.argsort(books[p], axis=0, kind="stable")  # entries x width
            self.order.append(order)
            self.sorted.append(np.take_along_axis(books[p], order, axis=0))
            bits = np.zeros((width, entries + 1, self.words), np.uint64)
            for j in range(width):
                step = np.zeros((entries, self.words), np.uint64)
                step[np.arange(entries), order[:, j] // 64] = np.uint64(1) << (order[:, j] % 64).astype(np.uint64)
                bits[j, 1:] = np.bitwise_or.accumulate(step, axis=0)
            self.prefix.append(bits)

    def inside(self, part: int, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries with every coordinate within ``radius`` of the row's."""
        found = np.full((len(x), self.words), np.uint64(0xFFFFFFFFFFFFFFFF))
        width = x.shape[1]
        for j in range(width):
            column = self.sorted[part][:, j]
            low = np.searchsorted(column, x[:, j] - radius, "left")
            high = np.searchsorted(column, x[:, j] + radius, "right")
            found &= self.prefix[part][j, high] & ~self.prefix[part][j, low]
        return found

    def _best(self, part: int, x: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry (ties to the lower index) and its distance among each row's masked entries; -1 if none."""
        entries = self.books.shape[1]
        flags = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :entries].astype(bool)
        rows, cols = np.nonzero(flags)
        best = np.full(len(x), -1, np.int64)
        dist = np.full(len(x), -1, np.int64)
        if len(rows):
            diff = x[rows] - self.books[part][cols]
            key = np.einsum("ij,ij->i", diff, diff) * entries + cols
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            low = np.minimum.reduceat(key, starts)
            best[rows[starts]] = low % entries
            dist[rows[starts]] = low // entries
        return best, dist

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact nearest entry of every row of ``x`` and the squared distance to it."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        radius = np.full(len(x), START_RADIUS, np.int64)
        best, dist = self._best(part, x, self.inside(part, x, radius))
        while (best < 0).any():
            open_ = best < 0
            radius[open_] *= 2
            b, d = self._best(part, x[open_], self.inside(part, x[open_], radius[open_]))
            best[open_], dist[open_] = b, d
        exact = np.array([int(np.sqrt(v)) for v in dist.tolist()], np.int64)
        exact += (exact + 1) ** 2 <= dist
        exact -= exact**2 > dist
        return self._best(part, x, self.inside(part, x, exact))


def _parts(ints: pa.ListArray, width: int) -> np.ndarray:
    values = ints.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(ints), PARTS, width)


def assigned_sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, entry, position, total, n``: sums of the parts assigned to each entry (one line per task and key)."""
    width = books.shape[2]
    entries = books.shape[1]

    def step(batches):
        book = Codebooks(books)
        totals = np.zeros((PARTS, entries, width), np.int64)
        counts = np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                chunk = batch.slice(start, BATCH_ROWS)
                x = _parts(chunk.column("ints"), width)
                for p in range(PARTS):
                    best, _ = book.nearest(p, x[:, p])
                    np.add.at(totals[p], best, x[:, p])
                    counts[p] += np.bincount(best, minlength=entries)
        used = np.nonzero(counts)
        if not len(used[0]):
            return
        p_, e_ = np.repeat(used[0], width), np.repeat(used[1], width)
        pos = np.tile(np.arange(width), len(used[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p_, pa.int32()), pa.array(e_, pa.int32()), pa.array(pos, pa.int32()),
             pa.array(totals[p_, e_, pos]), pa.array(counts[p_, e_])],
            names=["part", "entry", "position", "total", "n"],
        )

    out = "part int, entry int, position int, total long, n long"
    return rows.select("ints").mapInArrow(step, out).groupBy("part", "entry", "position").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def refined(rows: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` Lloyd rounds; each entry becomes floor(sum / count) of its parts, unused ones stay."""
    for _ in range(rounds):
        books = books.copy()
        for line in assigned_sums(rows, books).collect():  # at most parts x entries x width lines
            books[line["part"], line["entry"], line["position"]] = line["total"] // line["n"]  # Python floors down
    return books


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: final entries in part order as two hex digits each, squared distances summed."""
    width = books.shape[2]

    def final(batches):
        book = Codebooks(books)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                chunk = batch.slice(start, BATCH_ROWS)
                x = _parts(chunk.column("ints"), width)
                codes, error = [], np.zeros(chunk.num_rows, np.int64)
                for p in range(PARTS):
                    best, dist = book.nearest(p, x[:, p])
                    codes.append(best)
                    error += dist
                text = ["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for c in codes))]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("vec_id"), chunk.column("label"), pa.array(text, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    return rows.mapInArrow(final, "vec_id long, label int, code string, error long")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integer components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(v) for v in books.reshape(-1).tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector of ``vectors (vec_id, embedding, label)``.

    Rows whose vector is null or holds a null, NaN or infinite component are dropped; other columns are not read.
    The dimension is that of the first starting row (smallest vec_id, nulls last; equal ids by vector); shorter
    vectors are padded with zeros, longer ones cut, and a dimension not divisible by 4 is padded to the next
    multiple. Fewer than ``entries`` rows give as many entries. Null and repeated vec_ids are coded like any row;
    null labels form one group of ``label_error``. An empty table (or one without usable rows) gives no rows.
    """
    spark = vectors.sparkSession
    good = vectors.filter(usable(F.col("embedding"))).select("vec_id", "embedding", F.col("label").cast("int").alias("label"))
    first = good.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding").alias("d")).first()
    schema = "vec_id long, label int, code string, error long, label_error long, codebooks_sha256 string"
    if first is None:
        return spark.createDataFrame([], schema)
    dims = -(-first["d"] // PARTS) * PARTS
    width = dims // PARTS
    rows = cut_lineage(integer_rows(good, dims))
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()  # the fixed start
    books = np.array([r["ints"] for r in start], np.int64).reshape(len(start), PARTS, width).transpose(1, 0, 2).copy()
    books = refined(rows, books, rounds)
    codes = coded(rows, books)
    per_label = codes.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(per_label, F.col("label").eqNullSafe(F.col("same_label"))).select(
        "vec_id", "label", "code", "error", "label_error"
    )
    return joined.withColumn("codebooks_sha256", F.lit(books_digest(books)))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every usable row of ``embeddings``: 4 parts, 256 entries, 4 rounds."""
    return compress(read_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256", "label"
    )


def op12_sql(rounds: int = ROUNDS, entries: int = ENTRIES) -> str:
    """DuckDB SQL of ``op12_codes`` for vectors whose length is a multiple of 4; each Lloyd round is one block."""
    blocks = [
        """good AS (
  SELECT vec_id, CAST(label AS INTEGER) AS label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) AS rid, len(ints) // 4 AS width FROM good),
vals AS (
  SELECT rid, i // width AS part, i % width AS pos, v
  FROM (SELECT rid, width, unnest(range(len(ints))) AS i, unnest(ints) AS v FROM numbered)),""",
        f"c0 AS (SELECT part, rid - 1 AS entry, pos, v AS c FROM vals WHERE rid <= {entries}),",
    ]
    for r in range(rounds + 1):
        blocks.append(
            f"""d{r} AS (
  SELECT v.rid, v.part, c.entry, sum((v.v - c.c) * (v.v - c.c)) AS d
  FROM vals v JOIN c{r} c ON v.part = c.part AND v.pos = c.pos GROUP BY ALL),
a{r} AS (SELECT rid, part, min(d * 256 + entry) % 256 AS entry, min(d * 256 + entry) // 256 AS d FROM d{r} GROUP BY ALL),"""
        )
        if r < rounds:
            blocks.append(
                f"""s{r} AS (
  SELECT a.part, a.entry, v.pos, sum(v.v) AS s, count(*) AS n
  FROM a{r} a JOIN vals v ON v.rid = a.rid AND v.part = a.part GROUP BY ALL),
c{r + 1} AS (
  SELECT c.part, c.entry, c.pos,
         coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, c.c) AS c
  FROM c{r} c LEFT JOIN s{r} s ON s.part = c.part AND s.entry = c.entry AND s.pos = c.pos),"""
            )
    blocks.append(
        f"""digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM c{rounds}),
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error FROM a{rounds} GROUP BY rid)"""
    )
    return (
        "WITH "
        + "\n".join(blocks)
        + """
SELECT n.vec_id, n.label, k.code, CAST(k.error AS BIGINT) AS error,
       CAST(sum(k.error) OVER (PARTITION BY n.label) AS BIGINT) AS label_error, d.h AS codebooks_sha256
FROM numbered n JOIN coded k USING (rid) CROSS JOIN digest d
"""
    )


OP12_SQL = op12_sql()
