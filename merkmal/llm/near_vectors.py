"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merkmal.llm.common import components, lowest_by_hash, read_table
from merkmal.operators.scale import global_rank
from merkmal.session import cut_lineage

THRESHOLD = 0.9
BASIS_ROWS = 4096
GRID_DIMS = 8
BLOCK = 2048
LEAF = 256
FAN = 8
SLACK = 1e-4


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(values: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, padded with zeros to equal length, and their lengths.

    Each is scaled by its largest component first, so neither squares overflow nor vanish.
    """
    sizes = np.array([len(v) for v in values], dtype=np.int32)
    out = np.zeros((len(values), int(sizes.max(initial=0))))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True), sizes


def principal_basis(vectors: DataFrame, rows: int = BASIS_ROWS) -> np.ndarray:
    """Orthonormal principal directions, largest variance first, from at most ``rows`` vectors by hash order.

    Only the order of the grid depends on the sample; any orthonormal basis gives the same links.
    """
    sample = lowest_by_hash(vectors, ["vec_id", "embedding"], rows, vectors.count())
    sample = sample.select("embedding").toArrow().column("embedding").to_pylist()
    if not sample:
        return np.eye(1)
    unit, _ = unit_rows(sample)
    _, directions = np.linalg.eigh(np.cov(unit.T).reshape(unit.shape[1], unit.shape[1]) if len(unit) > 1 else np.eye(unit.shape[1]))
    return directions[:, ::-1]


def _turned(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Principal coordinates; components beyond the basis are left as they are."""
    d = basis.shape[0]
    if unit.shape[1] < d:
        unit = np.pad(unit, ((0, 0), (0, d - unit.shape[1])))
    return np.hstack([unit[:, :d] @ basis, unit[:, d:]])


def in_grid_order(vectors: DataFrame, basis: np.ndarray, eps: float) -> DataFrame:
    """Vectors with ``uid``, their rank in the order of grid cells of width ``eps``, from 1."""
    cells = [f"g{i}" for i in range(GRID_DIMS)]

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, _ = unit_rows(batch.column("embedding").to_pylist())
            turned = _turned(unit, basis)
            turned = np.pad(turned, ((0, 0), (0, max(0, GRID_DIMS - turned.shape[1]))))
            grid = np.floor(turned[:, :GRID_DIMS] / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), *(pa.array(grid[:, i]) for i in range(GRID_DIMS))],
                                             names=["vec_id", "embedding", *cells])

    element = vectors.schema["embedding"].dataType.simpleString()
    kind = vectors.schema["vec_id"].dataType.simpleString()
    placed = vectors.mapInArrow(place, f"vec_id {kind}, embedding {element}, " + ", ".join(f"{c} int" for c in cells))
    return global_rank(placed, [*cells, "vec_id"], "uid").select("uid", "vec_id", "embedding")


def packed_blocks(ordered: DataFrame, basis: np.ndarray, size: int = BLOCK) -> DataFrame:
    """Sequence intervals of ``size`` vectors: packed components and the box of their principal coordinates."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        values = table.column("embedding").to_pylist()
        unit, sizes = unit_rows(values)
        turned = _turned(unit, basis)
        return pa.table({
            "block": table.column("block").slice(0, 1), "first": table.column("uid").slice(0, 1), "n": pa.array([len(values)], pa.int32()),
            "sizes": [sizes.tobytes()], "data": [np.concatenate([np.asarray(v, np.float64) for v in values]).astype(
                np.float32 if pa.types.is_float32(table.schema.field("embedding").type.value_type) else np.float64).tobytes()],
            "single": pa.array([pa.types.is_float32(table.schema.field("embedding").type.value_type)]),
            "lo": pa.array([turned.min(axis=0).tolist()], pa.list_(pa.float64())), "hi": pa.array([turned.max(axis=0).tolist()], pa.list_(pa.float64()))})

    blocked = ordered.withColumn("block", F.floor((F.col("uid") - 1) / size).cast("long"))
    return blocked.groupBy("block").applyInArrow(
        pack, "block long, first long, n int, sizes binary, data binary, single boolean, lo array<double>, hi array<double>")


def near_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs ``(a, b)`` of blocks, a <= b, whose boxes are within ``eps``.

    Recursion over halved intervals, ``FAN`` at a time: a pair of long intervals
    is opened into the pairs of its parts, and pairs whose boxes are further
    apart than ``eps`` are dropped with all they hold. Every step is an equi-join with
    the parts of the intervals that are left.
    """
    top = boxes.agg(F.max("block")).first()[0] or 0
    levels = [boxes.select(F.col("block").alias("node"), "lo", "hi")]
    while top > 0:
        lines = levels[-1].select(F.floor(F.col("node") / FAN).cast("long").alias("node"), F.posexplode(F.arrays_zip("lo", "hi")).alias("i", "x"))
        lines = lines.groupBy("node", "i").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
        grouped = lines.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("i", "lo", "hi"))).alias("x"))
        levels.append(grouped.select("node", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi")))
        top //= FAN
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        part = level.withColumn("above", F.floor(F.col("node") / FAN).cast("long"))
        left = part.select(F.col("above").alias("a"), F.col("node").alias("a2"), F.col("lo").alias("al"), F.col("hi").alias("ah"))
        right = part.select(F.col("above").alias("b"), F.col("node").alias("b2"), F.col("lo").alias("bl"), F.col("hi").alias("bh"))
        both = pairs.join(left, "a").join(right, "b").filter("a2 <= b2")
        gap = F.transform(F.arrays_zip("al", "ah", "bl", "bh"), lambda z: F.greatest(z["bl"] - z["ah"], z["al"] - z["bh"], F.lit(0.0)))
        apart = F.aggregate(F.transform(gap, lambda g: g * g), F.lit(0.0), lambda s, g: s + g)
        pairs = cut_lineage(both.filter(apart <= eps * eps * (1 + SLACK)).select(F.col("a2").alias("a"), F.col("b2").alias("b")))
    return pairs


def _unpacked(sizes: bytes, data: bytes, single: bool):
    lengths = np.frombuffer(sizes, np.int32)
    flat = np.frombuffer(data, np.float32 if single else np.float64).astype(np.float64)
    return unit_rows(np.split(flat, np.cumsum(lengths)[:-1]))


def linked(ax: np.ndarray, an: np.ndarray, bx: np.ndarray, bn: np.ndarray, threshold: float, same: bool, basis: np.ndarray):
    """Index pairs of linked vectors of two intervals (i < j inside one interval).

    Parts of ``LEAF`` vectors whose boxes are too far apart are skipped; the rest
    is multiplied in single precision, and all that may reach the threshold again in double.
    """
    width = max(ax.shape[1], bx.shape[1])
    ax, bx = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (ax, bx))
    at, bt = _turned(ax, basis), _turned(bx, basis)
    a4, b4 = ax.astype(np.float32), bx.astype(np.float32)
    far = (2 - 2 * threshold) * (1 + SLACK)
    found = []
    starts_a, starts_b = range(0, len(ax), LEAF), range(0, len(bx), LEAF)
    bl = np.array([bt[j : j + LEAF].min(axis=0) for j in starts_b])
    bh = np.array([bt[j : j + LEAF].max(axis=0) for j in starts_b])
    for i in starts_a:
        al, ah = at[i : i + LEAF].min(axis=0), at[i : i + LEAF].max(axis=0)
        gap = np.maximum(0, np.maximum(bl - ah, al - bh))
        for k, j in enumerate(starts_b):
            if (same and j < i) or (gap[k] ** 2).sum() > far:
                continue
            x, y = np.nonzero(a4[i : i + LEAF] @ b4[j : j + LEAF].T >= threshold - SLACK)
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            ok = (an[x] == bn[y]) & (np.einsum("ij,ij->i", ax[x], bx[y]) >= threshold)
            if ok.any():
                found.append((x[ok], y[ok]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id with the smallest id of its part of the given links."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    low = np.arange(len(ids))
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        new = new[new]
        if (new == low).all():
            return ids, ids[low]
        low = new


def vector_links(blocks: DataFrame, pairs: DataFrame, threshold: float, basis: np.ndarray) -> DataFrame:
    """Rows ``(uid, root, n)``: per pair of blocks, the links of each vector and one edge to its local root.

    At most two rows per vector and pair of blocks, however many links there are.
    """
    even = (F.col("a") + F.col("b")) % 2 == 0  # alternate sides, so that no block is on the same side of all its pairs
    sided = pairs.select(F.when(even, F.col("a")).otherwise(F.col("b")).alias("p"), F.when(even, F.col("b")).otherwise(F.col("a")).alias("q"))
    side = lambda k: blocks.select(F.col("block").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in ("first", "sizes", "data", "single")))
    both = sided.join(side("p"), "p").join(side("q"), "q")

    def compare(batches):
        for batch in batches:
            for r in range(batch.num_rows):  # row by row: one pair of blocks in memory at a time
                get = lambda name, r=r, batch=batch: batch.column(name)[r].as_py()
                same = get("p") == get("q")
                ax, an = _unpacked(get("p_sizes"), get("p_data"), get("p_single"))
                bx, bn = (ax, an) if same else _unpacked(get("q_sizes"), get("q_data"), get("q_single"))
                x, y = linked(ax, an, bx, bn, threshold, same, basis)
                if not len(x):
                    continue
                a, b = x + get("p_first"), y + get("q_first")
                ids, roots = forest(a, b)
                _, counts = np.unique(np.concatenate([a, b]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots), pa.array(counts.astype(np.int64))], names=["uid", "root", "n"])

    return both.mapInArrow(compare, "uid long, root long, n long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors that are null, zero or hold null or non-finite components, and
    vectors of different lengths, are not linked. Equal rows are separate
    vectors and link with each other; component_id is the smallest vec_id of the
    component. An empty table gives no rows. Other columns are not read.
    """
    rows = vectors.select("vec_id", "embedding")
    fit, rest = rows.filter(usable(F.col("embedding"))), rows.filter(~usable(F.col("embedding")))
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    eps = math.sqrt(2 - 2 * threshold)
    basis = principal_basis(fit)
    ordered = in_grid_order(fit, basis, eps)
    blocks = cut_lineage(packed_blocks(ordered, basis))
    found = cut_lineage(vector_links(blocks, near_pairs(blocks.select("block", "lo", "hi"), eps), threshold, basis))
    counts = found.groupBy("uid").agg(F.sum("n").alias("n_links"))
    member = components(found.filter("uid <> root").select(F.col("uid").alias("a"), F.col("root").alias("b")))
    member = member.select(F.col("id").alias("uid"), F.col("component").alias("part"))
    named = cut_lineage(ordered.select("uid", "vec_id").join(counts, "uid", "left").join(member, "uid", "left"))
    lowest = named.filter("part is not null").groupBy("part").agg(F.min("vec_id").alias("low"))
    joined = named.join(lowest, "part", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("low", "vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``, cosine of 0.9 and more."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
