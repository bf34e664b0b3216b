"""Rows and sorted hashes packed into binaries, so that shuffles carry few bytes per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from merkmal.llm.common import lean_memory, shuffle_parts

GROUP_BYTES = 8 * 1024 * 1024
FLUSH_BYTES = 16 * 1024 * 1024


def group_bits(docs: DataFrame, column: str = "text", group_bytes: int = GROUP_BYTES) -> int:
    """log2 of the number of groups: groups of about ``group_bytes``, and one per shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0
    groups = max(shuffle_parts(docs.sparkSession), -(-total // group_bytes), 2)
    return int(groups - 1).bit_length()


def planes(values: np.ndarray) -> bytes:
    """Bytes of the values, equal places together, which compresses well when high bytes repeat."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned values as differences in byte planes."""
    if not len(values):
        return b""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_sorted(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.empty(0, dtype)
    return np.cumsum(from_planes(data, dtype), dtype=dtype)


_IPC = pa.ipc.IpcWriteOptions(compression="zstd")


def packed_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_IPC) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked_table(payloads: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in payloads])


def packed_by_home(docs: DataFrame, bits: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(home, payload)``: rows spread by key and text over ``2**bits`` homes, packed per task.

    Rows that share a key or have none still spread; equal rows share a home.
    """

    def run(batches):
        lean_memory()
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= FLUSH_BYTES:
                yield flushed(held)
                held, size = [], 0
        if held:
            yield flushed(held)

    def flushed(batches) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        texts = table.column(text).cast(pa.binary())
        marks = np.fromiter(
            (xxhash.xxh3_64_intdigest(t.as_py() or b"", seed=(k or 0) & 0xFFFFFFFF) for k, t in zip(table.column(key).to_pylist(), texts)),
            dtype=np.uint64, count=table.num_rows)
        home = (marks >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(home, kind="stable")
        homes, starts = np.unique(home[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        payloads = [packed_table(table.take(pa.array(order[a:b]))) for a, b in zip(starts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()), pa.array(payloads, pa.binary())], names=["home", "payload"])

    return docs.mapInArrow(run, "home int, payload binary")
