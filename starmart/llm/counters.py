"""Counters of fixed number, summed over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.common import SLICE_BYTES, mixed, shipped, slices

COUNTERS = 1 << 18
_STRIPE = 1 << 12


def summed(docs: DataFrame, keys: Callable[[pa.Array], np.ndarray], most: int = SLICE_BYTES) -> np.ndarray:
    """How many of the 64-bit `keys` of all texts fall to each of COUNTERS counters, by their low bits; about `most` bytes of text are asked for at once.

    Each task brings one row per stripe of counters; stripes are added up as a stream.
    """

    def stripes(total: np.ndarray) -> pa.RecordBatch:
        parts = total.reshape(-1, _STRIPE)
        return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts])], names=["stripe", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, most=most):
                total += np.bincount(places(keys(part.column("text"))), minlength=COUNTERS)
        yield stripes(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[stripe] = sums.get(stripe, 0) + np.frombuffer(counts, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()])], names=["stripe", "counts"])

    shipped(docs.sparkSession)
    schema = "stripe int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).repartition(COUNTERS // _STRIPE, "stripe").mapInArrow(add, schema).collect()
    out = np.zeros((COUNTERS // _STRIPE, _STRIPE), np.int64)
    for row in rows:  # COUNTERS / _STRIPE rows
        out[row.stripe] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


def places(keys: np.ndarray) -> np.ndarray:
    """The counters of the keys."""
    return (keys & np.uint64(COUNTERS - 1)).astype(np.int64)


#: Bits of a membership filter.
BITS = 1 << 23


def membership(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of BITS bits over the long column `id`: what it denies is not there. Its size does not depend on the data."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            for at in _bits(np.asarray(batch.column("id"))):
                bits[at] = True
        packed = np.packbits(bits).reshape(-1, _STRIPE)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(packed)), pa.int32()), pa.array([x.tobytes() for x in packed])], names=["stripe", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[stripe] = found.get(stripe, 0) | np.frombuffer(bits, np.uint8)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([x.tobytes() for x in found.values()])], names=["stripe", "bits"])

    shipped(ids.sparkSession)
    schema = "stripe int, bits binary"
    rows = ids.select("id").mapInArrow(mark, schema).repartition(64, "stripe").mapInArrow(join, schema).collect()
    out = np.zeros((BITS // 8 // _STRIPE, _STRIPE), np.uint8)
    for row in rows:  # BITS / 8 / _STRIPE rows
        out[row.stripe] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _bits(ids: np.ndarray) -> list[np.ndarray]:
    once = mixed(ids.astype(np.uint64) + np.uint64(17))
    return [(h & np.uint64(BITS - 1)).astype(np.int64) for h in (once, once >> np.uint64(32))]


def perhaps_in(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids the filter does not deny."""
    out = np.ones(len(ids), bool)
    for at in _bits(ids):
        out &= (filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return out


def those(docs: DataFrame, filter_: np.ndarray) -> DataFrame:
    """The rows of `docs` whose non-null long `doc_id` the filter does not deny."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(perhaps_in(filter_, np.asarray(batch.column("doc_id")))))

    shipped(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)
