"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the k least of the distinct shingle hashes of a text, ascending. Sketches of parts
merge into that of the whole, and estimate resemblance, containment and the number
of distinct shingles. Written as text, each hash has twelve hexadecimal digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import SLICE_BYTES, by_batch, shipped, slices, text_shingles

K = 128
#: Words of a shingle; a text with fewer words has its whole sequence as one.
SHINGLE = 5
_BITS = 48
_DIGITS = _BITS // 4


def sketches(texts: pa.Array, k: int = K, size: int = SHINGLE) -> list[np.ndarray]:
    """The sketch of each text (no nulls); a text without words has an empty one."""
    return [np.unique(h >> np.uint64(64 - _BITS))[:k] for h in text_shingles(texts, size)]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BITS // 8 :].tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i : i + _DIGITS], 16) for i in range(0, len(fingerprint), _DIGITS)], np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both sets together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the k least hashes of both that both have. Two empty sets are alike."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**_BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 if a is empty."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_shingles(a, k))


def fingerprints(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint and n_shingles (estimated, double) of each row; null text counts as empty."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            found = sketches(part.column("text"), k, size)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(map(written, found), pa.string()), pa.array([distinct_shingles(s, k) for s in found])],
                names=["doc_id", "fingerprint", "n_shingles"],
            )

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, fingerprint string, n_shingles double")


def merged(prints: DataFrame, key: str, k: int = K) -> DataFrame:
    """key, fingerprint: that of all rows of a key together. A task merges its rows first, so a key brings a row per task at most."""
    kind = prints.schema[key].dataType.simpleString()
    shipped(prints.sparkSession)

    def join(rows: pd.Series) -> str:
        total = np.zeros(0, np.uint64)
        for x in rows.dropna():
            total = merge(total, read(x), k)
        return written(total)

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.groupby(key, dropna=False)["fingerprint"].agg(join).reset_index()

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: rows[key].iloc[:1], "fingerprint": [join(rows["fingerprint"])]})

    schema = f"`{key}` {kind}, fingerprint string"
    return prints.select(key, "fingerprint").mapInPandas(within, schema).groupBy(key).applyInPandas(across, schema)


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text in an order in which, within a `bucket`, each row is followed by the next in descending doc_id.

    Rows are dealt into ranges of ids (a null id is the least; rows of one id lie in one
    range). A row with `halo` is no row of its own but a copy of what follows the range's
    last row: the first of the next range, or, after the least id, of the first one. Only
    ids are looked at beforehand; what comes to the driver is one value per range.
    """
    spark = shipped(docs.sparkSession)
    least = -(1 << 63)
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * parts
    cuts = rows.agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)], F.lit(10_000)) if buckets > 1 else F.array()).first()[0]
    splits = np.array(sorted(set(cuts or [])), np.int64)

    def ranges_of(key: pd.Series) -> np.ndarray:
        return np.searchsorted(splits, key.to_numpy(), "left")

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(ranges_of(key).astype(np.int32))

    tops = rows.select("key", range_of("key").alias("b")).groupBy("b").agg(F.max("key").alias("top")).collect()
    ordered = sorted(((r.top, r.b) for r in tops), reverse=True)
    before = {top: ordered[i - 1][1] for i, (top, _) in enumerate(ordered)}  # the first range's top follows the last range

    @F.pandas_udf("array<struct<bucket:int,halo:boolean>>")
    def targets(key: pd.Series) -> pd.Series:
        own = ranges_of(key).tolist()
        out = []
        for k, b in zip(key.tolist(), own):
            places = [{"bucket": b, "halo": False}]
            if k in before:
                places.append({"bucket": before[k], "halo": True})
            out.append(places)
        return pd.Series(out)

    dealt = rows.withColumn("to", F.explode(targets("key"))).select("doc_id", "text", "key", "to.bucket", "to.halo")
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "halo", F.desc("key"), F.hash("text"), "text")


def edited(text: str, following: str) -> str:
    """`text` with its last floor(n / 2) code points replaced by the first as many of `following`, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """For each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty; two empty texts are alike. Rows of one id are ordered by
    their texts, and each is followed by the next of them. A single row is followed by
    itself. No rows give no rows. Texts are shuffled once, by ranges of ids.
    """

    def results(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (doc_id, text, halo), in order; what follows a row is the next one, and a range ends with a halo."""
        pairs = [i for i in range(len(rows) - 1) if not rows[i][2]]
        changed = [edited(rows[i][1], rows[i + 1][1]) for i in pairs]
        own, other = sketches(pa.array([r[1] for r in rows]), k, size), sketches(pa.array(changed, pa.string()), k, size)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in pairs], pa.int64()),
                pa.array([len(rows[i][1]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                pa.array([written(own[i]) for i in pairs], pa.string()),
                pa.array(map(written, other), pa.string()),
                pa.array([resemblance(own[i], x, k) for i, x in zip(pairs, other)], pa.float64()),
                pa.array([resemblance(own[i], own[i + 1], k) for i in pairs], pa.float64()),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple] = []
        size_so_far = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "halo"))):
                row = (row[0], row[1] or "", row[2])
                if row[2] and carried and carried[-1][2]:
                    continue  # rows that share a range's greatest id: the first of them is what follows
                carried.append(row)
                size_so_far += len(row[1])
                if size_so_far >= SLICE_BYTES and not row[2]:
                    yield results(carried)
                    carried, size_so_far = [row], len(row[1])
        if carried:
            yield results(carried)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = ("long", "long", "string", "string", "string", "double", "double")
    ordered = with_next(docs).select("doc_id", "text", "halo")
    return ordered.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
