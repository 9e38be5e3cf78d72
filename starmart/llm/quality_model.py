"""Quality classifier by compression: how much better a dictionary of good text fits than one of bad text.

Two zstandard dictionaries are built from blocks of good and of bad labelled text. A text's blocks are compressed with
either; the normalised difference of the sizes, over the whole text and by block, becomes a score through
a logistic curve that is fitted to other labelled documents than those of the dictionaries. Blocks are short, so what a
text repeats within itself does not hide how it fits, and every block of every text counts.

What is learned from is bounded: of FITTED documents of each label, picked by a hash, BLOCKS blocks for the
dictionary, and FITTED other documents of each label for the curve, weighted as the labels are frequent. Without labels of both kinds the score is the share of label 1, counted with one row of each.

Null and empty texts have the share of label 1 among such labelled texts, drawn towards that of all. Repeated rows are scored
each; rows without doc_id are scored and never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import discard, shipped, slices, stored

#: Bytes of a block, of a dictionary, and blocks that a dictionary is built from, for each label.
BLOCK, DICTIONARY, BLOCKS = 256, 112_640, 40_000
#: Documents of each label that the dictionaries are built from, and as many others that the curve is fitted to.
FITTED = 10_000
LEVEL = 3
#: From this score on label 1 is predicted.
LIKELY = 0.3
_FEATURES = 5
#: Weight of the ridge that keeps the curve's slopes finite, in rows.
_RIDGE = 0.5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out: crc32 of its id as text, modulo 5, is 0. Rows without an id are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Curve:
    """A logistic curve over standardised features."""

    mean: np.ndarray
    spread: np.ndarray
    slopes: np.ndarray  # the first is the offset

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return _logistic(_standardised(features, self.mean, self.spread) @ self.slopes)


def _standardised(features: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), (features - mean) / spread])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fitted(features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> Curve:
    """The curve of largest likelihood for weighted rows, by Newton's steps."""
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    rows = _standardised(features, mean, spread)
    slopes = np.zeros(rows.shape[1])
    ridge = np.full(len(slopes), _RIDGE)
    ridge[0] = 1e-6
    for _ in range(50):
        p = _logistic(rows @ slopes)
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(bend, rows.T @ (weight * (labels - p)) - ridge * slopes)
        size = np.abs(step).max()
        slopes = slopes + step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return Curve(mean, spread, slopes)


def blocks_of(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


class Compressors:
    """The two dictionaries, ready to compress."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.both = [self._of(x) for x in (good, bad)]

    @staticmethod
    def _of(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)

    def features(self, data: bytes) -> list[float]:
        """Of a text that is not empty: normalised size difference, size against the text, the text's size, mean and least difference by block."""
        parts = blocks_of(data)
        good, bad = (np.array([len(c.compress(x)) for x in parts], float) for c in self.both)
        each = (bad - good) / (bad + good)
        share = np.array([len(x) for x in parts]) / len(data)
        return [(bad.sum() - good.sum()) / (bad.sum() + good.sum()), np.log(good.sum() / len(data)), np.log(len(data)), float(each @ share), each.min()]


def dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train one, their own bytes."""
    joined = b"".join(samples)
    if len(samples) >= 100 and len(joined) >= 10 * 1024:
        try:
            return zstandard.train_dictionary(min(DICTIONARY, len(joined) // 10), samples).as_bytes()
        except zstandard.ZstdError:  # samples too much alike
            pass
    return joined[-DICTIONARY:]


@dataclass(frozen=True)
class Model:
    """What a score needs; of fixed size."""

    good: bytes
    bad: bytes
    curve: Curve | None
    #: The score of an empty text, and of every text where there is no curve.
    empty: float
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The score of each text (no nulls)."""
        out = np.full(len(texts), self.prior)
        data = [t.encode() for t in texts.to_pylist()]
        filled = np.array([bool(x) for x in data], bool)
        out[~filled] = self.empty
        if self.curve is not None and filled.any():
            key = hash((self.good, self.bad))
            if key not in _READY:
                _READY.clear()
                _READY[key] = Compressors(self.good, self.bad)
            out[filled] = self.curve(np.array([_READY[key].features(x) for x in data if x]))
        return out


_READY: dict[int, Compressors] = {}


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, half) of the labels that are not held out; half 0 is for dictionaries, 1 for the curve."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    return known.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2)))


def _sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, quality, half) for the FITTED ids of least hash of either label and half. An id with several texts has all."""
    ids = [
        known.where((F.col("quality") == label) & (F.col("half") == half)).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(FITTED)
        for label in (0, 1)
        for half in (0, 1)
    ]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(reduce(DataFrame.unionAll, ids)), "doc_id")  # 4 * FITTED rows


def _dictionaries(rows: DataFrame) -> list[bytes]:
    """The bad and the good dictionary, from the BLOCKS blocks of least hash of either label."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for doc, text, label in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "quality"))):
                    cuts = blocks_of(text.encode())
                    at = range(len(cuts))
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(cuts), pa.int64()), pa.array([label] * len(cuts), pa.int32()), pa.array(at, pa.int32()), pa.array(cuts, pa.binary())], names=["doc_id", "quality", "at", "block"])

    cuts = rows.where("half = 0").select("doc_id", "text", "quality").mapInArrow(cut, "doc_id long, quality int, at int, block binary")
    out = []
    for label in (0, 1):
        picked = cuts.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at", "block").limit(BLOCKS)
        out.append(dictionary([bytes(r.block) for r in picked.select("block").collect()]))  # BLOCKS rows
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled documents that are not held out."""
    spark = shipped(docs.sparkSession)
    known = _labelled(labels)
    number = np.zeros((2, 2))
    for half, quality, n in known.groupBy("half", "quality").count().collect():  # four rows
        number[half, quality] = n
    prior = (number[:, 1].sum() + 1) / (number.sum() + 2)
    rows = stored(_sample(docs, known), "labelled")
    seen = np.zeros((2, 2, 2))
    for half, quality, empty, n in rows.groupBy("half", "quality", (F.col("text") == "").alias("empty")).count().collect():  # eight rows
        seen[half, quality, int(empty)] = n
    empty = (seen[:, 1, 1].sum() + prior) / (seen[:, :, 1].sum() + 1)
    if not (seen[:, :, 0] > 0).all():
        discard(rows)
        return Model(b"", b"", None, empty, prior)
    bad, good = _dictionaries(rows)
    shared = spark.sparkContext.broadcast((good, bad))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(*shared.value)
        for batch in batches:
            for part in slices(batch):
                values = [compressors.features(t.encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(values, pa.list_(pa.float64()))], names=["quality", "features"])

    fit = rows.where("half = 1 AND text <> ''").select("text", "quality").mapInArrow(features, "quality int, features array<double>")
    fit = fit.orderBy("quality", "features").collect()  # of 2 * FITTED ids
    wanted = np.array([r.quality for r in fit], float)
    weight = np.where(wanted == 1, number[1, 1] / max(wanted.sum(), 1), number[1, 0] / max((1 - wanted).sum(), 1))
    curve = fitted(np.array([r.features for r in fit]), wanted, weight)
    discard(rows)
    return Model(good, bad, curve, empty, prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (doc_id, text) as (doc_id, held_out, score, predicted)."""
    spark = shipped(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.scores(part.column("text")))], names=["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(score, f"doc_id {id_type}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LIKELY).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's quality, learned from the labelled ones that are not held out."""
    return scored(docs, learn(docs, labels))
