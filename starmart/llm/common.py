"""What the operators of this package share: scratch tables, Arrow text as flat bytes, hashed words and shingles."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: list[np.ndarray] = []

#: Span hashes are polynomials modulo this prime, in bases that no byte pattern is special to.
_PRIME = (1 << 61) - 1
_BASES = (0x0B7E151628AED2A5, 0x1243F6A8885A308D)
_PRIME_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: A span of so many bytes is hashed by itself: sums of longer ones would not fit 64 bits.
_WIDE = 1 << 23

_TEMPORARY: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of `spark.checkpoint.dir`.

    Where that is unset, a local session takes a temporary folder, one for each application; any other session fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _TEMPORARY.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="starmart-")
        _TEMPORARY[context.applicationId] = root
    return f"{root.rstrip('/')}/starmart/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a scratch table and read again: cuts the lineage, and each part is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the scratch table of a frame that `stored` returned, when nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def tidied(spark: SparkSession) -> None:
    """Frees what ended queries left in the driver, where its heap has taken half of what it may.

    Each query leaves plans, broadcasts, task binaries and shuffle files that nothing refers to any more. The driver's heap
    would grow to its limit before it looks for them; a collection gives the memory back, and Spark then removes the files.
    """
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if 2 * heap.totalMemory() >= heap.maxMemory():
        gc.collect()  # frames that Python still holds
        spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shipped(spark: SparkSession) -> SparkSession:
    """`spark`, after its workers were given this package's source, once for each application."""
    context = spark.sparkContext
    # Rows of long texts make large Arrow batches; smaller ones than Spark's default keep workers small.
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="starmart-code-")) / "starmart.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, str(source.relative_to(package.parent)))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def by_batch(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`function` on each Arrow batch of `df`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    shipped(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """`batch` in runs of rows whose texts have about `most` bytes together; null texts become empty."""
    at = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(at), "")
    batch = batch.set_column(at, pa.field(column, texts.type), texts)
    ends = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64)) if len(texts) else np.zeros(0, np.int64)
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(low, high - low)
        low = high


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts, and each text's begin (with one more entry for the end)."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def words(
    data: np.ndarray, begins: np.ndarray, cuts: np.ndarray | None = None, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word `[^\\x20\\x09-\\x0D]+` in the bytes, and for each text its first word (one more for the end).

    White space is ASCII here, so byte positions never fall inside a code point; no word crosses a text.
    `cuts` marks bytes at which another word begins, if any; `inside` the bytes of words, where these are others.
    """
    if inside is None:
        inside = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(len(data) + 1, bool)
    if cuts is not None:
        first[:-1] = cuts
    first[begins] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, begins, "left")


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values spread over all bits (the finalizer of splitmix64); wraps."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if n > 8 * SLICE_BYTES:  # a very long text: not kept
            return tables[0], tables[1]
        _POWERS[:] = tables
    return _POWERS[0], _POWERS[1]


def _reduced(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values modulo the prime."""
    p = np.uint64(_PRIME)
    x = (x & p) + (x >> np.uint64(61))
    return np.where(x >= p, x - p, x)


def _shifted(x: np.ndarray, bits: int) -> np.ndarray:
    """x * 2^bits modulo the prime, for x below it: a rotation of 61 bits."""
    return ((x << np.uint64(bits)) & np.uint64(_PRIME)) | (x >> np.uint64(61 - bits))


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for values below it, in halves of 32 and 29 bits."""
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    a0, a1, b0, b1 = a & low, a >> half, b & low, b >> half
    across = _reduced(_reduced(a0 * b1) + _reduced(a1 * b0))
    out = _reduced(_reduced(a0 * b0) + _shifted(across, 32))
    return _reduced(out + _shifted(_reduced(a1 * b1), 3))  # 2^64 is 2^3 there


def _prime_powers(n: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo the prime."""
    known = _PRIME_POWERS.get(key)
    if known is not None and len(known[0]) >= n:
        return known
    size, tables = max(n, 2 * SLICE_BYTES), []
    for base in (_BASES[key], pow(_BASES[key], -1, _PRIME)):
        table = np.ones(size, np.uint64)
        done = 1
        while done < size:
            more = min(done, size - done)
            table[done : done + more] = _times(table[:more], np.uint64(pow(base, done, _PRIME)))
            done += more
        tables.append(table)
    if n <= 8 * SLICE_BYTES:  # those of a very long text are not kept
        _PRIME_POWERS[key] = (tables[0], tables[1])
    return tables[0], tables[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes: its polynomial modulo 2^61 - 1 by prefix sums, then mixed.

    `key` 0 or 1 picks one of two bases: together they tell apart what one of them does not.
    """
    up, down = _prime_powers(len(data) + 1, key)
    values = data.astype(np.uint64) + np.uint64(1)
    sizes = (ends - starts).astype(np.uint64)
    halves = []
    for part in (up[: len(data)] & np.uint64(0xFFFFFFFF), up[: len(data)] >> np.uint64(32)):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * part, out=sums[1:])
        halves.append(_reduced(sums[ends] - sums[starts]))  # exact: below 2^64 for a span of less than _WIDE bytes
    out = _times(_reduced(halves[0] + _shifted(halves[1], 32)), down[starts])
    for i in np.flatnonzero(sizes >= _WIDE).tolist():
        out[i] = _reduced(np.uint64([xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), key)]))[0]
    return mixed(out + sizes * np.uint64(0xD6E8FEB86659FD93))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


#: Shingle hashes may hold the shingle's bytes in words in their low bits, up to this number.
LENGTHS = 63


def shingles(word_hashes: np.ndarray, first: np.ndarray, size: int, lengths: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its `size`-word shingles.

    A text with fewer words has its whole sequence as the one shingle, a text without words has none.
    With the words' `lengths`, the low bits of a hash are the sum of its words' lengths, up to LENGTHS.
    """
    n = len(word_hashes)
    factors = [np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(size)]
    total = np.zeros(n, np.uint64)
    for j in range(min(size, n)):
        total[: n - j] += word_hashes[j:] * factors[j]
    total = mixed(total)
    if lengths is not None:
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bytes_ = np.minimum(ends[np.minimum(np.arange(n) + size, n)] - ends[:-1], LENGTHS).astype(np.uint64)
        total = (total & ~np.uint64(LENGTHS)) | bytes_
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            out.append(np.unique(total[low : high - size + 1]))
        elif high > low:
            part = word_hashes[low:high] * np.array(factors[: high - low], np.uint64)
            out.append(mixed(np.array([part.sum(dtype=np.uint64) + np.uint64(high - low)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_shingles(texts: pa.Array, size: int, with_lengths: bool = False) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, words compared with A-Z as a-z; see `shingles`."""
    data, begins = flat(texts)
    data = lowered(data)
    starts, ends, first = words(data, begins)
    return shingles(span_hashes(data, starts, ends), first, size, ends - starts if with_lengths else None)


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches joined to larger ones of about `most` bytes in the text `column`; a larger one is cut by `slices`."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        waiting.append(batch)
        held += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held >= most:
            yield from slices(pa.concat_batches(waiting), column, most)
            waiting, held = [], 0
    if waiting:
        yield from slices(pa.concat_batches(waiting), column, most)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + length), one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words among the spans of `data`, as binary, and for each span the place of its word there."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    joined = data[ranges(starts, sizes)]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
    return found.dictionary, np.asarray(found.indices)
