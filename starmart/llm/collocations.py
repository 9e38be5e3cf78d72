"""Phrase collocations: frequent word sequences of each language and how firmly they belong together.

Frequent phrases are found in two passes. The first keeps Misra-Gries summaries of the phrases' 64-bit hashes, one
for each hash partition: tasks bring partial counts, which merge in any order, and a summary never
takes off as many occurrences from a counter as a frequent phrase has, so every frequent one survives. It runs over
words and pairs, then over those longer phrases all of whose pairs may be frequent. The second pass counts exactly,
by text, the phrases whose hash survived. Survivors go to the tasks as a filter of bounded size, one
segment of bits for each hash partition; what it lets through wrongly is counted too and falls to the exact count.

Texts: null and empty ones have no words, a null language is `und`, repeated rows count once each,
`doc_id` is not used, other columns are ignored. An empty table, or one without a frequent phrase, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.common import distinct_words, flat, gathered, lowered, mixed, shipped, span_hashes, stored, words

#: Language of rows without one.
UNKNOWN = "und"
#: Counters of a summary.
CAPACITY = 1 << 18
#: Bits of the filter of survivors, together.
FILTER_BITS = 1 << 28
#: Bytes of text worked on at once, and hashes held before they are counted.
_TEXT_BYTES, _HELD = 1 << 23, 1 << 22
#: Rows of exact counts that a task adds up before it sends them.
_COUNTED = 1 << 20
#: Hashes of one row that goes to a summary, and bytes of each there: the rest tells the partition.
_ROW_KEYS, _KEY_BYTES = 1 << 13, 5
# Bytes of words 0, blanks between words 1, bytes that end a piece 2: `.,;:!?` and line breaks.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[list(b".,;:!?") + list(range(10, 14))] = 2
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: Copies of the counts of short phrases in a join, by number of words: a word begins many phrases. 0 words: a language's total.
_SALTS = {0: 64, 1: 16, 2: 4}


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to `longest` words (5 at most) with `least` occurrences in a language or more; `most` rows a language."""

    least: int = 100
    longest: int = 5
    most: int = 2000
    capacity: int = CAPACITY

    def __post_init__(self):
        if not (2 <= self.longest <= len(_STEPS) and self.least >= 1 and self.most >= 1 and self.capacity >= 1):
            raise ValueError(f"out of range: {self}")


class _Words:
    """The words of a batch of (text, lang) rows, by position; pieces are numbered, none crosses a text."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, begins = flat(batch.column("text"))
        data = lowered(data)
        kind = _KIND[data]
        starts, ends, first = words(data, begins, inside=kind == 0)
        self.words, self.at = distinct_words(data, starts, ends)
        texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.piece = np.cumsum(kind == 2)[starts] + texts if len(starts) else texts
        langs = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
        self.langs, self.lang = langs.dictionary, np.asarray(langs.indices)[texts]
        self.hash = mixed(_hashed(self.words)[self.at] ^ _hashed(self.langs)[self.lang])

    def whole(self, size: int) -> np.ndarray:
        """At which words a phrase of `size` words lies within a piece."""
        out = np.zeros(len(self.piece), bool)
        if len(out) >= size:
            out[: len(out) - size + 1] = self.piece[: len(out) - size + 1] == self.piece[size - 1 :]
        return out

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """64-bit hashes of the phrases of `size` words at the positions `at`; the language is part of them."""
        total = np.full(len(at), size, np.uint64)
        for j in range(size):
            total += self.hash[at + j] * _STEPS[j]
        return mixed(total)


def _hashed(texts: pa.Array) -> np.ndarray:
    data, begins = flat(texts)
    return span_hashes(data, begins[:-1], begins[1:])


def summary(keys: np.ndarray, counts: np.ndarray, taken: int, capacity: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of the partial counts: distinct ascending keys, counters, and what each may lack at most.

    Equal keys are added up. Beyond `capacity` keys all counters give up what the next one below has, unless that
    would bring `taken` to `least`: then all stay, so no key with `least` occurrences is ever lost. With a
    capacity above the mass divided by `least` that does not occur.
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    if len(keys) > capacity:
        off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        if taken + off < least:
            taken += off
            stay = counts > off
            keys, counts = keys[stay], counts[stay] - off
    return keys, counts, taken


class Survivors:
    """Hashes that may belong to frequent phrases: a segment of bits for each hash partition."""

    def __init__(self, segments: np.ndarray) -> None:
        self.segments = segments  # one row of bytes for each partition

    def perhaps(self, keys: np.ndarray) -> np.ndarray:
        part, low = _split(keys, len(self.segments))
        out = np.ones(len(keys), bool)
        for bit in _bits(low, self.segments.shape[1] * 8):
            out &= (self.segments[part, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
        return out


def _split(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition of each key, which grows with the key, and the key's bytes that are kept there."""
    part = ((keys >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
    return part.astype(np.int64), keys & np.uint64((1 << 8 * _KEY_BYTES) - 1)


def _bits(low: np.ndarray, size: int) -> list[np.ndarray]:
    return [(h & np.uint64(size - 1)).astype(np.int64) for h in (low, mixed(low))]


def _partial_counts(found: Iterator[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """The hashes counted in runs of a bounded number, as rows of (partition, key bytes, counts; null: one each)."""

    def rows(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        part, low = _split(keys, parts)
        packed = low.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]
        out: list[tuple[int, bytes, bytes | None]] = []
        for once in (True, False):
            chosen = np.flatnonzero((counts == 1) == once)
            edges = np.searchsorted(part[chosen], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                for a in range(edges[p], edges[p + 1], _ROW_KEYS):
                    at = chosen[a : min(a + _ROW_KEYS, edges[p + 1])]
                    out.append((p, packed[at].tobytes(), None if once else counts[at].astype(np.uint32).tobytes()))
        for a in range(0, len(out), 64):
            p, keys_, counts_ = zip(*out[a : a + 64])
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(keys_, pa.binary()), pa.array(counts_, pa.binary())], names=["part", "keys", "counts"])

    waiting, held = [], 0
    for keys in found:
        waiting.append(keys)
        held += len(keys)
        if held >= _HELD:
            yield from rows(np.concatenate(waiting))
            waiting, held = [], 0
    if held:
        yield from rows(np.concatenate(waiting))


def _merged(rows: Iterator[pa.RecordBatch], policy: Phrases, segment: int) -> Iterator[pa.RecordBatch]:
    """The segment of survivors of each hash partition: the merged summary of its rows. One partition at a time comes to a task."""
    states: dict[int, tuple] = {}
    for batch in rows:
        for part, packed, counts in zip(*(c.to_pylist() for c in batch.columns)):
            keys = np.zeros((len(packed) // _KEY_BYTES, 8), np.uint8)
            keys[:, :_KEY_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, _KEY_BYTES)
            keys = keys.view(np.uint64).reshape(-1)
            counted = np.ones(len(keys), np.int64) if counts is None else np.frombuffer(counts, np.uint32).astype(np.int64)
            kept, taken, waiting, held = states.get(part, ((np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0, [], 0))
            waiting.append((keys, counted))
            held += len(keys)
            if held >= 3 * policy.capacity:
                *kept, taken = summary(*(np.concatenate(x) for x in zip(kept, *waiting)), taken, policy.capacity, policy.least)
                waiting, held = [], 0
            states[part] = (tuple(kept), taken, waiting, held)
    for part, (kept, taken, waiting, _) in states.items():
        keys, counts, taken = summary(*(np.concatenate(x) for x in zip(kept, *waiting)), taken, policy.capacity, policy.least)
        bits = np.zeros(segment, np.uint8)
        for at in _bits(keys[counts + taken >= policy.least], segment):
            bits[at] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "bits"])


def _survivors(docs: DataFrame, policy: Phrases, parts: int, pairs) -> Survivors:
    """Survivors among words and pairs, or, given those (a broadcast), among longer phrases."""
    segment = 1 << max(6, min(FILTER_BITS // parts, 16 * policy.capacity).bit_length() - 1)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in gathered(batches, "text", _TEXT_BYTES):
            found = _Words(batch)
            if pairs is None:
                for size in (1, 2):
                    yield found.keys(np.flatnonzero(found.whole(size)), size)
                continue
            at = np.flatnonzero(found.whole(2))
            linked = np.zeros(len(found.piece) + 1, bool)
            linked[at] = pairs.value.perhaps(found.keys(at, 2))
            chain = linked[:-1]
            for size in range(3, policy.longest + 1):
                chain = chain[:-1] & linked[size - 2 : size - 2 + len(chain) - 1] if len(chain) else chain
                yield found.keys(np.flatnonzero(chain), size)

    shipped(docs.sparkSession)
    rows = docs.mapInArrow(lambda batches: _partial_counts(hashes(batches), parts), "part int, keys binary, counts binary")
    rows = rows.repartitionById(parts, "part").mapInArrow(lambda batches: _merged(batches, policy, segment), "part int, bits binary")
    out = np.zeros((parts, segment // 8), np.uint8)
    for row in rows.toLocalIterator():  # one row a partition, FILTER_BITS bits together
        out[row.part] = np.frombuffer(row.bits, np.uint8)
    return Survivors(out)


def _exact(batch: pa.RecordBatch, policy: Phrases, pairs: Survivors, longer: Survivors) -> Iterator[pa.RecordBatch]:
    """Counts of the batch's surviving phrases by their text, and of all words of each language (0 words, empty phrase)."""
    found = _Words(batch)
    languages = np.bincount(found.lang, minlength=len(found.langs))
    n = len(found.piece)
    yield _counted(found.langs, 0, pa.array([""] * len(found.langs), pa.string()), languages)
    codes = found.at.astype(np.int64) * len(found.langs) + found.lang
    base = len(found.langs) * max(len(found.words), 1)
    spelled = found.words.cast(pa.binary()).cast(pa.string())
    prefix, may = codes, np.ones(n, bool)
    for size in range(1, min(policy.longest, n) + 1):
        chosen = found.whole(size)
        chosen[: n - size + 1] &= may[: n - size + 1]
        if size > 1:  # both shorter phrases must be left
            chosen[: n - size + 1] &= may[1 : n - size + 2]
        at = np.flatnonzero(chosen)
        at = at[(pairs if size < 3 else longer).perhaps(found.keys(at, size))]
        # Phrases are told apart exactly: by the number of the phrase without its last word, and that word's.
        keys = codes[at] if size == 1 else prefix[at] * base + codes[at + size - 1]
        distinct, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        prefix = np.zeros(n, np.int64)
        prefix[at] = inverse
        may = np.zeros(n, bool)
        may[at] = True
        if not len(distinct):
            break
        where = at[first]
        parts = [spelled.take(pa.array(found.at[where + j])) for j in range(size)]
        phrases = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
        yield _counted(found.langs.take(pa.array(found.lang[where])), size, phrases, counts)


def _counted(langs: pa.Array, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs.cast(pa.string()), pa.array(np.full(len(counts), size, np.int32)), phrases, pa.array(counts.astype(np.int64))],
        names=["lang", "n_words", "phrase", "f"],
    )


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts with equal phrases added up, in runs of a bounded number of rows."""
    waiting: list[pa.Table] = []
    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        if sum(map(len, waiting)) >= _COUNTED:
            waiting = [_sums(waiting)]
            if len(waiting[0]) > _COUNTED // 2:
                yield from waiting.pop().to_batches(max_chunksize=_COUNTED // 8)
    if waiting:
        yield from _sums(waiting).to_batches(max_chunksize=_COUNTED // 8)


def _sums(tables: list[pa.Table]) -> pa.Table:
    names = ["lang", "n_words", "phrase"]
    return pa.concat_tables(tables).combine_chunks().group_by(names).aggregate([("f", "sum")]).rename_columns([*names, "f"])


_NAMES = ["lang", "n_words", "phrase", "f"]


def _packed(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The counts as one row of lists for each hash partition."""
    for batch in batches:
        part = ((_hashed(batch.column("phrase")) ^ _hashed(batch.column("lang"))) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        held, begins = np.unique(part[order], return_index=True)
        offsets = pa.array(np.append(begins, len(part)), pa.int32())
        batch = batch.take(pa.array(order))
        lists = [pa.ListArray.from_arrays(offsets, batch.column(name)) for name in _NAMES]
        yield pa.RecordBatch.from_arrays([pa.array(held), *lists], names=["part", *_NAMES])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(name).flatten() for name in _NAMES], names=_NAMES)


def frequent_phrases(docs: DataFrame, policy: Phrases = Phrases()) -> DataFrame:
    """(lang, n_words, phrase, f): every phrase of 1 to `longest` words with `least` occurrences, and each language's words (n_words 0)."""
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # At most one word for each two bytes, and three phrases a word in either round: the mass is never larger.
    parts = max(spark.sparkContext.defaultParallelism, -(-3 * (size // 2 + 1) // (policy.least * policy.capacity)))
    pairs = spark.sparkContext.broadcast(_survivors(docs, policy, parts, None))
    longer = spark.sparkContext.broadcast(_survivors(docs, policy, parts, pairs) if policy.longest > 2 else pairs.value)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (part for batch in gathered(batches, "text", _TEXT_BYTES) for part in _exact(batch, policy, pairs.value, longer.value))
        return _packed(_added_up(found), parts)

    counts = docs.mapInArrow(count, "part int, lang array<string>, n_words array<int>, phrase array<string>, f array<long>")
    # Tables of counts merge by hash partition; what a task had to send in several runs is added up at last.
    merged = counts.repartitionById(parts, "part")
    counts = merged.mapInArrow(lambda batches: _added_up(_unpacked(batches)), "lang string, n_words int, phrase string, f long")
    counts = counts.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f"))
    return counts.where(f"n_words = 0 AND f > 0 OR f >= {policy.least}")


def _part(side: int, k: int | str, first: int | str, size: int | str) -> str:
    """SQL of a part of a phrase: `size` words from the `first` on, which its cut after k words asks for."""
    return f"named_struct('side', {side}, 'k', {k}, 'part_words', {size}, 'part', array_join(slice(words, {first}, {size}), ' '))"


def _by_words(salted: str, other: str) -> str:
    """SQL by the number of words of a part: `salted` with its copies, or `other`."""
    return "CASE part_words " + " ".join(f"WHEN {n} THEN {salted.format(m)}" for n, m in _SALTS.items()) + f" ELSE {other} END"


def collocations(docs: DataFrame, policy: Phrases = Phrases()) -> DataFrame:
    """Each language's first `most` collocations: (lang, rank, phrase, a, l, r, n, score).

    A phrase's cut after its first k words has l, r = occurrences of both parts and score floor(1000 * a * n / (l * r));
    the cut with the lowest score counts, then the one with the smallest k. Phrases inside a longer one with as
    many occurrences are left out. By score and a, both descending, then by phrase in byte order.
    """
    counts = stored(frequent_phrases(docs, policy), "phrases")
    longer = counts.where("n_words > 1")
    # A phrase lies in a longer one of as many occurrences exactly if it does in one with one word more.
    inner = longer.where("n_words > 2").select("lang", "n_words", "f", F.split("phrase", " ", -1).alias("words"))
    shorter = "array_join(slice(words, 1, n_words - 1), ' '), array_join(slice(words, 2, n_words - 1), ' ')"
    inner = inner.selectExpr("lang", "f", f"explode(array({shorter})) AS phrase")
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    candidates = longer.join(inner, ["lang", "phrase"], "left").where("within IS NULL OR within < f").drop("within")
    # Every part asks for its count; short parts that many phrases share are asked for at one of several copies.
    parts = "flatten(transform(sequence(1, n_words - 1), k -> array(" + _part(1, "k", 1, "k") + ", " + _part(2, "k", "k + 1", "n_words - k") + ")))"
    asked = (
        candidates.select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
        .selectExpr("lang", "phrase", "n_words", "a", f"explode(concat(array({_part(0, 0, 1, 0)}), {parts})) AS p")
        .select("lang", "phrase", "n_words", "a", "p.side", "p.k", "p.part_words", "p.part")
        .withColumn("salt", F.expr(_by_words("pmod(xxhash64(phrase), {})", "0L")))
    )
    copies = F.explode(F.expr(_by_words("sequence(0L, {} - 1L)", "array(0L)"))).alias("salt")
    known = counts.select("lang", F.col("n_words").alias("part_words"), F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    known = known.select("*", copies)
    found = asked.join(known, ["lang", "part_words", "part", "salt"])

    def of(side: int, k: int, name: str):
        return F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("part_f"))).alias(name)

    cuts = range(1, policy.longest)
    both = found.groupBy("lang", "phrase", "n_words", "a").agg(of(0, 0, "n"), *[of(s, k, f"{'xlr'[s]}{k}") for k in cuts for s in (1, 2)])
    exact = "CAST({} AS DECIMAL(38,0))"
    score = "(1000BD * " + exact.format("a") + " * " + exact.format("n") + ") div (" + exact.format("l{k}") + " * " + exact.format("r{k}") + ")"
    best = ", ".join(f"IF(n_words > {k}, named_struct('score', {score.format(k=k)}, 'k', {k}, 'l', l{k}, 'r', r{k}), NULL)" for k in cuts)
    scored = both.select("lang", "phrase", "a", "n", F.expr(f"array_min(array({best}))").alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within shares of a language, so that no task sorts more than some of its phrases.
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    shares = scored.withColumn("share", share).withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    ranked = shares.where(F.col("place") <= policy.most).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= policy.most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
