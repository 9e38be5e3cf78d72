"""Language identification: script ranges, word scores and a Viterbi path with a switching penalty.

Learned are, for each language, the frequencies of byte n-grams of its words and the
scripts it is written in. A word's scores are the sums of its n-grams' log-probabilities in the
languages that use its script. The best path over a text's words, where a change of language
costs SWITCH, labels spans of one language; the text's language is that with most letters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import by_batch, distinct_words, flat, mixed, shipped, slices, words
from starmart.llm.token_counts import kinds

#: About so many rows of each language are in the sample that the model is fitted on; all of a language that has no more.
SAMPLE_DOCUMENTS = 20_000
BUCKETS = 1 << 16
#: Cost of a change of language, in natural log units.
SWITCH = 8.0
#: Share of a language's letters that makes a script one of its own.
SCRIPT_SHARE = 0.01
#: Words of a block of the Viterbi path.
BLOCK = 32
UNKNOWN = "und"

# First code points of Unicode ranges, and the script that holds from there on.
_RANGES = [
    (0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"),
    (0x700, "Syriac"), (0x780, "Thaana"), (0x7C0, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Gurmukhi"),
    (0xA80, "Gujarati"), (0xB00, "Oriya"), (0xB80, "Tamil"), (0xC00, "Telugu"), (0xC80, "Kannada"), (0xD00, "Malayalam"),
    (0xD80, "Sinhala"), (0xE00, "Thai"), (0xE80, "Lao"), (0xF00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2C00, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x2DE0, "Cyrillic"), (0x2E00, "Other"), (0x2E80, "Han"),
    (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Han"),
    (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"),
    (0xD7FC, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFEFF, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"),
]
SCRIPTS = sorted({s for _, s in _RANGES})
_FROM = np.array([c for c, _ in _RANGES])
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in _RANGES], np.uint8)


@dataclass
class Words:
    """The distinct words of some texts: n-gram buckets with the word of each, letters, main script; and every word's place."""

    gram_bucket: np.ndarray
    gram_word: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    place: np.ndarray
    first: np.ndarray


def _read(texts: pa.Array) -> Words:
    data, begins = flat(pc.utf8_lower(texts))
    starts, ends, first = words(data, begins)
    distinct, place = distinct_words(data, starts, ends)
    count = len(distinct)
    spelled, offsets = flat(distinct)
    # " word word word ": each word has a space on either side.
    buffer = np.full(len(spelled) + count + 4, 32, np.uint8)
    at = offsets[:-1] + np.arange(count) + 1
    owner = np.repeat(np.arange(count), np.diff(offsets))
    buffer[np.arange(len(spelled)) + owner + 1] = spelled
    owners = np.full(len(buffer), -1, np.int64)
    owners[np.arange(len(spelled)) + owner + 1] = owner
    wide = buffer.astype(np.uint64)
    buckets, holders = [], []
    for size in (3, 4):
        n = len(buffer) - size + 1
        value = np.full(n, size, np.uint64)
        for k in range(size):
            value = (value << np.uint64(8)) | wide[k : k + n]
        inner = np.ones(n, bool)
        for k in range(1, size - 1):
            inner &= buffer[k : k + n] != 32
        buckets.append((mixed(value[inner]) & np.uint64(BUCKETS - 1)).astype(np.int64))
        holders.append(owners[1 : n + 1][inner])
    bucket, holder = np.concatenate(buckets), np.concatenate(holders)
    keep = holder >= 0
    bucket, holder = bucket[keep], holder[keep]
    points = np.frombuffer(spelled.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    point_word = owner[np.flatnonzero((spelled & 0xC0) != 0x80)]
    is_letter = kinds()[points] == 0
    letter_word = point_word[is_letter]
    scripts = _SCRIPT[np.searchsorted(_FROM, points[is_letter], "right") - 1].astype(np.int64)
    by_script = np.bincount(letter_word * len(SCRIPTS) + scripts, minlength=count * len(SCRIPTS)).reshape(count, len(SCRIPTS))
    return Words(bucket, holder, by_script.sum(axis=1), by_script.argmax(axis=1), place, first)


@dataclass
class Model:
    """languages (sorted), log-probabilities [bucket, language], and which scripts a language uses [script, language]."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray

    def word_scores(self, w: Words) -> np.ndarray:
        scores = np.zeros((len(w.letters), len(self.languages)))
        for j in range(len(self.languages)):
            scores[:, j] = np.bincount(w.gram_word, weights=self.logs[w.gram_bucket, j], minlength=len(w.letters))
        candidates = self.scripts[w.script]
        none = ~candidates.any(axis=1) | (w.letters == 0)  # says nothing
        return np.where(none[:, None], 0.0, np.where(candidates, scores, -1e4))


def fit(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Learns from text and lang of about `sample` rows of each language at most, chosen by a hash of their id (of their
    text where it is null); all rows of a language that has no more. Their whole texts are counted.

    Rows whose text or lang is null are not used. The counts that come back have at
    most languages * (BUCKETS + scripts) rows.
    """
    docs = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    large = {r["lang"]: int(1_000_000 * sample / r["n"]) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") > sample).collect()}
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), F.lit(11)), F.lit(1_000_000))
    rate = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("lang")] if large else F.lit(None).cast("int")
    chosen = docs.where(draw < F.coalesce(rate, F.lit(1_000_000)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                total = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                for part in slices(own):
                    w = _read(part.column("text"))
                    often = np.bincount(w.place, minlength=len(w.letters))
                    total[:BUCKETS] += np.bincount(w.gram_bucket, weights=often[w.gram_word], minlength=BUCKETS).astype(np.int64)
                    total[BUCKETS:] += np.bincount(w.script, weights=often * w.letters, minlength=len(SCRIPTS)).astype(np.int64)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])], names=["lang", "feature", "n"])

    shipped(docs.sparkSession)
    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, feature long, n long")
    rows: pd.DataFrame = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[rows["feature"], rows["lang"].map({x: j for j, x in enumerate(languages)})] = rows["n"]
    grams, letters = counts[:BUCKETS] + 0.1, counts[BUCKETS:]
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1))


def _step(scores: np.ndarray, switch: float) -> np.ndarray:
    """Before the next word: stay, or change to any language at the cost of `switch`."""
    return np.maximum(scores, scores.max(axis=-1, keepdims=True) - switch)


def best_path(emitted: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on its text's best path.

    Texts are cut into blocks of BLOCK words, or as many as there are languages, if that is more, so
    that a block's (max, +) matrix has no more numbers than its words have scores. It maps entry to
    exit scores; scores at the block edges follow from them block by block, and those
    inside from the edges, for all blocks at once.
    """
    n_words, k = emitted.shape
    block = max(BLOCK, k)
    n = np.diff(first)
    blocks = -(-n // block)
    block_first = np.concatenate([[0], np.cumsum(blocks)])
    total = int(block_first[-1])
    if not total:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(n)), n)
    inside = np.arange(n_words) - first[:-1][text]
    row, col = block_first[:-1][text] + inside // block, inside % block
    e = np.zeros((total, block, k))  # missing words of a last block say nothing
    e[row, col] = emitted
    several = np.repeat(blocks > 1, blocks)  # a text of one block needs no matrix
    slot = np.cumsum(several) - 1
    forth = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(int(several.sum()), axis=0)
    for t in range(block):
        forth = _step(forth, switch) + e[several, t, None, :]
    alpha, beta = np.zeros((total, k)), np.zeros((total, k))  # before the block's first word, after its last
    order = np.argsort(-blocks, kind="stable")
    for j in range(1, int(blocks.max())):
        live = order[: int(np.searchsorted(-blocks[order], -j, "left"))]
        at = block_first[live] + j
        alpha[at] = (alpha[at - 1][:, :, None] + forth[slot[at - 1]]).max(axis=1)
        back = block_first[live] + blocks[live] - 1 - j
        beta[back] = (forth[slot[back + 1]] + beta[back + 1][:, None, :]).max(axis=2)
    seen = np.empty((total, block, k))
    score = alpha
    for t in range(block):
        score = _step(score, switch) + e[:, t]
        seen[:, t] = score
    score = beta
    for t in reversed(range(block)):
        seen[:, t] += score
        score = _step(score + e[:, t], switch)
    return seen.argmax(axis=2)[row, col]


def _weights(labels: np.ndarray, letters: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.bincount(text * k + labels, weights=letters, minlength=(len(first) - 1) * k).reshape(-1, k)


def predicted(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, and `spans`: an array of (lang, first word, end word, exclusive).

    score is the share of the text's letters that lie in spans of lang_pred, in words of a script
    that some language uses: 0 where there are none; ties go to the language that sorts first. `und`, with score 0 and no spans, where the text is
    null or has no letter, or where nothing was learned. Each row by itself: null ids and
    repeated rows stay, other columns are not read; no rows give no rows.
    """
    names, k = model.languages, len(model.languages)
    span = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))

    def predict(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = _read(part.column("text"))
            n = part.num_rows
            best, score, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
            if k and len(w.place):
                labels = best_path(model.word_scores(w)[w.place], w.first, switch)
                weights = _weights(labels, w.letters[w.place], w.first, k)
                total = weights.sum(axis=1)
                known = np.where(model.scripts[w.script].any(axis=1), w.letters, 0)
                score = _weights(labels, known[w.place], w.first, k)[np.arange(n), weights.argmax(axis=1)] / np.maximum(total, 1)
                best = [names[j] if t else UNKNOWN for j, t in zip(weights.argmax(axis=1), total)]
                change = np.ones(len(labels), bool)
                change[1:] = labels[1:] != labels[:-1]
                change[w.first[:-1][np.diff(w.first) > 0]] = True
                at = np.flatnonzero(change)
                text = np.searchsorted(w.first, at, "right") - 1
                ends = np.append(at[1:], len(labels))
                for i, a, b, j in zip(text.tolist(), at.tolist(), ends.tolist(), labels[at].tolist()):
                    if total[i]:
                        spans[i].append({"lang": names[j], "first": a - int(w.first[i]), "end": b - int(w.first[i])})
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(best), pa.array(score), pa.array(spans, span)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first:long,end:long>>"
    return by_batch(docs.select("doc_id", "text"), predict, schema)


def fold(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 5; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """Learned from the rows of folds 1 to 4, predicted for all; `held_out` marks fold 0, `n_spans` counts the spans."""
    model = fit(docs.where(fold() != 0))
    return predicted(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
