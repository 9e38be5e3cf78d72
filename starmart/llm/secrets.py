"""Secret scan: fixed patterns, and a battery of randomness tests on long unbroken strings.

A candidate of the battery is a maximal run of at least MIN_CANDIDATE letters, digits
and `+/_-` that no pattern match overlaps. Its encoding follows from its characters (hex,
base32, base36, base62, base64). Three statistics are taken of it: chi-squared uniformity
over the alphabet, runs, and lag-1 serial correlation of the symbols' places in the alphabet.
Each is compared with two hypotheses:

* "random symbols of that encoding": a candidate that any statistic rejects (|z| > VETO) is no secret;
* "ordinary text", which gives the p-values under control: symbols so even by the corpus's
  frequencies, so many runs of lower case, upper case and digits, and neighbours so little
  correlated, where text stays in a kind of symbol. The three are combined by Stouffer's
  method, runs and correlation counted as fully dependent.

The p-values are controlled for false discoveries (Benjamini-Hochberg at level Q) within
each stratum of lengths, since long strings bring strong evidence and short ones are many.
Symbol frequencies and p-value counts are sums over the whole corpus; what comes back to
the driver has a fixed number of rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import by_batch, flat, slices, stored

# The base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

KINDS = ("assign", "access", "hex", "random")
MIN_CANDIDATE = 20
#: Lower bounds of the strata of lengths.
STRATA = (20, 28, 40, 64)
VETO = 3.5
Q = 0.01
#: Chance that text changes between lower case, upper case, digits and signs from one symbol to the next: in encodings
#: of one case (README2018), and in others (joinedWordsInOne, some/path).
ONE_CASE_CHANGE, CHANGE = 0.12, 0.35
#: P-values are counted in bins of a tenth of a decade, down to 1e-40.
_BINS_PER_DECADE, _MOST_BINS = 10, 400

_CHARS = np.zeros(256, np.uint8)
_CHARS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = 1
_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
_DIGITS, _UPPER, _LOWER = (frozenset(x) for x in (b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_ALPHABETS = {
    "hex": b"0123456789abcdef",
    "HEX": b"0123456789ABCDEF",
    "base32": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": b"0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def _runs(mask: np.ndarray, breaks: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true of at least `least`; a run never goes on over a place in `breaks`."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[breaks] = True
    before = np.concatenate([[False], mask[:-1]])
    after = np.concatenate([mask[1:], [False]])
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def encoding(s: bytes) -> str | None:
    """The smallest alphabet that the string suggests; None if it has one kind of symbol only."""
    symbols = set(s)
    has = [bool(symbols & kind) for kind in (_DIGITS, _UPPER, _LOWER)]
    if sum(has) < 2:
        return None  # plain numbers and plain words
    names = ["hex", "HEX", "base32", "base36", "BASE36"] if has[0] else []
    return next((n for n in [*names, "base62", "base64", "base64url"] if symbols <= set(_ALPHABETS[n])), None)


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(s: bytes, alphabet: bytes, frequencies: np.ndarray) -> float:
    """The p-value of `s` under ordinary text with these byte frequencies; 1 if randomness is rejected."""
    n, size = len(s), len(alphabet)
    place = {b: i for i, b in enumerate(alphabet)}
    x = np.array([place[b] for b in s], float)
    counts = np.bincount(x.astype(int), minlength=size)
    chi2 = float((counts**2).sum()) * size / n - n
    if abs(chi2 - (size - 1)) > VETO * math.sqrt(2 * (size - 1) * (n - 1) / n):
        return 1.0
    high = x >= size / 2
    n1 = int(high.sum())
    n2 = n - n1
    if not n1 or not n2:
        return 1.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * n1 * n2 / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    if spread <= 0 or abs(runs - mean) > VETO * math.sqrt(spread):
        return 1.0
    centred = x - x.mean()
    varied = max(float((centred**2).sum()), 1e-9)
    serial = float((centred[1:] * centred[:-1]).sum()) / varied
    if abs(serial * math.sqrt(n)) > VETO:
        return 1.0
    f = frequencies[list(alphabet)].astype(float) + 1e-3
    f /= f.sum()
    k2, k3 = float((f**2).sum()), float((f**3).sum())
    even = (size - 1 + (n - 1) * (size * k2 - 1) - chi2) / math.sqrt(2 * (size - 1) + 4 * (n - 1) * size**2 * max(k3 - k2**2, 0))
    kinds = np.array([0 if b in _DIGITS else 1 if b in _UPPER else 2 if b in _LOWER else 3 for b in s])
    changes = int((kinds[1:] != kinds[:-1]).sum())
    rate = CHANGE if _LOWER & place.keys() and _UPPER & place.keys() else ONE_CASE_CHANGE
    many_runs = (changes - 0.5 - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate))
    # In text neighbours are alike by what of the spread lies between kinds, as often as the kind stays.
    held = np.bincount(kinds, minlength=4)
    means = np.bincount(kinds, centred, 4) / np.maximum(held, 1)
    between = float((held * means**2).sum()) / varied
    stays = max(0.0, 1 - rate / max(1 - float(((held / n) ** 2).sum()), rate))
    uncorrelated = (between * stays - serial) * math.sqrt(n)
    # Runs and correlation both follow from the changes of kind: variance 1 + 2 * 2.
    return _tail((even + many_runs + uncorrelated) / math.sqrt(5))


def _matches(data: np.ndarray, begins: np.ndarray) -> tuple[list[list[tuple[int, int, int]]], np.ndarray]:
    """For each text its base spans (begin, kind, end) in bytes; and the code points before each byte."""
    whole = data.tobytes()
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(begins) - 1)]
    lower = whole.lower()

    def holders(text: bytes, keys: tuple[bytes, ...]) -> list[int]:
        at = []
        for key in keys:
            p = text.find(key)
            while p >= 0:
                i = int(np.searchsorted(begins, p, "right")) - 1
                at.append(i)
                p = text.find(key, int(begins[i + 1]) if p < begins[i + 1] else p + 1)
        return sorted(set(at))

    for i in holders(lower, KEYWORDS):
        for m in ASSIGN.finditer(whole, int(begins[i]), int(begins[i + 1])):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found[i].append((m.start(), 0, m.end()))
    for i in holders(whole, (b"AKIA",)):
        for m in ACCESS.finditer(whole, int(begins[i]), int(begins[i + 1])):
            if m.end() - m.start() >= MIN_ACCESS:
                found[i].append((m.start(), 1, m.end()))
    for low, high in zip(*_runs(_HEX[data], begins, MIN_HEX)):
        found[int(np.searchsorted(begins, low, "right")) - 1].append((int(low), 2, int(high)))
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return found, points


def _candidates(data: np.ndarray, begins: np.ndarray, found: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int]]]:
    """For each text the runs (begin, end) in bytes that have an encoding and that no base span overlaps."""
    runs: list[list[tuple[int, int]]] = [[] for _ in found]
    for low, high in zip(*(x.tolist() for x in _runs(_CHARS[data] > 0, begins, MIN_CANDIDATE))):
        i = int(np.searchsorted(begins, low, "right")) - 1
        if encoding(data[low:high].tobytes()) and not any(a < high and low < b for a, _, b in found[i]):
            runs[i].append((low, high))
    return runs


def _tested(symbols: bytes, frequencies: np.ndarray) -> tuple[int, int]:
    """A candidate's stratum and p-value bin (0: p = 1)."""
    p = battery(symbols, _ALPHABETS[encoding(symbols)], frequencies)
    return sum(len(symbols) >= x for x in STRATA) - 1, min(_MOST_BINS, int(-math.log10(max(p, 1e-300)) * _BINS_PER_DECADE))


_FOUND = "doc_id long, base array<struct<kind:int,low:long,high:long>>, tested array<struct<low:long,high:long,stratum:int,bin:int>>"


def _scanned(docs: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """For each row its base spans and its tested candidates, in code points."""
    span = pa.list_(pa.struct([("kind", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))
    candidate = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("stratum", pa.int32()), ("bin", pa.int32())]))

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            data, begins = flat(part.column("text"))
            found, points = _matches(data, begins)
            base, tested = [], []
            for spans, runs, origin in zip(found, _candidates(data, begins, found), points[begins[:-1]].tolist()):
                base.append([{"kind": k, "low": int(points[a]) - origin, "high": int(points[b]) - origin} for a, k, b in sorted(spans)])
                tested.append([])
                for a, b in runs:
                    stratum, bin_ = _tested(data[a:b].tobytes(), frequencies)
                    tested[-1].append({"low": int(points[a]) - origin, "high": int(points[b]) - origin, "stratum": stratum, "bin": bin_})
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(base, span), pa.array(tested, candidate)],
                names=["doc_id", "base", "tested"],
            )

    return by_batch(docs.select("doc_id", "text"), scan, _FOUND)


def symbol_frequencies(docs: DataFrame) -> np.ndarray:
    """How often each byte occurs in all texts; one row a task is added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(flat(part.column("text"))[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["byte", "n"])

    by_task = docs.select("text").mapInArrow(count, "byte int, n long")
    out = np.zeros(256, np.int64)
    for row in by_task.groupBy("byte").agg(F.sum("n").alias("n")).collect():  # 256 rows
        out[row.byte] = row.n
    return out


def least_bins(counts: dict[tuple[int, int], int]) -> dict[int, int]:
    """Per stratum the least p-value bin that Benjamini-Hochberg accepts at level Q; a bin's p is its upper edge."""
    out = {}
    for stratum in {s for s, _ in counts}:
        own = {b: n for (s, b), n in counts.items() if s == stratum}
        total, above = sum(own.values()), 0
        for b in sorted(own, reverse=True):
            above += own[b]
            if total * 10 ** (-b / _BINS_PER_DECADE) <= Q * above:
                out[stratum] = b
    return out


def _accepted(found: DataFrame) -> dict[int, int]:
    each = found.select(F.explode("tested").alias("c")).groupBy("c.stratum", "c.bin").count()
    return least_bins({(r.stratum, r.bin): r["count"] for r in each.collect()})  # bounded: strata x bins


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and `spans`, an array of (kind, low, high) in code points, by low and kind; kinds by their place in KINDS.

    A null or empty text has none. Null and repeated ids stay, each row is scanned by
    itself; no rows give no rows. Texts are read twice (for the frequencies and for the
    matches); found spans are stored once and never shuffled.
    """
    found = stored(_scanned(docs, symbol_frequencies(docs)), "secrets")
    accepted = _accepted(found)
    added = F.transform(
        F.filter("tested", lambda c: c.bin >= _least(accepted, c.stratum)),
        lambda c: F.struct(F.lit(KINDS.index("random")).alias("kind"), c.low.alias("low"), c.high.alias("high")),
    )
    ordered = F.array_sort(
        F.transform(F.concat("base", added), lambda x: F.struct(x.low.alias("low"), x.kind.alias("kind"), x.high.alias("high")))
    )
    return found.select("doc_id", ordered.alias("spans"))


def _least(accepted: dict[int, int], stratum: Column) -> Column:
    return F.coalesce(*[F.when(stratum == s, F.lit(b)) for s, b in accepted.items()], F.lit(_MOST_BINS + 1))


def written(spans: Column | str) -> Column:
    """An array of spans as `kind:start:end`, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.kind), x.low.cast("string"), x.high.cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of each base kind, the SHA-256 of the base spans and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base, counts = F.filter("spans", lambda x: x.kind < 3), [count(kind) for kind in range(3)]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))


def _masked(text: bytes, spans: list[tuple[int, int, int]], mask: bytes) -> bytes:
    """`text` with the spans (begin, kind, end) masked, overlapping ones together; of an assignment the value only."""
    hidden = []
    for low, kind, high in spans:
        match = ASSIGN.fullmatch(text, low, high) if kind == 0 else None
        hidden.append((match.start(2) if match else low, high))
    out, at = [], 0
    for low, high in sorted(hidden):
        if low >= at:
            out += [text[at:low], mask]
        at = max(at, high)
    return b"".join([*out, text[at:]])


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with all columns, each secret of `secret_spans` in `text` masked, and `n_chars` (where there is one) that of the new text.

    Null texts stay null. The texts are read a third time for it, and nothing is shuffled.
    """
    frequencies = symbol_frequencies(docs)
    accepted = _accepted(stored(_scanned(docs, frequencies), "secrets"))
    names = docs.columns

    def hide(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        valid = batch.column("text").is_valid()
        at = 0
        for part in slices(batch):
            data, begins = flat(part.column("text"))
            found, _ = _matches(data, begins)
            whole, texts = data.tobytes(), []
            for i, runs in enumerate(_candidates(data, begins, found)):
                low, spans = int(begins[i]), list(found[i])
                for a, b in runs:
                    stratum, bin_ = _tested(whole[a:b], frequencies)
                    if bin_ >= accepted.get(stratum, _MOST_BINS + 1):
                        spans.append((a, 3, b))
                text = whole[low : int(begins[i + 1])]
                texts.append(_masked(text, [(a - low, k, b - low) for a, k, b in spans], mask.encode()).decode())
            columns = dict(zip(names, part.columns))
            columns["text"] = pc.if_else(valid.slice(at, part.num_rows), pa.array(texts, columns["text"].type), None)
            if "n_chars" in columns:
                columns["n_chars"] = pc.if_else(pc.is_valid(columns["text"]), pc.utf8_length(columns["text"]).cast(columns["n_chars"].type), columns["n_chars"])
            at += part.num_rows
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return by_batch(docs, hide, docs.schema)
