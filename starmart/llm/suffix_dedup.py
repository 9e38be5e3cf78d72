"""Removal of repeated byte strings by maximal repeats of an enhanced suffix array.

Every string of LEAST bytes has an anchor: its KGRAM-byte substring of least hash. The
strings of a text that share an anchor's place make one span; equal strings of the corpus
have equal anchors. So:

1. Equal spans are found by their hashes, first within a task, then across tasks; all but
   the first are removed whole. What is sent is one row per distinct span and task.
2. Anchors that have several distinct spans (at the edges of repeats) get an enhanced
   suffix array over those spans' bytes. A stack scan of its common-prefix intervals
   yields the maximal repeats, left-extension diversity telling which are maximal to the
   left; each group has all its occurrences, and all but the first are removed.
3. An anchor whose counter holds more than a task's share of all spans (the middle of a
   line that a third of the documents have) would bring too many spans to one task of
   step 1. The strings of its spans are sent one by one, by the hash of their LEAST bytes.
4. A suffix array never has more than ARRAY_BYTES of spans. Where the distinct spans of one
   anchor have more, their strings are sent by hash as well: each string's places are
   a sorted stream, of which all but the first are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import _powers, flat, mixed, ranges, shipped, slices, span_hashes, stored
from starmart.llm.counters import places, summed

LEAST = 100
KGRAM = 32
#: Spans that a task sorts at once, and the most bytes of spans of one suffix array: its rows take about 45 times as much.
FLUSH, ARRAY_BYTES = 1 << 20, 1 << 18
#: Bytes of text whose anchors are looked for at once: some 150 bytes are held for each.
ANCHOR_BYTES = 1 << 18
#: A counter with more than this share of a part's spans is hot; no fewer spans than FEW are.
HOT_SHARE, FEW = 1 / 16, 2000

_SPAN = np.dtype([("anchor", "<u8"), ("hash", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("low", "<i8"), ("size", "<i4")])
_NO_ID = -(1 << 63)
#: So many repeated ids are looked up one by one; where there are more, all rows are told apart by their text.
REPEATED = 1000

Places = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _anchors(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last start of each run of LEAST-byte strings with one anchor place."""
    n, width = len(data), LEAST - KGRAM + 1
    none = np.zeros(0, np.int64)
    if n < LEAST:
        return none.astype(np.uint64), none, none
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    grams = mixed((sums[KGRAM:] - sums[:-KGRAM]) * down[: n - KGRAM + 1])
    least, reach = grams, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if rest := width - reach:
        least = np.minimum(least[:-rest], least[rest:])
    sizes = np.diff(begins)
    starts = ranges(begins[:-1], np.maximum(sizes - LEAST + 1, 0))
    if not len(starts):
        return none.astype(np.uint64), none, none
    value = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1) | (grams[starts[1:] - 1] == value[1:])
    at = np.flatnonzero(new)
    return value[at], starts[at], starts[np.append(at[1:], len(starts)) - 1]


def _spans(texts: pa.Array, ids: np.ndarray, ties: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The spans of the texts; those of hot anchors string by string."""
    data, begins = flat(texts)
    anchor, low, last = _anchors(data, begins)
    heated = hot[places(anchor)]
    single = ranges(low[heated], (last - low + 1)[heated])
    low, last = np.append(low[~heated], single), np.append(last[~heated], single)
    out = np.empty(len(low), _SPAN)
    out["hash"] = span_hashes(data, low, last + LEAST)
    out["anchor"] = np.append(anchor[~heated], mixed(out["hash"][len(low) - len(single) :]))
    text = np.searchsorted(begins, low, "right") - 1
    out["doc"], out["tie"], out["low"], out["size"] = ids[text], ties[text], low - begins[text], last - low + LEAST
    return out


def _first_of_each(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal spans once, the first by (doc, tie, low); and the later ones."""
    spans = spans[np.lexsort((spans["low"], spans["tie"], spans["doc"], spans["hash"], spans["anchor"]))]
    new = np.ones(len(spans), bool)
    new[1:] = (spans["anchor"][1:] != spans["anchor"][:-1]) | (spans["hash"][1:] != spans["hash"][:-1])
    at = np.flatnonzero(new)
    first = np.repeat(at, np.diff(np.append(at, len(spans))))
    later = spans["low"] > spans["low"][first]
    for name in ("tie", "doc"):
        own, other = spans[name], spans[name][first]
        later = (own > other) | ((own == other) & later)
    return spans[at], spans[later]


def merged_intervals(doc: np.ndarray, tie: np.ndarray, low: np.ndarray, high: np.ndarray) -> Places:
    """The union of intervals of each document (doc, tie), ordered; touching ones become one."""
    if not len(doc):
        return doc, tie, low, high
    order = np.lexsort((low, tie, doc))
    doc, tie, low, high = doc[order], tie[order], low[order], high[order]
    # The furthest end so far within the document.
    change = np.ones(len(doc), bool)
    change[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    group = np.cumsum(change)
    step = np.int64(high.max()) + 1
    reach = np.maximum.accumulate(high + group * step) - group * step
    new = change.copy()
    new[1:] |= low[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], tie[at], low[at], reach[np.append(at[1:], len(doc)) - 1]


def common_prefix_intervals(prefix: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of each interval of a suffix array whose common prefix has at least `least` bytes.

    prefix[i]: what suffixes i - 1 and i have in common (0 for i = 0). A stack holds the open intervals.
    """
    long = prefix >= least
    edge = np.diff(np.concatenate([[0], long.astype(np.int8), [0]]))
    for begin, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        stack: list[tuple[int, int]] = []
        for i, value in enumerate([*prefix[begin:end].tolist(), 0], begin):
            left = i - 1
            while stack and stack[-1][0] > value:
                length, left = stack.pop()
                yield length, left, i - 1
            if value >= least and (not stack or stack[-1][0] < value):
                stack.append((value, left))


def maximal_repeats(pieces: list[bytes], groups: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The maximal repeats of at least `least` bytes among pieces of the same group.

    Returns for each suffix, in the order of the suffix array, its piece and its begin there, what it has in
    common with the one before, and the repeats as (length, first, last) in that order. A
    suffix shorter than `least` begins no repeat and is left out.
    """
    sizes = np.array([len(x) for x in pieces], np.int64)
    count = np.maximum(sizes - least + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), count)
    none = np.zeros(0, np.int64)
    if not len(piece):
        return none, none, none, []
    begin = ranges(np.zeros(len(pieces), np.int64), count)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.cumsum(sizes) - sizes
    remaining = sizes[piece] - begin
    width = int(remaining.max())
    rows = np.zeros((len(piece), width + 4), np.uint8)
    rows[:, :4] = groups[piece].astype(">u4").view(np.uint8).reshape(-1, 4)
    # A suffix is a row of its bytes: windows over the data, without an index for each byte.
    rows[:, 4:] = np.lib.stride_tricks.sliding_window_view(np.pad(data, (0, width)), width)[base[piece] + begin]
    rows[:, 4:][np.arange(width) >= remaining[:, None]] = 0
    order = np.argsort(rows.view(f"S{width + 4}").reshape(-1), kind="stable")
    rows, piece, begin, remaining = rows[order], piece[order], begin[order], remaining[order]
    prefix = np.zeros(len(piece), np.int64)
    same = rows[1:] == rows[:-1]
    prefix[1:] = np.where(same.all(axis=1), width + 4, same.argmin(axis=1)) - 4
    prefix[1:] = np.maximum(np.minimum(prefix[1:], np.minimum(remaining[1:], remaining[:-1])), 0)
    before = np.where(begin > 0, data[np.maximum(base[piece] + begin - 1, 0)].astype(np.int64), -1)
    changes = np.zeros(len(piece), np.int64)  # how often the byte before has changed, up to each suffix
    changes[1:] = np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))
    found = [x for x in common_prefix_intervals(prefix, least) if changes[x[2]] > changes[x[1]] or before[x[1]] < 0]
    return piece, begin, prefix, found


def _repeated(rows: list[tuple[int, int, int, int, bytes]]) -> Places:
    """Intervals (doc, tie, low, high) of the repeats in spans (anchor, doc, tie, low, bytes), without each repeat's first occurrence."""
    anchors: dict[int, int] = {}
    groups = np.array([anchors.setdefault(r[0], len(anchors)) for r in rows], np.int64)
    piece, begin, _, found = maximal_repeats([r[4] for r in rows], groups)
    doc = np.array([r[1] for r in rows], np.int64)[piece]
    tie = np.array([r[2] for r in rows], np.int64)[piece]
    low = np.array([r[3] for r in rows], np.int64)[piece] + begin
    covered = np.zeros(len(piece), np.int64)
    rank = np.empty(len(piece), np.int64)  # by place; equal places (a repeated row) share a rank
    order = np.lexsort((low, tie, doc))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in (doc[order], tie[order], low[order]):
        new[1:] |= x[1:] != x[:-1]
    rank[order] = np.cumsum(new)
    for length, a, b in found:
        own = rank[a : b + 1]
        part = covered[a : b + 1]
        np.maximum(part, length, out=part, where=own > own.min())
    at = covered > 0
    return merged_intervals(doc[at], tie[at], low[at], low[at] + covered[at])


def _removed(held: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    return _found(*_repeated(held)).select(["doc", "tie", "low", "high"])


def _too_large(firsts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the distinct spans share their anchor with others, and which of all have an anchor whose spans exceed `most` bytes."""
    _, at, n = np.unique(firsts["anchor"], return_inverse=True, return_counts=True)
    return n[at] > 1, np.bincount(at, firsts["size"], len(n))[at] > most


def compared(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """What to remove of sorted rows (anchor, doc, tie, low, bytes), in suffix arrays of at most `most` bytes of spans.

    Where bytes is null, the row is one string of LEAST bytes whose hash is the anchor.
    """
    held: list[tuple[int, int, int, int, bytes]] = []
    size, last, first = 0, None, None
    begin = 0  # of the last anchor's rows
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        later = []
        for row in zip(*columns):
            if row[4] is None:
                if first is None or row[0] != first[0]:
                    first = row
                elif row[1:4] != first[1:4]:
                    later.append(row[1:4])
                continue
            if row == last:  # the same row again
                continue
            if last is not None and row[0] != last[0]:
                begin = len(held)
            if begin and size + len(row[4]) > most:  # the whole anchors before this one
                yield _removed(held[:begin])
                held, begin = held[begin:], 0
                size = sum(len(r[4]) for r in held)
            held.append(row)
            last = row
            size += len(row[4])
        if later:
            doc, tie, low = np.array(later, np.int64).T
            yield _found(*merged_intervals(doc, tie, low, low + LEAST)).select(["doc", "tie", "low", "high"])
    if held:
        yield _removed(held)


_MESSAGE = "part int, kind int, data binary"
_FOUND = "doc long, tie long, low long, high long, anchor long, hash long, single boolean"


def _key(docs: DataFrame) -> list[Column]:
    """doc and tie of each row: the id, and a hash of the text where the id is null or on several rows, else 0."""
    doc = F.col("doc_id").cast("long")
    ids = docs.select(doc.alias("id")).where("id IS NOT NULL").groupBy("id").count().where("count > 1")
    repeated = [r.id for r in ids.limit(REPEATED + 1).collect()]
    tied = F.lit(True) if len(repeated) > REPEATED else doc.isNull() | doc.isin(repeated) if repeated else doc.isNull()
    return [F.coalesce(doc, F.lit(_NO_ID)).alias("doc"), F.when(tied, F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("tie")]


def removals(docs: DataFrame, key: list[Column]) -> DataFrame:
    """(doc, tie, ranges) with the byte ranges (low, high) to remove from each document that has any, in no order.

    key: doc and tie, as `_key` gives them. Documents follow each other by both, those without id
    first. Rows of one id (or none) with the same text are at the same place, so neither removes the other.
    """
    spark = shipped(docs.sparkSession)
    rows = docs.select(*key, "text").where("text IS NOT NULL")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counters = summed(rows, lambda texts: _anchors(*flat(texts))[0], ANCHOR_BYTES)
    most = ARRAY_BYTES
    hot = counters > max(FEW, HOT_SHARE * counters.sum() / parts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch, most=ANCHOR_BYTES):
                held.append(_spans(part.column("text"), np.asarray(part.column("doc")), np.asarray(part.column("tie")), hot))
                if sum(map(len, held)) >= FLUSH:
                    yield messages(held)
        if held:
            yield messages(held)

    def messages(held: list[np.ndarray]) -> pa.RecordBatch:
        spans = np.concatenate(held)
        held.clear()
        firsts, later = _first_of_each(spans)
        del spans
        to = (mixed(firsts["anchor"] + np.uint64(1)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((firsts["low"], firsts["tie"], firsts["doc"], to))
        firsts, to = firsts[order], to[order]
        edges = np.searchsorted(to, np.arange(parts + 1))
        out = [(p, 0, _packed(firsts[a:b])) for p, a, b in zip(range(parts), edges[:-1], edges[1:]) if b > a]
        found = np.stack(merged_intervals(later["doc"], later["tie"], later["low"], later["low"] + later["size"]))
        to = (mixed((found[0] ^ found[1]).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        for p in np.unique(to).tolist():
            out.append((p, 1, found[:, to == p].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["part", "kind", "data"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, spans = None, []
        for batch in batches:
            for p, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind == 1:
                    yield _found(*np.frombuffer(data, np.int64).reshape(4, -1))
                    continue
                if p != part and spans:
                    yield from decided(np.concatenate(spans))
                    spans = []
                part = p
                spans.append(_unpacked(data))
        if spans:
            yield from decided(np.concatenate(spans))

    def decided(spans: np.ndarray) -> Iterator[pa.RecordBatch]:
        firsts, later = _first_of_each(spans)
        yield _found(*merged_intervals(later["doc"], later["tie"], later["low"], later["low"] + later["size"]))
        shared, single = _too_large(firsts, most)
        asked = firsts[shared]
        yield _found(asked["doc"], asked["tie"], asked["low"], asked["low"] + asked["size"], asked["anchor"], asked["hash"], single[shared])

    sent = rows.mapInArrow(send, _MESSAGE).repartition(parts // 4, "part").sortWithinPartitions("part", "kind")
    found = stored(sent.mapInArrow(receive, _FOUND), "repeats")
    ranges_found = found.where("anchor IS NULL").select("doc", "tie", "low", "high")
    asked = found.where("anchor IS NOT NULL").groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "hash", "low", "high", "single")).alias("spans"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, begins = flat(part.column("text"))
                whole = data.tobytes()
                lists = part.column("spans")
                span = lists.flatten()
                text = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(lists)))
                anchor, hashed, low, high, single = (np.asarray(span.field(i).to_numpy(zero_copy_only=False)) for i in range(5))
                # A row whose text only hashes alike is none of the span's.
                fits = begins[:-1][text] + high <= begins[1:][text]
                a, b = (begins[:-1][text] + low)[fits], (begins[:-1][text] + high)[fits]
                fits[fits] = span_hashes(data, a, b) == hashed[fits].astype(np.uint64)
                spanned, alone = np.flatnonzero(fits & ~single), np.flatnonzero(fits & single)
                count = (high - low)[alone] - LEAST + 1
                at, begin = np.repeat(alone, count), ranges(low[alone], count)
                string = begins[:-1][text[at]] + begin
                sent = np.append(spanned, at)
                a = begins[:-1][text[spanned]]
                cut = [whole[x:y] for x, y in zip((a + low[spanned]).tolist(), (a + high[spanned]).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(anchor[spanned], mixed(span_hashes(data, string, string + LEAST)).astype(np.int64))),
                        *(part.column(c).take(pa.array(text[sent])) for c in ("doc", "tie")),
                        pa.array(np.append(low[spanned], begin)), pa.array(cut + [None] * len(at), pa.binary()),
                    ],
                    names=["anchor", "doc", "tie", "low", "bytes"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from compared(batches, most)

    edges = rows.join(asked, ["doc", "tie"]).select("doc", "tie", "text", "spans").mapInArrow(fetch, "anchor long, doc long, tie long, low long, bytes binary")
    edges = edges.repartition("anchor").sortWithinPartitions("anchor", "doc", "tie", "low").mapInArrow(compare, "doc long, tie long, low long, high long")
    return ranges_found.union(stored(edges, "edges")).groupBy("doc", "tie").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def _packed(spans: np.ndarray) -> bytes:
    """Column after column, ids and places as differences: they compress well in the shuffle."""
    doc = np.diff(spans["doc"], prepend=np.int64(0))
    return b"".join([spans["anchor"].tobytes(), spans["hash"].tobytes(), doc.tobytes(), spans["tie"].tobytes(), spans["low"].tobytes(), spans["size"].tobytes()])


def _unpacked(data: bytes) -> np.ndarray:
    n = len(data) // _SPAN.itemsize
    out, at = np.empty(n, _SPAN), 0
    for name in _SPAN.names:
        kind = _SPAN[name]
        out[name] = np.frombuffer(data, kind, n, at)
        at += n * kind.itemsize
    out["doc"] = np.cumsum(out["doc"])
    return out


def _found(doc: np.ndarray, tie: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray | None = None, hashed: np.ndarray | None = None, single: np.ndarray | None = None) -> pa.RecordBatch:
    extra = [pa.nulls(len(doc), pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (anchor, hashed)]
    extra.append(pa.nulls(len(doc), pa.bool_()) if single is None else pa.array(single))
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, tie, low, high)] + extra, names=["doc", "tie", "low", "high", "anchor", "hash", "single"])


def _with_ranges(docs: DataFrame) -> DataFrame:
    """`row` (all columns of `docs`) and `ranges`."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = _key(docs)
    return docs.select(*key, row).join(removals(docs, key), ["doc", "tie"], "left").drop("doc", "tie")


def _cut(text: bytes, found: list[dict] | None) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal removed runs, and the bytes that stay."""
    if not found:
        return [], text
    spans = np.array([(r["low"], r["high"]) for r in found], np.int64)
    same = np.zeros(len(spans), np.int64)
    _, _, low, high = merged_intervals(same, same, spans[:, 0], spans[:, 1])
    runs = list(zip(low.tolist(), np.minimum(high, len(text)).tolist()))
    edges = [0, *(x for run in runs for x in run), len(text)]
    return runs, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _spannedpoints(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """What stays of the text if runs are cut, but no code point is cut in two."""
    out, at = [], 0
    for low, high in runs:
        while low < high and text[low] & 0xC0 == 0x80:
            low += 1
        while high < len(text) and high > low and text[high] & 0xC0 == 0x80:
            high -= 1
        out.append(text[at:low])
        at = high
    return b"".join([*out, text[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with all columns, the repeated strings cut from `text` and `n_chars` (where there is one) that of the new text.

    Code points that a run covers in part stay. A text of which nothing but white space stays
    goes with its row; texts that were so before stay.
    """
    names, schema = docs.columns, docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column("row").flatten()))
            texts, stays = [], []
            for text, found in zip(columns["text"].to_pylist(), batch.column("ranges").to_pylist()):
                data = (text or "").encode()
                kept = _spannedpoints(data, _cut(data, found)[0])
                texts.append(None if text is None else kept.decode())
                stays.append(len(kept) == len(data) or bool(kept.strip()))
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                columns["n_chars"] = pc.if_else(pc.is_valid(columns["text"]), pc.utf8_length(columns["text"]).cast(columns["n_chars"].type), columns["n_chars"])
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names).filter(pa.array(stays))

    return _with_ranges(docs).mapInArrow(cut, schema)


def removed_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: what repeated strings of LEAST bytes take from each text.

    A null or empty text has no bytes, and one shorter than LEAST loses none. Rows without
    id come before all others. Rows of one id, or without, follow each other by a hash of their text. No rows give no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                data = (text or "").encode()
                runs, kept = _cut(data, found)
                out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in columns[:3]], pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = _with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("row.doc_id", "row.text", "ranges")
    return rows.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
