"""Packing of token sequences into as few bins as possible: best fit, then a swap-based local search.

Texts are tokenized and cut in one pass; only the pieces' lengths are shuffled, dealt
into groups of bounded tokens and pieces by a hash. Each group is packed on its own: best fit
decreasing, then pieces are moved and exchanged one for one and two for one between
underfull bins whenever that makes the sum of squared fills larger, until the least
filled bins are empty. Each group's least filled bin is opened again and packed with those
of the other groups.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import by_batch, shipped, slices, stored
from starmart.llm.word_ids import word_ids

#: Full bins and pieces of one packing group, at most, but for the unevenness of a hash.
GROUP_BINS, GROUP_PIECES = 4096, 8192

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, end: int = 0) -> DataFrame:
    """Rows of PIECES: each document's ids, then the id `end`, cut every `capacity` ids.

    A null or empty text has the one id `end`. A null id and repeated ids stay; each row
    is cut by itself. No rows give no rows.
    """

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
        for part in slices(batch):
            ids, begins = word_ids(path).encode(part.column("text"))
            n = np.diff(begins)
            whole = np.full(len(ids) + len(n), end, np.uint32)
            at = begins + np.arange(len(begins))  # with the ends between
            inner = np.ones(len(whole), bool)
            inner[at[1:] - 1] = False
            whole[inner] = ids
            data = whole.astype("<u4").tobytes()
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for i, (low, high) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                for piece, begin in enumerate(range(low, high, capacity)):
                    stop = min(begin + capacity, high)
                    rows.append(i)
                    pieces.append(piece)
                    starts.append(begin - low)
                    lengths.append(stop - begin)
                    sums.append(zlib.crc32(data[4 * begin : 4 * stop]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (starts, lengths, sums)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return by_batch(docs.select("doc_id", "text"), cut, PIECES)


class Bins:
    """Bins of one group: for each, its pieces as sorted (length, index), and its fill."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.items, self.fill = capacity, [], []

    def best_fit(self, lengths: np.ndarray) -> None:
        """Longest first into the fullest bin with room."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # open bins by what is free
        free: list[int] = []  # the occurring rooms, ascending
        for index in np.argsort(-lengths, kind="stable").tolist():
            size = int(lengths[index])
            k = bisect_left(free, size)
            if k < len(free):
                was = free[k]
                at = room[was].pop()
                if not room[was]:
                    free.pop(k)
            else:
                was, at = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[at].append((size, index))
            self.fill[at] += size
            if was > size:
                if not room[was - size]:
                    insort(free, was - size)
                room[was - size].append(at)
        for x in self.items:
            x.sort()

    def _exchange(self, a: int, give: list[tuple[int, int]], b: int, take: list[tuple[int, int]]) -> None:
        for one, other, moved in ((a, b, give), (b, a, take)):
            for x in moved:
                self.items[one].remove(x)
                insort(self.items[other], x)
                self.fill[one] -= x[0]
                self.fill[other] += x[0]

    def _improve(self, a: int, b: int) -> bool:
        """The exchange that brings most from bin a into the fuller bin b; whether there is one.

        What b gains is at most what it has free. As b is the fuller one, any gain
        makes the sum of squared fills larger.
        """
        gap, ours, theirs = self.capacity - self.fill[b], self.items[a], self.items[b]
        best: tuple[int, list, list] = (0, [], [])
        sizes = [x[0] for x in ours]
        k = bisect_right(sizes, gap) - 1
        if k >= 0:  # a move
            best = (sizes[k], [ours[k]], [])
        for y in [(0, -1), *theirs]:
            if best[0] == gap:
                break
            k = bisect_right(sizes, y[0] + gap) - 1
            if y[1] >= 0 and k >= 0 and sizes[k] - y[0] > best[0]:
                best = (sizes[k] - y[0], [ours[k]], [y])
            low, high = 0, len(ours) - 1  # two of ours for y, or for nothing
            while low < high:
                both = sizes[low] + sizes[high] - y[0]
                if both > gap:
                    high -= 1
                else:
                    if both > best[0]:
                        best = (both, [ours[low], ours[high]], [y] if y[1] >= 0 else [])
                    low += 1
        if best[0] > 0:
            self._exchange(a, best[1], b, best[2])
        return best[0] > 0

    def search(self) -> None:
        """Exchanges between underfull bins, the least filled bin giving, until no exchange helps.

        Each exchange makes the sum of squared fills, which is bounded, larger, so it ends.
        """
        open_bins = sorted((i for i, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda i: (self.fill[i], i))
        while len(open_bins) > 1:
            a, moved = open_bins[0], False
            for b in reversed(open_bins[1:]):
                while self.fill[a] and self.fill[b] < self.capacity and self.fill[a] <= self.fill[b] and self._improve(a, b):
                    moved = True
            if self.fill[a] and not moved:
                open_bins.pop(0)  # nothing leaves it any more
            open_bins = sorted((i for i in open_bins if 0 < self.fill[i] < self.capacity), key=lambda i: (self.fill[i], i))


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each piece its bin and its offset there."""
    bins = Bins(capacity)
    bins.best_fit(lengths)
    bins.search()
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for n, items in enumerate(x for x in bins.items if x):
        at = 0
        for size, index in items:
            where[index], offset[index] = n, at
            at += size
    return where, offset


def packed(pieces: DataFrame, groups: int, capacity: int = 2048, turn: int = 0) -> DataFrame:
    """`pieces` with `sequence_id`, `offset` (long) and `open`, whether the sequence is the least filled one of its group.

    Sequences are numbered within `groups` groups and the `turn`. Rows are dealt by themselves, equal ones too, so
    `pieces` is a stored table whose parts are the same when a task runs again.
    """

    def one_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        where, offset = pack(rows["length"].to_numpy(), capacity)
        fills = np.bincount(where, rows["length"])
        rows["sequence_id"] = (turn << 56) + rows["group"] * (1 << 32) + where
        rows["offset"] = offset
        rows["open"] = (where == fills.argmin()) & (fills.min() < capacity)
        return rows.drop(columns="group")

    shipped(pieces.sparkSession)
    row = F.monotonically_increasing_id()
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", row), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(one_group, f"{PIECES}, sequence_id long, offset long, open boolean")


def group_count(pieces: DataFrame, capacity: int = 2048) -> int:
    """Groups of about GROUP_BINS full bins or GROUP_PIECES pieces, whichever are more groups."""
    n, tokens = pieces.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return max(-(-n // GROUP_PIECES), -(-tokens // (GROUP_BINS * capacity)), 1)


def packed_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Rows of PIECES with `sequence_id` and `offset`, packed in turns: each takes the least filled bins of the groups before."""
    pieces, done, turn = stored(pieces, "pieces"), None, 0
    groups, before = group_count(pieces, capacity), None
    while before is None or groups < before:
        placed = packed(pieces, groups, capacity, turn)
        if groups == 1:
            break
        placed = stored(placed, "placed")
        opened = placed.where("open").select(*pieces.columns)
        before, groups = groups, group_count(opened, capacity)
        if groups < before:
            closed = placed.where("NOT open")
            done = closed if done is None else done.union(closed)
            pieces, turn = opened, turn + 1
    return (placed if done is None else done.union(placed)).drop("open")


def packed_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """All documents tokenized, cut and packed; see `token_pieces` and `packed_pieces`."""
    return packed_pieces(token_pieces(docs, capacity, vocabulary), capacity)
