"""Ranked lexical search: the best documents of every item, by a search over two trees.

Items and documents are vectors over the items' terms: an item's holds how often it has a term, a document's what
an occurrence of the term is worth in it. Nodes of either tree hold the coordinate maxima of what is below them, so the
product of two nodes bounds every score between them. A pair of nodes whose bound is below the
weakest k-th score among the node's items is left out as a whole; no other pair is, so results are exact.
Each task searches the documents of its partition in trees of a bounded size, best pairs first, and brings at
most k rows an item; these are ranked in the end. Items come in blocks of bounded size, each broadcast with its terms.

Documents: null texts and texts without a term score nothing; rows are documents, so repeated rows and ids stand side
by side; rows without doc_id come last among equal scores. Items: null and term-less ones give no rows, repeated ones are
items of their own. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from starmart.llm.common import distinct_words, flat, gathered, lowered, shipped, words

#: Items, and bytes of their texts, that are searched for at once.
BLOCK_ITEMS, BLOCK_BYTES = 1024, 1 << 22
#: Coordinates of the documents of one tree, together; children of a node.
TREE_CELLS, CHILDREN = 1 << 22, 8
_TEXT_BYTES = 1 << 23
_NONE = np.iinfo(np.int64).max
# Bytes of terms: ASCII letters and digits, and all of characters beyond ASCII.
_INSIDE = np.array([c > 127 or chr(c).isalnum() for c in range(256)])


@dataclass(frozen=True)
class Ranking:
    """How many documents an item gets, and the constants of the score: weights are scaled by 1000, k1 is 1.2, b is 0.25."""

    most: int = 20


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of the texts (A-Z as a-z), the term of each occurrence by its place there, and each text's first occurrence."""
    data, begins = flat(texts)
    data = lowered(data)
    starts, ends, first = words(data, begins, inside=_INSIDE[data])
    distinct, at = distinct_words(data, starts, ends)
    return distinct.cast(pa.binary()), at, first


def _counted(places: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, occurrences) of the places (below `size`; -1: none) of texts."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    known = places >= 0
    keys, counts = np.unique(text[known] * np.int64(size) + places[known], return_counts=True)
    return keys // size, keys % size, counts


def _grouped(row: np.ndarray, place: np.ndarray, worth: np.ndarray, size: int) -> np.ndarray:
    """An order of the `size` rows of a sparse matrix that puts those with the same heaviest coordinates side by side."""
    order = np.lexsort((place, -worth, row))
    row, place = row[order], place[order]
    first = np.searchsorted(row, np.arange(size))
    heaviest = []
    for step in (0, 1):
        at = np.minimum(first + step, len(row) - 1)
        heaviest.append(np.where(row[at] == np.arange(size), place[at], -1))
    return np.lexsort((heaviest[1], heaviest[0]))


class Tree:
    """Rows in groups of CHILDREN, these in groups again, up to one root; each node with its rows' coordinate maxima."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.levels = []  # from the leaves up
        below = rows
        while not self.levels or len(below) > 1:
            below = np.maximum.reduceat(below, np.arange(0, len(below), CHILDREN), axis=0)
            self.levels.append(below.astype(np.float64))

    def children(self, level: int, node: int) -> range:
        """The nodes one level below (the rows, below the leaves)."""
        size = len(self.levels[level - 1]) if level else len(self.rows)
        return range(node * CHILDREN, min((node + 1) * CHILDREN, size))


class Best:
    """The best documents of every item so far: by score, then by id, those without an id last."""

    def __init__(self, items: int, most: int) -> None:
        self.score = np.zeros((items, most), np.int64)  # 0: none yet
        self.doc = np.full((items, most), _NONE)
        self.named = np.zeros((items, most), bool)

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, named: np.ndarray) -> None:
        last = self.score[item, -1]
        good = (score > last) | ((score == last) & (score > 0) & (doc <= self.doc[item, -1]))
        if good.any():
            score, doc, named = (np.append(a[item], b[good]) for a, b in ((self.score, score), (self.doc, doc), (self.named, named)))
            order = np.lexsort((~named, doc, -score))[: self.score.shape[1]]
            self.score[item], self.doc[item], self.named[item] = score[order], doc[order], named[order]


class Items:
    """A block of items: their terms with weights, and their tree; ready to search documents."""

    def __init__(self, vocabulary: pa.Array, weight: np.ndarray, vectors: np.ndarray, numbers: np.ndarray, n_docs: int, n_terms: int) -> None:
        """`vectors`: occurrences of each term (column) in each item (row); `numbers`: the items' own numbers."""
        item, place = np.nonzero(vectors)
        order = _grouped(item, place, (vectors * weight)[item, place], len(vectors))
        self.vocabulary, self.weight, self.numbers = vocabulary, weight, numbers[order]
        self.n_docs, self.n_terms = n_docs, n_terms
        self.tree = Tree(vectors[order])
        # The terms that occur below each node: all others count nothing there.
        self.columns = [[np.flatnonzero(node) for node in level] for level in self.tree.levels]

    def worth(self, text: np.ndarray, place: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a term is worth in a text, for each (text, place, occurrences)."""
        if 25 * int(sizes.max(initial=0)) * self.n_docs < 1 << 63:
            lengths = (25 * sizes * self.n_docs) // self.n_terms
        else:
            lengths = np.array([25 * n * self.n_docs // self.n_terms for n in sizes.tolist()], np.int64)
        m = 75 + lengths[text]
        return self.weight[place] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))

    def search(self, docs: pa.RecordBatch, best: Best) -> None:
        """Enters the documents (doc_id, text) that are among an item's best so far."""
        distinct, at, first = terms(docs.column("text"))
        place = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=self.vocabulary), -1)).astype(np.int64)[at]
        text, place, tf = _counted(place, first, len(self.vocabulary))
        worth = self.worth(text, place, tf, np.diff(first))
        held, row = np.unique(text, return_inverse=True)
        ids = docs.column("doc_id")
        named = np.asarray(ids.is_valid())[held]
        ids = np.asarray(pc.fill_null(ids, _NONE))[held]
        most = max(CHILDREN, TREE_CELLS // len(self.vocabulary))
        for low in range(0, len(held), most):
            high = min(low + most, len(held))
            some = (row >= low) & (row < high)
            vectors = np.zeros((high - low, len(self.vocabulary)), np.int64)
            vectors[row[some] - low, place[some]] = worth[some]
            order = _grouped(row[some] - low, place[some], worth[some], high - low)
            self._pairs(Tree(vectors[order]), ids[low:high][order], named[low:high][order], best)

    def _pairs(self, docs: Tree, ids: np.ndarray, named: np.ndarray, best: Best) -> None:
        """Both trees downwards from their roots; the pair with the largest bound first."""
        rows = self.tree.rows
        stack = [(math.inf, len(self.tree.levels) - 1, 0, len(docs.levels) - 1, 0)]
        while stack:
            bound, i_level, i, d_level, d = stack.pop()
            width = CHILDREN ** (i_level + 1)
            if bound < max(1, best.score[i * width : (i + 1) * width, -1].min()):
                continue
            columns = self.columns[i_level][i]
            if not i_level and not d_level:
                of, to = self.tree.children(0, i), docs.children(0, d)
                scores = rows[of.start : of.stop, columns] @ docs.rows[to.start : to.stop, columns].T
                for item, score in zip(of, scores):
                    best.add(item, score, ids[to.start : to.stop], named[to.start : to.stop])
                continue
            # The tree that is further from its leaves goes down, both if they are even.
            down_i, down_d = i_level and i_level >= d_level, d_level and d_level >= i_level
            of = self.tree.children(i_level, i) if down_i else range(i, i + 1)
            to = docs.children(d_level, d) if down_d else range(d, d + 1)
            i_next, d_next = i_level - bool(down_i), d_level - bool(down_d)
            left = self.tree.levels[i_next][of.start : of.stop, columns]
            bounds = left @ docs.levels[d_next][to.start : to.stop, columns].T * (1 + 1e-9)  # doubles round
            for at in np.argsort(bounds, axis=None).tolist():
                a, b = divmod(at, len(to))
                stack.append((bounds[a, b], i_next, of.start + a, d_next, to.start + b))


def _statistics(docs: DataFrame, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms with repeats, and the documents that hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(len(vocabulary), np.int64), np.zeros(2, np.int64)
        for batch in gathered(batches, "text", _TEXT_BYTES):
            distinct, at, first = terms(batch.column("text"))
            place = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=vocabulary), -1)).astype(np.int64)[at]
            held += np.bincount(_counted(place, first, max(1, len(vocabulary)))[1], minlength=len(vocabulary))
            total += [(np.diff(first) > 0).sum(), len(at)]
        counts = np.concatenate([total, held])
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at - 2), pa.array(counts[at])], names=["place", "n"])

    rows = docs.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # a block's terms at most
    out = np.zeros(len(vocabulary) + 2, np.int64)
    for place, n in rows:
        out[place + 2] = n
    return int(out[0]), int(out[1]), out[2:]


def weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    """A term's weight, by the documents that hold it: floor(1000 * ln((2N + 2) / (2df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def blocks(items: DataFrame) -> Iterator[list]:
    """The (item_id, text) rows in runs of bounded number and size."""
    waiting, held = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        waiting.append(row)
        held += len((row.text or "").encode())
        if len(waiting) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
            yield waiting
            waiting, held = [], 0
    if waiting:
        yield waiting


def _block(docs: DataFrame, rows: list, ranking: Ranking) -> Items | None:
    """The items of a block that can score: their terms that some document holds, with weights above 0."""
    vocabulary, at, first = terms(pa.array([r.text or "" for r in rows], pa.string()))
    if not len(vocabulary):
        return None
    n_docs, n_terms, held = _statistics(docs, vocabulary)
    weight = np.where(held > 0, weights(n_docs, held), 0)
    useful = np.flatnonzero(weight > 0)
    text, place, times = _counted(at.astype(np.int64), first, len(vocabulary))
    vectors = np.zeros((len(rows), len(vocabulary)), np.int64)
    vectors[text, place] = times
    vectors = vectors[:, useful]
    scoring = np.flatnonzero(vectors.any(axis=1))
    if not len(scoring):
        return None
    return Items(vocabulary.take(pa.array(useful)), weight[useful], vectors[scoring], scoring, n_docs, n_terms)


def ranked(docs: DataFrame, items: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's `most` best documents with a score above 0, equal scores by doc_id."""
    spark = shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    id_type = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("item", T.LongType()), T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = [spark.createDataFrame([], schema)]
    for number, rows in enumerate(blocks(items)):
        block = _block(docs, rows, ranking)
        if block is None:
            continue
        names = pa.array([rows[i].item_id for i in block.numbers.tolist()], to_arrow_type(id_type))
        shared = spark.sparkContext.broadcast((block, names))  # BLOCK_ITEMS and BLOCK_BYTES at most

        def search(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            block, names = shared.value
            best = Best(len(names), ranking.most)
            for batch in gathered(batches, "text", _TEXT_BYTES):
                block.search(batch, best)
            item, place = np.nonzero(best.score)
            docs_ = pa.array(best.doc[item, place], mask=~best.named[item, place])
            columns = [pa.array(np.full(len(item), number, np.int32)), pa.array(block.numbers[item]), names.take(pa.array(item)), docs_, pa.array(best.score[item, place])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        found.append(docs.mapInArrow(search, schema))
    best_first = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    rows = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best_first))
    return rows.where(F.col("rank") <= ranking.most).select("item_id", "rank", "doc_id", "score")
