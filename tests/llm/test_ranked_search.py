"""Ranked search against plain scoring of every pair."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import ranked_search as s
from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def plain(docs, items, most):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        asked = Counter(terms_of(text))
        found = []
        for i, bag, n in bags:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, k in asked.items() if t in bag)
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(found[:most], 1)]
    return sorted(out, key=str)


def got(docs, items, most):
    return sorted((tuple(r) for r in s.ranked(docs, items, s.Ranking(most)).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    base = [prose(i % 37, 20 + (i * 13) % 160) for i in range(220)]
    odd = [None, "", " .,;", "one", "ONE Two two", "été ÉTÉ 🙂x naïve", "x" * 5000, prose(3, 40000), "a_b-c'd", "\x00tab\x7fend"]
    return [(i, t) for i, t in enumerate(base + odd)] + [(3, base[3]), (None, base[5]), (None, base[6]), (None, None), (7, base[5])]


@pytest.fixture(scope="module")
def asked():
    items = [(i, prose(i % 41, 5 + i % 9)) for i in range(60)]
    return items + [(100, None), (101, ""), (102, "nowhere found zzzz"), (103, "one ONE two été"), (None, prose(2, 6)), (5, prose(8, 4)), (104, prose(3, 300)), (105, "...")]


@pytest.mark.parametrize("most", [20, 1, 3])
def test_same_as_plain(spark, documents, texts, asked, most):
    docs = documents([(i, t, "en", "s") for i, t in texts]).repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in asked], "item_id long, text string, score int")
    assert got(docs, items, most) == plain(texts, asked, most)


def test_blocks_and_small_trees(spark, documents, texts, asked, monkeypatch):
    """Several blocks of items, trees of few documents."""
    monkeypatch.setattr(s, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(s, "TREE_CELLS", 1)
    docs = documents([(i, t, "en", "s") for i, t in texts]).coalesce(2)
    items = spark.createDataFrame(asked[:20], "item_id long, text string")
    assert got(docs, items, 4) == plain(texts, asked[:20], 4)


def test_empty(spark, empty, documents):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert s.ranked(empty, items).collect() == []
    assert s.ranked(documents([(1, "one", "en", "s")]), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_whole_batches_are_pruned():
    """Documents that share no strong term with an item are left out by their nodes' bounds, and nothing is lost."""
    rng = np.random.default_rng(5)
    size, n_docs, n_items = 200, 2000, 40
    vectors = np.zeros((n_items, size), np.int64)
    for i in range(n_items):
        vectors[i, rng.choice(size, 2, replace=False)] = rng.integers(1, 4, 2)
    block = s.Items(pa.array([str(i).encode() for i in range(size)], pa.binary()), np.ones(size, np.int64), vectors, np.arange(n_items), n_docs, 1)
    docs = np.zeros((n_docs, size), np.int64)
    for d in range(n_docs):
        docs[d, (d // 40 + np.arange(4)) % size] = rng.integers(1, 1000, 4)
    best, seen = s.Best(n_items, 5), []
    plain_add = best.add
    best.add = lambda item, score, doc, named: (seen.append(len(score)), plain_add(item, score, doc, named))
    block._pairs(s.Tree(docs), np.arange(n_docs), np.ones(n_docs, bool), best)
    scores = vectors[block.numbers] @ docs.T
    assert (best.score == -np.sort(-scores, axis=1)[:, :5]).all()
    assert sum(seen) < 0.5 * n_docs * n_items
