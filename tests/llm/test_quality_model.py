"""The compression classifier: what it learns from, its scores and odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import quality_model as q
from tests.llm.conftest import prose

LABELS = "doc_id long, quality int, toxic int"


def junk(seed: int, n: int) -> str:
    return " | ".join(w.upper() + "$$$" for w in prose(seed, n).split())


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(documents):
    rows = [(i, prose(i, 60 + i % 200) if i % 4 else junk(i, 40 + i % 90), "en", "s") for i in range(1, 400)]
    return documents(rows + [(None, prose(7, 90), "en", "s"), (1000, None, None, None), (1001, "", "en", "s"), (1, rows[0][1], "en", "s"), (1002, prose(5, 60000), "en", "s"), (1003, "word", "en", "s")])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(1, 400)] + [(None, 1, 0), (5000, 0, 1), (3, None, 0)], LABELS)


@pytest.fixture(scope="module")
def result(corpus, labels):
    return q.quality_scores(corpus, labels).collect()


def test_held_out_documents_are_told_apart(result):
    held = [r for r in result if r.held_out and r.doc_id < 400]
    assert len(held) > 50
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) >= 0.97


def test_one_row_for_each_document(result, corpus):
    assert len(result) == corpus.count()
    assert result[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in result)
    assert all(r.held_out == (r.doc_id is not None and is_held_out(r.doc_id)) for r in result)
    of = {}
    for r in result:
        of.setdefault(r.doc_id, []).append(r.score)
    assert of[1][0] == of[1][1]
    assert of[1000] == of[1001]  # null and empty alike
    assert of[1002][0] > 0.5


def test_held_out_labels_are_not_learned(corpus, labels, result):
    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(q.quality_scores(corpus, turned).collect(), key=str) == sorted(result, key=str)


def test_label_language_and_source_are_no_inputs(corpus, labels, result):
    other = corpus.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "n_chars": F.lit(1).cast("long")})
    assert sorted(q.quality_scores(other, labels).collect(), key=str) == sorted(result, key=str)


def test_without_labels_of_both_kinds(corpus, labels, empty):
    assert {r.score for r in q.quality_scores(corpus, labels.limit(0)).collect()} == {0.5}
    only = {r.score for r in q.quality_scores(corpus, labels.where("quality = 1")).collect()}
    assert len(only) <= 2 and min(only) > 0.9
    assert q.quality_scores(empty, labels).collect() == []


def test_whole_text_counts(corpus, labels):
    """Junk behind a long good beginning lowers the score."""
    model = q.learn(corpus, labels)
    good = prose(901, 3000)
    whole, spoiled = model.scores(pa.array([good, good + junk(902, 3000)]))
    assert spoiled < whole


def test_curve_is_the_best_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(0.7 + x @ [1.5, -2.0])))
    y = (rng.random(4000) < p).astype(float)
    curve = q.fitted(x, y, np.ones(4000))
    assert np.abs(curve(x) - p).mean() < 0.03
    slopes = curve.slopes[1:] / curve.spread
    assert np.allclose(slopes, [1.5, -2.0], atol=0.25)
    # Scores are calibrated: among documents scored alike, as many have label 1 as the score says.
    for low in np.arange(0, 1, 0.25):
        some = (curve(x) >= low) & (curve(x) < low + 0.25)
        assert abs(y[some].mean() - curve(x)[some].mean()) < 0.08


def test_dictionaries_of_few_samples():
    assert q.dictionary([b"only one"]) == b"only one"
    assert len(q.dictionary([b"same text again and again"] * 5000)) <= q.DICTIONARY
