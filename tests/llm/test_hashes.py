"""Words and sets are told apart whatever their bytes."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from starmart.llm import common, sentencepieces, word_ids
from starmart.llm.fingerprints import compared
from starmart.llm.jaccard_join import Join, similar_documents


def thue_morse(n: int) -> tuple[str, str]:
    """A text of n letters that polynomials modulo 2^64 do not tell from its complement, and that complement."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def ids():
    return word_ids.WordIds(public_tokenizers.path("word_bpe_49k.json"))


def _rows(found):
    values, begins = found
    return [values[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]


def test_span_hash_is_the_polynomial():
    data = np.random.default_rng(1).integers(0, 256, 3000, dtype=np.uint8)
    p, base = (1 << 61) - 1, common._BASES[0]
    starts, ends = np.array([0, 5, 2000, 7]), np.array([3000, 5, 2999, 8])
    plain = [sum((int(data[a + i]) + 1) * pow(base, i, p) for i in range(b - a)) % p for a, b in zip(starts, ends)]
    sizes = (ends - starts).astype(np.uint64)
    want = common.mixed(np.array(plain, np.uint64) + sizes * np.uint64(0xD6E8FEB86659FD93))
    assert common.span_hashes(data, starts, ends).tolist() == want.tolist()


def test_complements_have_their_own_ids(pieces, library, ids):
    texts = list(thue_morse(2048))
    assert _rows(pieces.encode_batch(pa.array(texts))) == [library.encode(t) for t in texts]
    assert _rows(ids.encode(pa.array(texts))) == [ids._of(t) for t in texts]


def test_words_of_one_hash(monkeypatch, pieces, library, ids):
    """All words share the first hash; the second tells those of other lengths apart."""

    def one(data, starts, ends, key=0):
        return (ends - starts if key else starts * 0 + 5).astype(np.uint64)

    for module in (sentencepieces, word_ids):
        monkeypatch.setattr(module, "span_hashes", one)
    pieces._forget()
    ids._forget()
    for texts in (["one two three", "two four one"], ["seven"], ["eleventh"], ["seven one"]):
        assert _rows(pieces.encode_batch(pa.array(texts))) == [library.encode(t) for t in texts]
        assert _rows(ids.encode(pa.array(texts))) == [ids._of(t) for t in texts]
    pieces._forget()
    ids._forget()


def test_long_words(pieces, library):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghijklmnop0123456789+/", k=20000)), "short words here", "".join(rng.choices("日本語中文字あいう🙂", k=2000)), "a" * 3000]
    assert _rows(pieces.encode_batch(pa.array(texts))) == [library.encode(t) for t in texts]


def test_complements_are_not_alike(documents):
    a, b = thue_morse(1024)
    docs = documents([(1, a, "en", "s"), (2, b, "en", "s")])
    assert sorted(r.component_id for r in similar_documents(docs, Join(3, 90, 100)).collect()) == [1, 2]
    assert {r.near_next for r in compared(docs).collect()} == {0.0}
