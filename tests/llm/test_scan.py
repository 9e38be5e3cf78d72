"""Token counts of texts with long runs that no pretoken border cuts, by composed chunk maps."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmart.llm import token_counts as t, word_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def machine():
    return t.transducer(PATH)


@pytest.fixture(scope="module")
def count():
    library = Tokenizer.from_file(PATH)
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


RUNS = ["." * 5000, "ab" * 3000, "日本" * 3000, " " * 4000 + "x", "=-" * 4000, "0" * 300 + "é" * 3000, "\n" * 5000, "thetionandof" * 900]


@pytest.mark.parametrize("spread", [64, 1])
def test_long_runs(monkeypatch, machine, count, spread):
    monkeypatch.setattr(t, "SPREAD", spread)
    rng = random.Random(spread)
    texts = RUNS + ["".join(rng.choices("ABCDEFGHIabcdefghi+/", k=4000))]
    texts += ["".join(rng.choice([".", "a", "==", " ", "the", "xyz", "é"]) * rng.randint(1, 300) for _ in range(12)) for _ in range(10)]
    assert machine.counts(pa.array(texts)).tolist() == [count(x) for x in texts]


def test_time_in_proportion_to_length(machine):
    machine.counts(pa.array(["." * 200_000]))
    began = time.perf_counter()
    assert machine.counts(pa.array(["." * 3_200_000]))[0] == 50_000
    assert time.perf_counter() - began < 20


def test_composition_follows_the_maps_one_by_one():
    rng = np.random.default_rng(6)
    for n in (1, 2, 7, 64, 200):
        states = 5
        maps = rng.integers(0, states, (n, states))
        held = rng.random((n, states)) < 0.9
        chunk, state = np.nonzero(held)
        known, into = chunk << 32 | state, maps[held]
        want, at, s = [], 0, 0
        while at < n and held[at, s]:
            want.append(at << 32 | s)
            s, at = int(maps[at, s]), at + 1
        if len(known):
            assert known[t._composed(known, into, np.array([0]), n)].tolist() == want


def test_special_tokens_by_the_vocabulary(machine, count):
    texts = ["a <|endoftext|> b", "x<|endoftext|><|endoftext|>y", "< | no"]
    assert machine.counts(pa.array(texts)).tolist() == [count(x) for x in texts]
    ids = word_ids.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    special = [x.content for x in ids.library.get_added_tokens_decoder().values()][:3]
    texts = [f"One {s} two" for s in special] + [f"one{s.upper()}two" for s in special]
    values, begins = ids.encode(pa.array(texts))
    assert [values[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == [ids._of(x) for x in texts]
