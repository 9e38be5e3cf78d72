"""Phrase collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest

from starmart.llm import collocations as c
from tests.llm.conftest import prose

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counted(rows, longest):
    """Occurrences of the phrases of each language, by (lang, words); () holds all words."""
    out = Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            out[lang or "und", ()] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    out[lang or "und", tuple(words[i : i + size])] += 1
    return out


def plain(rows, policy):
    f = counted(rows, policy.longest)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= policy.least}
    found = {}
    for (lang, words), a in candidates.items():
        longer = (w for (x, w), b in candidates.items() if x == lang and len(w) > len(words) and b >= a)
        if any(w[i : i + len(words)] == words for w in longer for i in range(len(w) - len(words) + 1)):
            continue
        n = f[lang, ()]
        score, _, l, r = min((1000 * a * n // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, n))
    return [(lang, i, p.decode(), -a, l, r, n, -score) for lang in sorted(found) for i, (score, a, p, l, r, n) in enumerate(sorted(found[lang])[: policy.most], 1)]


def rows_of(df):
    return sorted(tuple(r[x] for x in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def odd_rows():
    base = prose(1, 300)
    rows = [(base, "en"), (base, "en"), (None, "en"), ("", None), (" \n\t. ", None), ("one", "en"), (base.upper(), "fr"), (base, None), ("x " * 3000, "de")]
    rows += [("a b a b, a b; c a b. Ünï b Ünï b\x0bÜnï b", "de")] * 3 + [("tab\tand  more  tab\tand", "de")] * 4
    return rows + [("y" * 4000 + " of the " + "z" * 4000, "en")] * 2 + [("\x00\x01 of the of the", "en")]


@pytest.mark.parametrize("policy", [c.Phrases(2, 5, 2000), c.Phrases(3, 5, 7), c.Phrases(2, 3, 50, 64), c.Phrases(2, 2, 10)], ids=str)
def test_same_as_plain(documents, odd_rows, policy):
    docs = documents([(i if i % 3 else None, text, lang, "s") for i, (text, lang) in enumerate(odd_rows)])
    assert rows_of(c.collocations(docs, policy)) == sorted(plain(odd_rows, policy))


def test_empty(empty):
    assert c.collocations(empty).collect() == []
    assert c.collocations(empty).columns == COLUMNS


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits: the counts are given, not gathered."""
    big = 3_000_000_000_000
    counts = [("en", 0, "", 10**15), ("en", 1, "of", big + 1), ("en", 1, "the", big), ("en", 2, "of the", big - 7)]
    monkeypatch.setattr(c, "frequent_phrases", lambda docs, policy: spark.createDataFrame(counts, "lang string, n_words int, phrase string, f long"))
    (row,) = c.collocations(None).collect()
    assert row.score == 1000 * (big - 7) * 10**15 // ((big + 1) * big)


@pytest.mark.parametrize("capacity", [20, 200, 5000])
def test_every_frequent_key_survives(capacity):
    """However small a summary is and in whatever order parts come, no key with `least` occurrences is lost."""
    rng = np.random.default_rng(7)
    least = 50
    keys = np.concatenate([np.repeat(np.arange(30, dtype=np.uint64), 60), rng.integers(1000, 9000, 40000).astype(np.uint64)])
    true = Counter(keys.tolist())
    for seed in range(3):
        mixed = np.random.default_rng(seed).permutation(keys)
        state, taken = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
        for part in np.array_split(mixed, 40):
            *state, taken = c.summary(np.append(state[0], part), np.append(state[1], np.ones(len(part), np.int64)), taken, capacity, least)
        held = dict(zip(state[0].tolist(), state[1].tolist()))
        assert taken < least
        assert all(held.get(k, 0) + taken >= f and held.get(k, 0) <= f for k, f in true.items())
        assert {k for k, f in true.items() if f >= least} <= {k for k, n in held.items() if n + taken >= least}
    assert capacity < 5000 or len(state[0]) <= capacity


def test_summary_keeps_within_its_capacity():
    """With a capacity above mass / least the counters stay bounded, and merged summaries lose no more than one summary would."""
    rng = np.random.default_rng(3)
    least, mass = 100, 50_000
    capacity = mass // least + 1
    keys = rng.integers(0, 1 << 40, mass).astype(np.uint64)
    keys[::50] = 5
    state, taken = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
    for part in np.array_split(keys, 25):
        *state, taken = c.summary(np.append(state[0], part), np.append(state[1], np.ones(len(part), np.int64)), taken, capacity, least)
        assert len(state[0]) <= capacity
    assert 5 in state[0].tolist() and taken < least
