"""The pipeline against its stages written out by brute force, on whole sample documents and on odd rows."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from starmart.llm.secrets import ASSIGN, MIN_ASSIGN
from tests.llm.test_operators import WORD, brute_components, multiset

FOLDER = "/root/testdata/sf0.001"


def base_kept(text):
    w = WORD.findall(text)
    triples = list(zip(w, w[1:], w[2:]))
    often = collections.Counter(triples)
    covered = {p for k, x in enumerate(triples) if often[x] > 1 for p in (k, k + 1, k + 2)}
    return len(w) >= 50 and 100 * len(covered) <= 50 * len(w)


def cut(rows):
    """Texts without the bytes of strings of 100 that occurred before; no code point is cut in two."""
    seen, out = set(), []
    for i, t in sorted(rows):
        data = t.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            else:
                seen.add(data[s : s + 100])
        at, kept = 0, []
        for c in t:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        kept = "".join(kept)
        if kept == t or kept.strip():
            out.append((i, kept))
    return out


def masked(text):
    spans = [(m.start(2), m.end()) for m in ASSIGN.finditer(text.encode()) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    data = text.encode()
    spans += [m.span() for m in re.finditer(rb"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", data)]
    out, at = [], 0
    for low, high in sorted(spans):
        if low >= at:
            out += [data[at:low], b"[SECRET]"]
        at = max(at, high)
    return b"".join([*out, data[at:]]).decode()


def test_stages_and_result(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = [x for x in rows if base_kept(x[1])]
    first = {i for i, _, c in brute_components(rows, 5, 80) if i == c}
    rows = [(i, masked(t)) for i, t in cut([x for x in rows if x[0] in first])]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in rows:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert multiset(r[:5] for r in got) == multiset(want)


def test_odd_rows_and_no_rows_pass_all_stages(spark, odd, empty):
    for df in (odd, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == df.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        assert {r.doc_id for r in pieces.collect()} == (set() if df is empty else {None, 1, 8, 11})
