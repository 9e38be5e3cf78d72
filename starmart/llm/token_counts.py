"""Token counts by a compiled finite-state transducer.

Byte-level BPE of a pretoken is read byte by byte by a deterministic transducer. What
each transition emits is how many tokens more (or fewer) the text has with that byte,
so the sum over the bytes is the count. A state is what the next bytes can still
change: the suffixes of the pretoken that may grow into a token, each with the token
that ends before it. (A sequence of tokens is the BPE encoding of its bytes exactly if
every two neighbours are the encoding of theirs; so one fitting token ends at each
place.) States and transitions are compiled when first met and kept by the process.

Texts are read as chunks of equal size, in lockstep. A chunk's map from entry to exit
state is constant if a pretoken begins in it; the other maps are evaluated for the
states that a chunk's left context leads to and for all that follow from these. A prefix
scan composes the maps in pairs, at distances that double from round to round. The
running sum of what was emitted gives the documents' counts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from starmart.llm.common import by_batch, flat, slices

#: Bytes of a chunk.
CHUNK = 64
#: Rounds in which the states that can occur at a chunk's border spread to the next, before maps are composed.
SPREAD = 64
#: States kept at most; a process that has more forgets all and compiles anew.
MOST_STATES = 120_000

_LETTER, _NUMBER, _OTHER, _SPACE, _WHITE = range(5)
_BASE, _STEP = 1 << 10, 1 << 11  # a table entry is next state * _STEP + emitted + _BASE
_READY: dict[str, "Transducer"] = {}
_KINDS: list[np.ndarray] = []


def transducer(path: str) -> "Transducer":
    """The process's transducer for the vocabulary file at `path`."""
    if path not in _READY:
        _READY[path] = Transducer(path)
    return _READY[path]


def _byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for bytes: printable bytes as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def kinds() -> np.ndarray:
    """For every code point: letter, number, other, space or other white space."""
    if not _KINDS:
        def kind(c: int) -> int:
            category = unicodedata.category(chr(c))
            if category[0] == "Z" or 9 <= c <= 13 or c == 0x85:
                return _SPACE if c == 32 else _WHITE
            return {"L": _LETTER, "N": _NUMBER}.get(category[0], _OTHER)

        _KINDS.append(np.fromiter(map(kind, range(0x110000)), np.uint8, 0x110000))
    return _KINDS[0]


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pretokens begin among code points; `first` marks where texts begin.

    The pattern is `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.
    """
    n = len(points)
    kind = kinds()[points]
    white = kind >= _SPACE
    before = np.empty_like(kind)
    before[:1] = _WHITE
    before[1:] = kind[:-1]
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    after_white = np.ones(n, bool)
    after_white[:-1] = white[1:]
    leads = white & ~after_white & ~last  # white space right before something else
    starts = first | leads | (white & (before < _SPACE)) | (~white & (before != kind) & (before != _SPACE))
    marks = np.flatnonzero((points == 39) & starts)
    if len(marks):
        text = np.concatenate([first, [True, True, True, True]])
        letter = np.concatenate([points, np.zeros(4, points.dtype)])
        one, two = letter[marks + 1], letter[marks + 2]
        same1 = ~text[marks + 1]
        short = same1 & np.isin(one, [ord(c) for c in "stmd"])
        pairs = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            pairs |= (one == ord(a)) & (two == ord(b))
        long = same1 & ~text[marks + 2] & pairs
        for found, size in ((short, 2), (long, 3)):
            at = marks[found]
            starts[at + 1] = False
            ends = at + size
            starts[ends[ends < n]] = True
        starts |= first
    return starts


class Transducer:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.tokens = {i: b for b, i in self.ids.items()}
        self.grows = {b[:k] for b in self.ids for k in range(1, len(b))}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.fits: dict[tuple[int, int], bool] = {}
        self.specials = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, self.specials)))
        self.column = np.full(256, -1, np.int64)  # of each byte met so far
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple] = [(b"", ((0, -1, 0),))]
        self.numbers = {self.states[0]: 0}
        self.table = np.full((4096, 64 * -(-max(1, self.column.max() + 1) // 64)), -1, np.int32)

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """The table columns of the bytes; bytes not met before get new ones."""
        new = np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.column < 0))
        self.column[new] = self.column.max() + 1 + np.arange(len(new))
        rows, width = self.table.shape
        if (needed := int(self.column.max()) + 1) > width:
            self.table = np.concatenate([self.table, np.full((rows, 64 * -(-(needed - width) // 64)), -1, np.int32)], axis=1)
        return self.column[data].astype(np.uint8)

    def encode(self, data: bytes) -> list[int]:
        """BPE of a few bytes, by merging."""
        parts = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.merges[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges]
            if not ranked:
                break
            (rank, whole), i = min(ranked)
            parts[i : i + 2] = [whole]
        return parts

    def _fit(self, before: int, token: int) -> bool:
        key = (before, token)
        if key not in self.fits:
            if len(self.fits) > 400_000:
                self.fits.clear()
            if before < 0:
                self.fits[key] = self.encode(self.tokens[token]) == [token]
            else:
                self.fits[key] = self.encode(self.tokens[before] + self.tokens[token]) == [before, token]
        return self.fits[key]

    def _compile(self, state: int, byte: int) -> None:
        suffix, open_places = self.states[state]
        suffix += bytes([byte])
        for size, before, more in open_places:
            token = self.ids.get(suffix[len(suffix) - size - 1 :])
            if token is not None and self._fit(before, token):
                break
        else:
            raise ValueError("the vocabulary has no encoding for these bytes")
        emitted = more + 1
        places = [(size + 1, b, m - emitted) for size, b, m in open_places if suffix[len(suffix) - size - 1 :] in self.grows]
        key = (suffix[len(suffix) - places[0][0] :] if places else b"", (*places, (0, token, 0)))
        number = self.numbers.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
            if number == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        assert -_BASE <= emitted < _BASE
        self.table[state, self.column[byte]] = number * _STEP + emitted + _BASE

    def _run(self, data: np.ndarray, columns: np.ndarray, cuts: np.ndarray, begins: np.ndarray, sizes: np.ndarray, entry: np.ndarray, out: np.ndarray | None) -> np.ndarray:
        """Reads data[begin : begin + size] from each entry state; emissions to `out`; returns exit states."""
        order = np.argsort(-sizes, kind="stable")
        begins, sizes, state = begins[order], sizes[order], entry[order].astype(np.int64)
        ascending = -sizes
        for step in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(ascending, -step, "left"))
            at = begins[:live] + step
            now = np.where(cuts[at], 0, state[:live])
            column = columns[at]
            found = self.table[now, column]
            if (missing := np.flatnonzero(found < 0)).size:
                for key in np.unique(now[missing] * 256 + data[at[missing]]).tolist():
                    self._compile(key >> 8, key & 255)
                found[missing] = self.table[now[missing], column[missing]]
            state[:live] = found >> 11
            if out is not None:
                out[at] = (found & (_STEP - 1)) - _BASE
        exits = np.empty(len(state), np.int64)
        exits[order] = state
        return exits

    def _scan(self, exits: np.ndarray, open_chunks: np.ndarray, run: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        """Exit states of the chunks without a cut, whose entry is what the chunk before left; `exits` of the others are known.

        Every open chunk gets a map from the entry states that can occur there to its exit states: those that a known
        exit, or a run of the chunk before from the initial state, leads to, and what follows from these. Maps, those of
        the other chunks being constant, are then composed in pairs at doubled distances, log2(n) rounds. Where more
        than SPREAD rounds of states can occur, the chunks that are left are mapped for the one state that does.
        """
        is_open = np.zeros(len(exits) + 1, bool)
        is_open[open_chunks] = True
        before = open_chunks - 1
        entry = exits[before].copy()
        guessed = np.flatnonzero(is_open[before])
        entry[guessed] = run(before[guessed], np.zeros(len(guessed), np.int64))
        known, into = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh = np.unique(open_chunks << 32 | entry)
        while True:
            for _ in range(SPREAD):
                left = run(fresh >> 32, fresh & 0xFFFFFFFF)
                at = np.searchsorted(known, fresh)
                known, into = np.insert(known, at, fresh), np.insert(into, at, left)
                follow = (fresh >> 32) + 1
                goes_on = is_open[follow]
                fresh = np.setdiff1d(follow[goes_on] << 32 | left[goes_on], known)
                if not len(fresh):
                    break
            exits[open_chunks] = -1
            begun = np.flatnonzero(exits[before] >= 0)
            met = _composed(known, into, open_chunks[begun] << 32 | exits[before[begun]], len(exits))
            exits[known[met] >> 32] = into[met]
            missing = open_chunks[exits[open_chunks] < 0]
            missing = missing[exits[missing - 1] >= 0]
            if not len(missing):
                return
            fresh = np.setdiff1d(missing << 32 | exits[missing - 1], known)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (no nulls)."""
        data, begins = flat(texts)
        if not len(data):
            return np.zeros(len(texts), np.int64)
        if len(self.states) > MOST_STATES:
            self._forget()
        whole = data.tobytes()
        first_byte = np.zeros(len(data) + 1, bool)
        first_byte[begins] = True
        marks: list[tuple[int, int]] = []
        if any(special in whole for special in self.specials):
            for text_begin, text_end in zip(begins[:-1].tolist(), begins[1:].tolist()):
                marks += [m.span() for m in self.special.finditer(whole, text_begin, text_end)]
        for low, high in marks:
            first_byte[[low, high]] = True
        points = np.frombuffer(whole.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        cuts = np.zeros(len(data), bool)
        cuts[lead] = pretoken_starts(points, first_byte[lead])

        columns = self._columns(data)
        emitted = np.zeros(len(data), np.int32)
        n = -(-len(data) // CHUNK)
        chunk = np.arange(n) * CHUNK
        ends = np.minimum(chunk + CHUNK, len(data))
        cut_at = np.flatnonzero(cuts)
        head_end = np.minimum(np.append(cut_at, len(data))[np.searchsorted(cut_at, chunk, "left")], ends)
        constant = head_end < ends
        exits = np.full(n, -1, np.int64)
        body = np.flatnonzero(constant)
        exits[body] = self._run(data, columns, cuts, head_end[body], (ends - head_end)[body], np.zeros(len(body), np.int64), emitted)
        open_chunks = np.flatnonzero(~constant)
        if len(open_chunks):
            self._scan(exits, open_chunks, lambda lanes, entry: self._run(data, columns, cuts, chunk[lanes], (ends - chunk)[lanes], entry, None))
        heads = np.flatnonzero(head_end > chunk)
        self._run(data, columns, cuts, chunk[heads], (head_end - chunk)[heads], exits[heads - 1], emitted)
        for low, high in marks:
            emitted[low:high] = 0
            emitted[low] = 1
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(emitted, out=sums[1:])
        return np.diff(sums[begins])


def _composed(known: np.ndarray, into: np.ndarray, begun: np.ndarray, n: int) -> np.ndarray:
    """The entries of the maps that are met on the way from the entries `begun`, by pairwise composition over at most n chunks.

    `known` holds chunk << 32 | entry state, ascending, and `into` the exit states: an entry leads to one of the next
    chunk's map, or to none. Each round doubles the distance that the composed maps span.
    """
    none = len(known)
    following = ((known >> 32) + 1) << 32 | into
    at = np.minimum(np.searchsorted(known, following), none - 1)
    leads = np.append(np.where(known[at] == following, at, none), none)
    at = np.minimum(np.searchsorted(known, begun), none - 1)
    met = np.zeros(none + 1, bool)
    met[at[known[at] == begun]] = True
    reach = 1
    while reach <= n:
        met[leads[met]] = True
        leads = leads[leads]
        reach *= 2
    return np.flatnonzero(met[:none])


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens (long) and over_limit (n_tokens > limit) of each row of `docs`.

    A null text counts as empty: no bytes, no tokens. Null and repeated ids stay, each
    row is counted by itself, other columns are not read. Works by batch, without a shuffle.
    """

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        for part in slices(batch):
            texts = part.column("text")
            n = machine.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return by_batch(docs.select("doc_id", "text"), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
