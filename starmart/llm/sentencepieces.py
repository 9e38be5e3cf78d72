"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are concatenated and indexed by a suffix array (sorted by as
many characters as the longest piece has). Each piece of the vocabulary is found by binary
search as a range of suffixes; its occurrences are edges of the words' lattices. The
edges are sorted by position and relaxed: an edge reaches its end if the piece may follow the
one that reached its begin, which holds exactly if the two are the encoding of their
joined characters. One edge at most reaches each place, so the path is the encoding that
merging best-scored pairs first gives. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from starmart.llm.common import by_batch, distinct_words, flat, ranges, slices, span_hashes

SPACE = "\u2581"
#: Bytes of text whose words are indexed together.
BATCH_BYTES = 4 << 20
#: Distinct words that a process remembers; beyond that it forgets all and goes on.
REMEMBERED = 2_000_000
#: Characters of a word that is relaxed by itself; shorter ones go place by place, all at once.
LONG = 512
_READY: dict[str, "Pieces"] = {}


def pieces(path: str) -> "Pieces":
    """The process's vocabulary for the model file at `path`."""
    if path not in _READY:
        _READY[path] = Pieces(path)
    return _READY[path]


class Pieces:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(count)]
        self.names = [model.id_to_piece(i) for i in range(count)]
        self.scores = {p: model.get_score(i) for i, p in enumerate(self.names) if not special[i]}
        self.ids = {p: i for i, p in enumerate(self.names) if not special[i]}
        # What each id decodes to.
        plain = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(self.names)]
        for b, i in enumerate(self.byte_ids.tolist()):
            plain[i] = bytes([b])
        self.plain_sizes = np.array([len(x) for x in plain], np.int64)
        self.plain_begins = np.cumsum(self.plain_sizes) - self.plain_sizes
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        # Pieces that are their own encoding, as sorted keys of characters; a character is written as two non-zero bytes.
        alone = [p for p in self.ids if self.encode(p) == [self.ids[p]]]
        self.longest = max(map(len, alone))
        letters = sorted({c for p in self.ids for c in p})
        self.letter = np.zeros(0x110000, np.uint16)
        number = {c: (1 + i // 255) << 8 | (1 + i % 255) for i, c in enumerate(letters)}
        self.letter[[ord(c) for c in letters]] = list(number.values())
        self.single = np.full(0x110000, -1, np.int64)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        keys = np.zeros((len(alone), self.longest), ">u2")
        for row, p in zip(keys, alone):
            row[: len(p)] = [number[c] for c in p]
        self.sizes = np.array([len(p) for p in alone], np.int64)
        self.alone = np.array([self.ids[p] for p in alone], np.int64)
        self.length = np.ones(count + 1, np.int64)  # of each id in characters; the last is that of an unknown character
        self.length[list(self.ids.values())] = [len(p) for p in self.ids]
        kind = f"S{2 * self.longest}"
        self.low = keys.view(kind).reshape(-1)
        keys = keys.copy()
        keys[keys == 0] = 0xFFFF
        self.high = keys.view(kind).reshape(-1)
        self.unknown = count
        self.pairs = np.full(1, -1, np.int64)  # ascending: first id * (count + 1) + second id; the first is none
        self.fit = np.zeros(1, bool)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.known = np.zeros(0, np.int32)

    def encode(self, characters: str) -> list[int]:
        """A few characters, all with pieces of their own, by merging the best-scored pair first."""
        parts = list(characters)
        while len(parts) > 1:
            scored = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not scored:
                break
            i = min(scored)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def _may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether second may follow first (ids; -1 where nothing precedes). Asked pairs are remembered."""
        key = first * (self.unknown + 1) + second
        free = (first < 0) | (first == self.unknown) | (second == self.unknown)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        seen = free | (self.pairs[at] == key)
        if not seen.all():
            new = np.unique(key[~seen])
            fit = np.array([self.encode(self.names[a] + self.names[b]) == [a, b] for a, b in zip((new // (self.unknown + 1)).tolist(), (new % (self.unknown + 1)).tolist())])
            where = np.searchsorted(self.pairs, new)
            self.pairs, self.fit = np.insert(self.pairs, where, new), np.insert(self.fit, where, fit)
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return free | self.fit[at]

    def _edges(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and place in `alone` of every piece's occurrences in the text, from the suffix array."""
        n = len(letters)
        padded = np.concatenate([letters, np.zeros(self.longest, np.uint16)]).astype(">u2")
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[:n]
        rows = np.ascontiguousarray(windows)
        # From a separator on, nothing counts.
        rows[np.cumsum(rows == 0, axis=1) > 0] = 0
        words = np.zeros((n, -(-self.longest // 4) * 4), ">u2")
        words[:, : self.longest] = rows
        suffixes = np.lexsort(words.view(">u8").astype(np.uint64).T[::-1])
        ordered = rows[suffixes].view(f"S{2 * self.longest}").reshape(-1)
        low = np.searchsorted(ordered, self.low, "left")
        high = np.searchsorted(ordered, self.high, "right")
        count = high - low
        return suffixes[ranges(low, count)], np.repeat(np.arange(len(count)), count)

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, words: list[np.ndarray]) -> None:
        """Encodes words (code points) not seen so far."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        points = np.zeros(int(sizes.sum()) + len(words), np.int64)
        inner = ranges(starts, sizes)
        points[inner] = np.concatenate(words)
        letters = self.letter[points]
        missing = np.zeros(len(points), bool)
        missing[inner] = self.single[points[inner]] < 0
        letters[missing] = 0xFFFE
        separators = np.ones(len(points), bool)
        separators[inner] = False
        letters[separators] = 0
        begin, place = self._edges(letters)
        unknown = np.flatnonzero(missing)
        begin, piece = np.append(begin, unknown), np.append(self.alone[place], np.full(len(unknown), self.unknown))
        end = begin + self.length[piece]
        word_start = np.repeat(starts, sizes + 1)
        offset = end - word_start[begin]
        order = np.argsort(offset, kind="stable")
        begin, end, piece, offset = begin[order], end[order], piece[order], offset[order]
        last = np.full(len(points) + 1, -2, np.int64)  # the piece that reaches each place
        last[starts] = -1
        wide = sizes[np.searchsorted(starts, begin, "right") - 1] > LONG
        if wide.any():
            self._relax(last, begin[wide], end[wide], piece[wide])
            begin, end, piece, offset = begin[~wide], end[~wide], piece[~wide], offset[~wide]
        edges = np.searchsorted(offset, np.arange(1, int(offset[-1]) + 2 if len(offset) else 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            before = last[begin[a:b]]
            open_ = np.flatnonzero(before >= -1)
            good = open_[self._may_follow(before[open_], piece[a:b][open_])]
            last[end[a:b][good]] = piece[a:b][good]
        # Back from the words' ends.
        at, ends = starts + sizes, np.zeros(len(points) + 1, bool)
        for w in np.flatnonzero(sizes > LONG).tolist():
            back = _walked(last, self.length, int(starts[w]), int(at[w]))
            ends[back] = True
        live = np.flatnonzero(sizes <= LONG)
        while len(live):
            here = at[live]
            ends[here] = True
            at[live] = here - self.length[last[here]]
            live = live[at[live] > starts[live]]
        tokens = np.flatnonzero(ends)
        word = np.searchsorted(starts, tokens - 1, "right") - 1
        ids, per_token = last[tokens], np.ones(len(tokens), np.int64)
        if len(unknown):
            spelled = [chr(points[t - 1]).encode() if i == self.unknown else b"" for t, i in zip(tokens.tolist(), ids.tolist())]
            per_token = np.maximum([len(x) for x in spelled], 1)
            whole = np.repeat(ids, per_token)
            bytes_ = np.frombuffer(b"".join(x or b"\0" for x in spelled), np.uint8)
            ids = np.where(whole == self.unknown, self.byte_ids[bytes_], whole)
        counts = np.bincount(word, weights=per_token, minlength=len(words)).astype(np.int64)
        order = np.argsort(hashes)
        where = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, where, hashes[order])
        self.places = np.insert(self.places, where, len(self.begins) + order)
        self.checks = np.concatenate([self.checks, checks])
        self.begins = np.concatenate([self.begins, len(self.known) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.known = np.concatenate([self.known, ids.astype(np.int32)])

    def _relax(self, last: np.ndarray, begin: np.ndarray, end: np.ndarray, piece: np.ndarray) -> None:
        """Relaxes the edges of long words one by one, by their ends, in runs of a bounded number."""
        order = np.argsort(end, kind="stable")
        fit: dict[tuple[int, int], bool] = {}
        least = int(begin.min()) if len(begin) else 0
        reach = last[least:].tolist()
        for low in range(0, len(order), 1 << 16):
            part = order[low : low + (1 << 16)]
            for a, b, p in zip((begin[part] - least).tolist(), (end[part] - least).tolist(), piece[part].tolist()):
                before = reach[a]
                if before < -1:
                    continue
                if (before, p) not in fit:
                    fit[before, p] = bool(self._may_follow(np.array([before]), np.array([p]))[0])
                if fit[before, p]:
                    reach[b] = p
        last[least:] = reach

    def _places_of(self, spelled: np.ndarray, edges: np.ndarray) -> np.ndarray | None:
        """The place of each distinct word, after learning the new ones; None if a hash stands for two words."""
        hashes, checks = (span_hashes(spelled, edges[:-1], edges[1:], key) for key in (0, 1))
        where = np.searchsorted(self.hashes, hashes)
        new = where == len(self.hashes)
        new[~new] = self.hashes[where[~new]] != hashes[~new]
        if (self.checks[self.places[where[~new]]] != checks[~new]).any() or len(np.unique(hashes[new])) < new.sum():
            return None
        if new.any():
            found = _as_points(spelled, edges)
            self._learn(hashes[new], checks[new], [found[i] for i in np.flatnonzero(new).tolist()])
            where = np.searchsorted(self.hashes, hashes)
        return self.places[where]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), and where each text's ids begin (with one more entry for the end)."""
        data, begins = flat(texts)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[begins]
        filled = np.diff(before) > 0
        # A space in front of each text that is not empty.
        front = before[:-1][filled]
        points = np.insert(np.where(points == 32, ord(SPACE), points), front, ord(SPACE)).astype(np.uint32)
        text_starts = before + np.concatenate([[0], np.cumsum(filled)])
        space = points == ord(SPACE)
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[text_starts[:-1][filled]] = True
        starts = np.flatnonzero(start)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(starts[1:], len(points))
        distinct, at = distinct_words(points.view(np.uint8), 4 * starts, 4 * ends)
        spelled, edges = flat(distinct)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        where = self._places_of(spelled, edges)
        clash = where is None
        if clash:  # two words of one hash: this batch's words go by their number
            self._forget()
            numbers = np.arange(len(distinct), dtype=np.uint64)
            self._learn(numbers, numbers, _as_points(spelled, edges))
            where = numbers.astype(np.int64)
        places = where[at]
        counts = self.counts[places]
        ids = self.known[ranges(self.begins[places], counts)].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(counts)])
        if clash:
            self._forget()
        return ids, total[np.searchsorted(starts, text_starts, "left")]

    def decode_batch(self, ids: np.ndarray, begins: np.ndarray) -> list[str]:
        """The texts of runs of ids: spaces for marks, byte pieces as bytes, without the space in front."""
        sizes = self.plain_sizes[ids]
        data = self.plain[ranges(self.plain_begins[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[begins]
        return [data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _as_points(spelled: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Words of four bytes a character as code points."""
    whole = np.frombuffer(spelled.tobytes(), np.uint32)
    return [whole[a:b] for a, b in zip((edges[:-1] // 4).tolist(), (edges[1:] // 4).tolist())]


def _walked(last: np.ndarray, length: np.ndarray, start: int, at: int) -> list[int]:
    """The ends of a word's pieces, from its last one back."""
    steps, out = length[last[start : at + 1]].tolist(), []
    while at > start:
        out.append(at)
        at -= steps[at - start]
    return out


def _path(model: str | None) -> str:
    return model or public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and `ids` of each row's text; a null or empty text has none. Each row by itself; nothing is shuffled."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, most=BATCH_BYTES):
            ids, begins = pieces(_path(model)).encode_batch(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "ids"])

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give an empty text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column("ids")
        sizes = np.array([0 if x is None else x for x in pc.list_value_length(lists).to_pylist()], np.int64)
        ids = np.asarray(lists.flatten(), np.int64) if len(lists) else np.zeros(0, np.int64)
        texts = pieces(_path(model)).decode_batch(ids, np.concatenate([[0], np.cumsum(sizes)]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return by_batch(rows.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trips(docs: DataFrame, model: str | None = None) -> DataFrame:
    """For each row: doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256, round_trip.

    Texts are encoded and decoded whole. A null or empty text has no pieces and decodes to an empty one. Null and
    repeated ids stay; no rows give no rows.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, most=BATCH_BYTES):
            vocabulary = pieces(_path(model))
            ids, begins = vocabulary.encode_batch(part.column("text"))
            texts = vocabulary.decode_batch(ids, begins)
            data, places = ids.astype("<u4").tobytes(), (4 * begins).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(begins)),
                    pa.array([zlib.crc32(data[a:b]) for a, b in zip(places[:-1], places[1:])], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string()),
                    pa.array([a == b for a, b in zip(texts, part.column("text").to_pylist())], pa.bool_()),
                ],
                names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip"],
            )

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
