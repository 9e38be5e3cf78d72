"""Token ids of whole texts by a `tokenizers` vocabulary that drops white space.

A text's ids are those of its words between ASCII white space, one after the other,
so each distinct word is tokenized once by the library. The vocabulary compares in lower
case and never joins ASCII letters with signs, so words are cut there as well.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from starmart.llm.common import distinct_words, flat, lowered, ranges, span_hashes, words

#: Distinct words that a process remembers (by a 64-bit hash, some 30 bytes each); beyond that it forgets all and goes on.
REMEMBERED = 3_000_000
_SEPARATOR = "\x01"
# ASCII letters and digits 1, other ASCII signs but the apostrophe 2: between the two the vocabulary's pattern always cuts.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = [1 if chr(c).isalnum() else 2 * (c != 39) for c in range(33, 127)]
_READY: dict[str, "WordIds"] = {}


def word_ids(path: str) -> "WordIds":
    """The process's tokenizer for the vocabulary file at `path`."""
    if path not in _READY:
        _READY[path] = WordIds(path)
    return _READY[path]


class WordIds:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content.encode().lower() for t in self.library.get_added_tokens_decoder().values()]
        self.mark = np.array(self._of(_SEPARATOR), np.uint32)
        assert len(self.mark) == 1, "the separator must be a token of its own"
        self._forget()

    def _of(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending, and for each the word's place in `checks`, `begins` and `sizes`
        self.places = np.zeros(0, np.int32)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _tokenize(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and each word's number of ids: many words in one text, with a separator between them."""
        ids, sizes = [], []
        for low in range(0, len(new), 4000):
            part = new[low : low + 4000]
            joined = f" {_SEPARATOR} ".encode().join(part)
            if joined.count(b"\x01") != len(part) - 1:  # a word holds the separator
                each = [np.array(self._of(w.decode()), np.uint32) for w in part]
                ids += each
                sizes.append(np.array([len(x) for x in each], np.int32))
                continue
            found = np.array(self._of(joined.decode()), np.uint32)
            at = np.flatnonzero(found == self.mark[0])
            sizes.append(np.diff(np.concatenate([[-1], at, [len(found)]])).astype(np.int32) - 1)
            ids.append(np.delete(found, at))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, new: list[bytes]) -> None:
        ids, sizes = self._tokenize(new)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.places = np.insert(self.places, at, (len(self.begins) + order).astype(np.int32))
        self.checks = np.concatenate([self.checks, checks])
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def _holds_special(self, data: np.ndarray) -> bool:
        whole = data.tobytes().lower()
        return any(special in whole for special in self.specials)

    def _places_of(self, spelled: np.ndarray, edges: np.ndarray, distinct: pa.Array) -> np.ndarray | None:
        """The place of each distinct word, after learning the new ones; None if a hash stands for two words."""
        hashes, checks = (span_hashes(spelled, edges[:-1], edges[1:], key) for key in (0, 1))
        where = np.searchsorted(self.hashes, hashes)
        new = where == len(self.hashes)
        new[~new] = self.hashes[where[~new]] != hashes[~new]
        if (self.checks[self.places[where[~new]]] != checks[~new]).any() or len(np.unique(hashes[new])) < new.sum():
            return None
        if new.any():
            self._learn(hashes[new], checks[new], distinct.filter(pa.array(new)).to_pylist())
            where = np.searchsorted(self.hashes, hashes)
        return self.places[where].astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), and where each text's ids begin (with one more entry for the end)."""
        data, begins = flat(texts)
        if self._holds_special(data):  # perhaps a special token, which is taken as it stands
            starts, ends, first = words(data, begins)
        else:
            data = lowered(data)
            kind = _KIND[data]
            cuts = np.zeros(len(data), bool)
            cuts[1:] = (kind[1:] | kind[:-1]) == 3
            starts, ends, first = words(data, begins, cuts)
        distinct, at = distinct_words(data, starts, ends)
        spelled, edges = flat(distinct)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        where = self._places_of(spelled, edges, distinct)
        clash = where is None
        if clash:  # two words of one hash: this batch's words go by their number
            self._forget()
            numbers = np.arange(len(distinct), dtype=np.uint64)
            self._learn(numbers, numbers, distinct.to_pylist())
            where = numbers.astype(np.int64)
        places = where[at]
        counts = self.sizes[places]
        ids = self.ids[ranges(self.begins[places], counts)]
        ends_at = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=ends_at[1:])
        if clash:
            self._forget()
        return ids, ends_at[first]
