"""Token ids of whole texts in one pass, each distinct piece encoded about once per worker process.

Texts are cut into pieces (`vocabulary.piece_blocks`), whose ids don't depend on what stands around them. A worker
keeps the ids of the pieces it has met in a table of fixed size that is indexed by bits of their 64-bit hashes: all
pieces of a block of texts are looked up at once, the missing ones are encoded and take their places. Nothing is
shuffled or broadcast, and what the table holds changes only the time, never the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.tokens import Words, word_bytes
from tidemark.llm.vocabulary import piece_blocks, tokenizer

SLOT_BITS = 21              # of the table: 40 MB per worker process
MOST_IDS = 1 << 24          # that the table's pieces have together before it starts anew: 32 or 64 MB
JOINED = 512                # words encoded as one text

_stores: dict[str, Store] = {}


def id_type(path: str) -> np.dtype:
    """Little-endian unsigned integers wide enough for every id of the tokenizer."""
    return np.dtype("<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")


class Store:
    """Ids of pieces one after the other, and by slots of their hashes where each piece's ids are."""

    def __init__(self, path: str) -> None:
        self.path = path
        vocabulary = tokenizer(path).get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)     # ids that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = id_type(path)
        self.ids = np.zeros(1 << 16, dtype=self.kind)
        self.key = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.begin, self.size = (np.zeros(1 << SLOT_BITS, dtype=np.int64) for _ in range(2))
        self.used = 0

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, size, ids) of pieces. Words of letters are encoded many at a time: each is one word to the
        tokenizer and ends with an id that ends a word; where the numbers differ, one at a time as all others.
        """
        model = tokenizer(self.path)
        texts = [p.decode("utf-8", "replace") for p in pieces]
        begin, size, parts, total = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), [], 0
        words, others = [], []
        for i, text in enumerate(texts):
            (words if text.isalpha() else others).append(i)
        for lo in range(0, len(words), JOINED):
            run = words[lo:lo + JOINED]
            ids = np.array(model.encode_batch_fast([" ".join([texts[i] for i in run])], add_special_tokens=False)[0].ids, dtype=self.kind)
            after = np.flatnonzero(self.ends[ids]) + 1
            if len(after) != len(run) or after[-1] != len(ids):
                others += run
                continue
            begin[run] = total + np.concatenate([[0], after[:-1]])
            size[run] = np.diff(after, prepend=0)
            parts.append(ids)
            total += len(ids)
        single: list[int] = []
        for lo in range(0, len(others), JOINED):
            run = others[lo:lo + JOINED]
            for i, found in zip(run, model.encode_batch_fast([texts[i] for i in run], add_special_tokens=False)):
                ids = found.ids
                begin[i], size[i] = total + len(single), len(ids)
                single += ids
        parts.append(np.array(single, dtype=self.kind))
        return begin, size, np.concatenate(parts)

    def look_up(self, words: Words, lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` the ids of each piece begin, and how many there are."""
        slot = (words.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        missing = np.flatnonzero((self.key[slot] != words.hashes) | (self.size[slot] == 0))
        begin, size = self.begin[slot], self.size[slot]
        if len(missing):
            hashes, first, which = np.unique(words.hashes[missing], return_index=True, return_inverse=True)
            new_begin, new_size, ids = self.encode(word_bytes(words, missing[first], lower).to_pylist())
            if self.used + len(ids) > len(self.ids):
                grown = np.zeros(2 * (self.used + len(ids)), dtype=self.kind)
                grown[:self.used] = self.ids[:self.used]
                self.ids = grown
            self.ids[self.used:self.used + len(ids)] = ids
            new_begin += self.used
            self.used += len(ids)
            begin[missing], size[missing] = new_begin[which], new_size[which]
            at = slot[missing[first]]
            self.key[at], self.begin[at], self.size[at] = hashes, new_begin, new_size      # of pieces in one slot the last stays
        return begin, size

    def forget_if_full(self) -> None:
        if self.used > MOST_IDS:
            self.size[:] = 0
            self.ids, self.used = np.zeros(1 << 16, dtype=self.kind), 0


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, ids, bounds) for runs of rows of a string column: row lo + i has ids[bounds[i]:bounds[i + 1]].

    Null and empty texts have no ids.
    """
    if path not in _stores:
        _stores[path] = Store(path)
    store = _stores[path]
    for lo, hi, words, lower in piece_blocks(column):
        store.forget_if_full()
        begin, size = store.look_up(words, lower)
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(begin - ends[:-1], size)
        at += np.arange(ends[-1])
        yield lo, hi, store.ids[at], ends[words.first]
