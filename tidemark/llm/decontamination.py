"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact confirmation.

An item and a window of as many words of a document are compared by the weighted similarity of their five-word
shingles (the smaller weights over the larger ones; a shingle weighs the bytes of its words, once per occurrence).
Words are lower-cased and split at white space and ASCII punctuation, so case and punctuation don't hide a passage.

Candidates come from 64-bit SimHash fingerprints. The 64 bits are cut into six blocks; fingerprints at most 23 bits
apart differ by at most three bits in some block, so an index of all block values within three bits of an item's finds
every item within that radius. A similarity of 0.8 means 9.7 bits on average with a deviation of 2.9. Windows that share
no shingle with any item have similarity 0, so only windows around such shingles get a fingerprint.

The work is one pass over the documents for each block of items; a block's index is broadcast and its size is bounded
by the words in a block, so the benchmark may be of any size. Nothing is shuffled, hot passages cannot skew it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.text import word_count
from tidemark.llm.tokens import Words, blocks, mix

SHINGLE = 5
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
BLOCK_RADIUS = 3
RADIUS = len(BLOCK_BITS) * (BLOCK_RADIUS + 1) - 1       # 23: all fingerprints within it are found
BLOCK_WORDS = 50_000                                    # words of items in one broadcast index
NEAR_PAIRS = 1 << 20                                    # windows and items compared at a time
FILTER_BITS = 20

_PLACES = np.random.default_rng(2203).integers(0, 2**64, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
_BITS = np.arange(64, dtype=np.uint64)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = max(len(hashes) - k + 1, 0)
    out = np.full(n, _PLACES[SHINGLE]) + np.uint64(k)
    for j in range(k):
        out += hashes[j:j + n] * _PLACES[j]
    return mix(out)


def gram_weights(words: Words, k: int) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    return upto[k:] - upto[:-k] if len(upto) > k else upto[:0]


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Bits of the positive sums, 64 per row."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def signed(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = (values[:, None] >> _BITS & np.uint64(1)).astype(np.int64)
    return (2 * bits - 1) * weights[:, None]


def weighted(values: np.ndarray, weights: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for v, w in zip(values.tolist(), weights.tolist()):
        out[v] += w
    return dict(out)


def similarity(x: dict[int, int], y: dict[int, int]) -> float:
    common = sum(min(w, y[v]) for v, w in x.items() if v in y)
    return common / (sum(x.values()) + sum(y.values()) - common) if common else 0.0


def block_values(prints: np.ndarray) -> np.ndarray:
    """Positions in the index of the blocks of each fingerprint."""
    out, low = [], 0
    for i, bits in enumerate(BLOCK_BITS):
        out.append((prints >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64) + (i << max(BLOCK_BITS)))
        low += bits
    return np.stack(out, axis=1)


class Index:
    """Items of one block: their shingles, fingerprints, and the table of block values within the radius."""

    def __init__(self, ids: list, texts: list[str | None]) -> None:
        self.ids, self.lengths, self.sets, prints, anchors = [], [], [], [], []
        for at, _, words in blocks(pa.array([t or "" for t in texts], pa.string()), plain=True):
            for i in range(len(words.first) - 1):
                lo, hi = words.first[i], words.first[i + 1]
                if hi == lo:
                    continue
                own = words._replace(hashes=words.hashes[lo:hi], starts=words.starts[lo:hi], ends=words.ends[lo:hi])
                k = min(SHINGLE, int(hi - lo))
                values, weights = grams(own.hashes, k), gram_weights(own, k)
                number = len(self.ids)
                self.ids.append(ids[at + i])
                self.lengths.append(int(hi - lo))
                self.sets.append(weighted(values, weights))
                prints.append(fingerprints(signed(values, weights).sum(axis=0, keepdims=True))[0])
                anchors += [(v, number) for v in self.sets[-1]]
        self.lengths = np.array(self.lengths, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint64)
        self.totals = np.array([sum(s.values()) for s in self.sets], dtype=np.int64)
        self.sizes = sorted(set(self.lengths.tolist()))
        self.shortest = sorted({min(SHINGLE, n) for n in self.sizes})
        by_anchor: dict[int, set[int]] = defaultdict(set)
        for value, number in anchors:
            by_anchor[value].add(int(self.lengths[number]))
        self.anchors = np.array(sorted(by_anchor), dtype=np.uint64)
        self.has_length = {n: np.array([n in by_anchor[v] for v in self.anchors.tolist()], dtype=bool) for n in self.sizes}
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self.anchors >> np.uint64(64 - FILTER_BITS)] = True
        self._table()

    def _table(self) -> None:
        """Items by block value and length: ``keys`` is sorted and ``members`` has the item of each key."""
        keys, members = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
        if len(self.prints):
            values, place = block_values(self.prints), np.searchsorted(self.sizes, self.lengths)
            for b, bits in enumerate(BLOCK_BITS):
                flips = [sum(1 << x for x in c) for r in range(BLOCK_RADIUS + 1) for c in combinations(range(bits), r)]
                for flip in flips:
                    keys.append((values[:, b] ^ flip) * len(self.sizes) + place)
                    members.append(np.arange(len(self.prints), dtype=np.int32))
        keys, members = np.concatenate(keys), np.concatenate(members)
        order = np.argsort(keys, kind="stable")
        self.keys, self.members = keys[order], members[order]

    def near(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) for all items of ``length`` words within RADIUS bits of the windows' fingerprints."""
        keys = block_values(prints) * len(self.sizes) + np.searchsorted(self.sizes, length)
        begins, ends = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
        upto, row, found = np.cumsum((ends - begins).sum(axis=1)), 0, [np.zeros((0, 2), dtype=np.int64)]
        while row < len(prints):
            done = upto[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(upto, done + NEAR_PAIRS, side="right")))
            begin, sizes = begins[row:to].reshape(-1), (ends - begins)[row:to].reshape(-1)
            window = np.repeat(np.arange(len(sizes)) // len(BLOCK_BITS) + row, sizes)
            at = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
            item = self.members[at]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            pair = np.unique(window[close] * len(self.prints) + item[close])
            found.append(np.stack([pair // len(self.prints), pair % len(self.prints)], axis=1))
            row = to
        both = np.concatenate(found)
        return both[:, 0], both[:, 1]

    def hits(self, words: Words, least: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, item, first word, words, similarity): the best window of each item found in each text."""
        for k in self.shortest:
            values = grams(words.hashes, k)
            if not len(values):
                continue
            maybe = np.flatnonzero(self.filter[values >> np.uint64(64 - FILTER_BITS)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(self.anchors, values[maybe]), len(self.anchors) - 1)
            exact = self.anchors[place] == values[maybe]
            maybe, place = maybe[exact], place[exact]
            owner = np.searchsorted(words.first, maybe, side="right") - 1
            inside = maybe + k <= words.first[owner + 1]
            maybe, place, owner = maybe[inside], place[inside], owner[inside]
            weights = gram_weights(words, k)
            for text in np.unique(owner):
                own = owner == text
                lo, hi = int(words.first[text]), int(words.first[text + 1])
                yield from self._text_hits(int(text), values[lo:hi - k + 1], weights[lo:hi - k + 1], maybe[own] - lo,
                                           place[own], k, least)

    def _text_hits(self, text, values, weights, at, place, k, least):
        total = np.concatenate([[0], np.cumsum(weights)])
        summed = None
        for length in self.sizes:
            if min(SHINGLE, length) != k or not self.has_length[length][place].any():
                continue
            span = min(length - k + 1, len(values))         # shingles in a window; a short text is one window
            last = len(values) - span
            anchored = at[self.has_length[length][place]]
            marks = np.zeros(last + 2, dtype=np.int64)
            np.add.at(marks, np.clip(anchored - span + 1, 0, last), 1)
            np.add.at(marks, np.minimum(anchored, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            if summed is None:
                from_, to = max(0, int(at.min()) - max(self.sizes)), min(len(values), int(at.max()) + max(self.sizes) + 1)
                region = signed(values[from_:to], weights[from_:to])
                summed = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(region, axis=0)])
            prints = fingerprints(summed[starts + span - from_] - summed[starts - from_])
            window, item = self.near(prints, length)
            for number in np.unique(item):
                mine, goal = starts[window[item == number]], self.sets[number]
                held = np.isin(values, np.fromiter(goal, dtype=np.uint64, count=len(goal)))
                common = np.concatenate([[0], np.cumsum(np.where(held, weights, 0))])
                most = common[mine + span] - common[mine]
                bound = most / (total[mine + span] - total[mine] + self.totals[number] - most)
                best, where = 0.0, -1
                for j in np.lexsort((mine, -bound)):        # the bound is the similarity unless shingles repeat
                    if bound[j] < max(least, best) or bound[j] == best:
                        break
                    s = int(mine[j])
                    got = similarity(weighted(values[s:s + span], weights[s:s + span]), goal)
                    if got > best:
                        best, where = got, s
                if best >= least:
                    yield text, int(number), where, span + k - 1, best


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS):
    """Indexes of the items, each of about ``block_words`` words, built one at a time."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(word_count(F.col("text"))).alias("n")).first().n or 0
    count = -(-total // block_words)
    for b in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).collect()     # one bounded block
        own.sort(key=lambda r: (r.item_id is not None, r.item_id, r.text or ""))
        yield Index([r.item_id for r in own], [r.text for r in own])


def find_passages(docs: DataFrame, items: DataFrame, least: float = 0.8, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): each item found in each document, at its best window.

    Whole texts are searched. Items and documents without words match nothing; items of fewer than five words have
    their whole word sequence as the one shingle; a document shorter than the item is one window. Equal windows: the
    first. Rows with equal or null ids are searched like any other; other columns are not read; an empty table of
    documents or items gives no rows.
    """
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    fields = f"doc_id {kinds[0]}, item_id {kinds[1]}, first_word long, n_words long, similarity double"
    source = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"))
    item_type = to_arrow_type(items.schema[item_col].dataType)
    found = docs.sparkSession.createDataFrame([], fields)

    for index in item_blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = [(lo + t, index.ids[i], s, n, round(x, 6)) for lo, _, words in blocks(batch.column(0), plain=True)
                        for t, i, s, n, x in index.hits(words, least)]
                row, item, start, n, similar = zip(*rows) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(row, pa.int64())), pa.array(item, item_type),
                     pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(similar, pa.float64())],
                    ["doc_id", "item_id", "first_word", "n_words", "similarity"])

        found = found.unionByName(source.mapInArrow(search, fields))
    return found


def without_passages(docs: DataFrame, items: DataFrame, least: float = 0.8, text_col: str = "text",
                     item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns; a row is judged by itself."""
    for index in item_blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        at = docs.columns.index(text_col)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                bad = {lo + hit[0] for lo, _, words in blocks(batch.column(at), plain=True)
                       for hit in index.hits(words, least)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
