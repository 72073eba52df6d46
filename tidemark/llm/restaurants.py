"""The restaurants of one block of contexts: their rows, a sweep over them, and the probabilities of their words.

A block has all occurrences whose word before falls into it, so the restaurants of two words and of one word lie in it whole.
What joins blocks is the root: a block sends the tables of its words to the words' parts and gets back the words'
customers and tables there. A word before that is too frequent for one block (heavy) has several, its pieces, by the word before
that; what joins these is their unit, which has the restaurant of the heavy word, stands between them and the root like a
block, and sends the pieces back their words' customers and tables in it. A word seen once after a context has one table whatever is drawn, so a sweep holds the rows of
two customers or more only (``Sweep``) and of all others their sums.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tidemark.llm.packed import pack, unpack
from tidemark.llm.seating import STRENGTHS, Stirling, draw
from tidemark.llm.tokens import mix

BEFORE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25)
_LEVELS = np.uint64(1 << 20), np.uint64(2 << 20)
_PART = np.uint64(0xD6E8FEB86659FD93)


class Given(NamedTuple):
    """What holds for all restaurants during a sweep: discounts by level, customers and tables of the root, words learned."""

    discounts: tuple[float, float, float]
    customers: int
    tables: int
    learned: int
    distinct: int

    def root(self, r: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Probabilities in the root of words with r customers at t tables."""
        (s, _, _), (d, _, _) = STRENGTHS, self.discounts
        return np.maximum(r - d * t, 0.0) / (s + self.customers) + (s + d * self.tables) / (s + self.customers) / (self.distinct + 1)


def two_before(one: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(one * BEFORE[0] + mix(before * BEFORE[1] + np.uint64(1)))


def sums(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.rint(np.bincount(places, weights=values, minlength=size)).astype(np.int64)


def grouped(first: np.ndarray, second: np.ndarray, sizes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and which of them each row is."""
    pairs, which = np.unique(first * np.int64(sizes) + second, return_inverse=True)
    return (pairs // max(sizes, 1)).astype(np.int32), (pairs % max(sizes, 1)).astype(np.int32), which.astype(np.int32)


def predicted(customers, tables, of_all, tables_of_all, parent, discount: float, strength: float) -> np.ndarray:
    own = np.maximum(customers - discount * tables, 0.0)
    return (own + (strength + discount * tables_of_all) * parent) / (strength + of_all)


class Rows:
    """Rows of a block in order of the word before, the word before that and the word.

    ``one``, ``two``: numbers of the contexts, ``word``: place in the block's words, ``n``: customers; ``mid``: place among the
    pairs of word before (``mid_one``) and word (``mid_word``), ``most``: learned occurrences of each pair.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, n: np.ndarray, words: int) -> None:
        self.one, self.two, self.word, self.n, self.words = one, two, word, n, words
        self.mid_one, self.mid_word, self.mid = grouped(one, word, words)
        self.most = sums(self.mid, n, len(self.mid_one))
        self.again, self.mid_again = np.flatnonzero(n > 1), np.flatnonzero(self.most > 1)


def parted(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of words by the parts they belong to, bounds of the parts in it)."""
    part = (mix(hashes ^ _PART) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def by_part(bounds: np.ndarray, *values: np.ndarray) -> list[tuple[int, bytes]]:
    return [(p, pack(*(x[lo:hi] for x in values))) for p, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if hi > lo]


def built(blobs: list[bytes], frequent: np.ndarray, parts: int, named: bool,
          unit: int | None) -> tuple[bytes, bytes, list[tuple[int, bytes]], list[tuple[int, bytes]], int, int]:
    """(rows, sweep, words by part, words for the unit, rows of one customer, of two) of a block from what was sent to it.

    ``frequent`` are the hashes of the numbers that all senders share (the start is the first). ``named``: rows keep hashes.
    ``unit``: that of a piece.
    """
    sent = sorted((unpack(b) for b in blobs), key=lambda x: x[6][0])
    rare, number = np.unique(np.concatenate([np.cumsum(x[0].astype(np.uint64)) for x in sent]), return_inverse=True)
    hashes, shared, at, texts = np.concatenate([frequent, rare]), len(frequent), 0, []
    for x in sent:
        new = np.concatenate([np.arange(shared), shared + number[at:at + len(x[0])]]).astype(np.int32)
        at += len(x[0])
        x[1:4] = [new[ids] for ids in x[1:4]]
        opens = np.concatenate([[True], x[5][1:] > 0])                # a text is in one task, so it is in one of these
        known = sum(map(len, texts))
        texts.append((x[6][0] + np.cumsum(x[5]))[opens])
        x[5] = known + np.cumsum(opens, dtype=np.int32) - 1
    word, one, before, n, text = (np.concatenate([x.pop(1) for x in sent]) for _ in range(5))
    texts = np.concatenate(texts)
    used = np.flatnonzero(np.bincount(one, minlength=len(hashes)))
    place = np.zeros(len(hashes), np.int32)
    place[used] = np.arange(len(used))
    one = place[one]
    if len(used) * len(hashes) ** 2 < 1 << 63:
        key = one * np.int64(len(hashes))
        key += before
        key *= len(hashes)
        key += word
        order = np.argsort(key)
        del key
    else:
        order = np.lexsort((word, before, one))
    word, one, before = word[order], one[order], before[order]
    opens_two = np.concatenate([[True], (one[1:] != one[:-1]) | (before[1:] != before[:-1])])
    opens = np.flatnonzero(opens_two | np.concatenate([[True], word[1:] != word[:-1]]))
    count, n = np.diff(np.append(opens, len(word))), np.add.reduceat(n[order], opens)
    names = (hashes[word[opens]], hashes[before[opens]])
    word, one, before, opens_two = word[opens], one[opens], before[opens], opens_two[opens]
    text = text[order]
    del order
    # the block's words in the order of the parts they belong to
    ids = np.flatnonzero(np.bincount(word, minlength=len(hashes)))
    order, bounds = parted(hashes[ids], parts)
    place = np.zeros(len(hashes), np.int32)
    place[ids[order]] = np.arange(len(ids))
    own, word = hashes[ids[order]], place[word]
    rows = Rows(one, np.cumsum(opens_two, dtype=np.int32) - 1, word, n, len(ids))
    learned = sums(word, n, len(ids))
    lists = by_part(bounds, own, learned)
    kept = pack(np.array([len(ids)]), np.diff(one, prepend=0), opens_two, word, count, n, np.diff(texts, prepend=0), text,
                *(names if named else ()))
    # of the rows of one customer: their sums
    twos, two = np.unique(rows.two[rows.again], return_inverse=True)
    first_of_two = np.flatnonzero(opens_two)[twos]
    ones, mid_one = np.unique(rows.mid_one[rows.mid_again], return_inverse=True)
    alone, once = n == 1, rows.most == 1
    if unit is not None:                                            # all rows have one word before, so mids are the words
        sweep = pack(n[rows.again], two, word[rows.again], two_before(hashes[used[one[first_of_two]]], hashes[before[first_of_two]]),
                     sums(rows.two, alone, len(rows.two))[twos], sums(word, alone, len(ids)))
        up = [(unit, pack(own, learned, hashes[used]))]
        return kept, sweep, lists, up, int(alone.sum()), int((n == 2).sum())
    sweep = pack(np.array([int(once.sum())]),
                 n[rows.again], two, np.searchsorted(rows.mid_again, rows.mid[rows.again]),
                 two_before(hashes[used[one[first_of_two]]], hashes[before[first_of_two]]),
                 sums(rows.two, alone, len(rows.two))[twos],
                 mid_one, rows.mid_word[rows.mid_again], sums(rows.mid, alone, len(rows.most))[rows.mid_again],
                 hashes[used[ones]], sums(rows.mid_one, once, len(used))[ones],
                 sums(rows.mid_word, once, len(ids)))
    return kept, sweep, lists, [], int(alone.sum()), int((n == 2).sum())


def names_of(lists: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of a block's words, their numbers by part)."""
    names = [unpack(x)[0].astype(np.uint64) for _, x in lists]
    return np.concatenate(names) if names else np.zeros(0, np.uint64), [len(x) for x in names]


def to_parts(lists: list[tuple[int, bytes]], sizes: list[int], values: np.ndarray) -> list[tuple[int, bytes]]:
    ends = np.cumsum(sizes, dtype=np.int64)
    return [(part, pack(values[end - size:end])) for (part, _), size, end in zip(lists, sizes, ends)]


def swept_piece(sweep: bytes, lists: list[tuple[int, bytes]], state: list[np.ndarray] | None, at_root: list[np.ndarray],
                of_unit: list[np.ndarray] | None, unit: int, given: Given,
                number: int) -> tuple[bytes, list[tuple[int, bytes]], list[tuple[int, bytes]], int, int]:
    """Like ``swept`` for a piece: its words' tables go to the unit, which counts the pairs of one and of two."""
    n, two, word, two_hash, two_alone, alone = unpack(sweep)
    (hashes, sizes), (_, s1, s2), (_, d1, d2) = names_of(lists), STRENGTHS, given.discounts
    t = state[0] if state else np.ones(len(n), np.int64)
    if of_unit is None:
        p1 = at_root[0] / max(given.learned, 1)
    else:
        p1 = predicted(*of_unit, given.root(*at_root), d1, s1)
    k2 = two_alone + sums(two, t, len(two_alone))
    seeds = mix(hashes[word] + mix(two_hash.astype(np.uint64)[two] + _LEVELS[1]))
    t = draw(n, k2[two] - t, p1[word], s2, Stirling(d2), seeds, number)
    m = alone + sums(word, t, len(alone))
    return pack(t), to_parts(lists, sizes, np.zeros(len(alone), np.int64)), [(unit, pack(m))], 0, 0


def united(sent: list[tuple[int, bytes]], parts: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    """(words, words by part) of a unit from the words that its pieces sent, in the order of the pieces."""
    got = [unpack(x) for _, x in sent]
    words, number = np.unique(np.concatenate([x[0] for x in got]).astype(np.uint64), return_inverse=True)
    most = sums(number, np.concatenate([x[1] for x in got]), len(words))
    order, bounds = parted(words, parts)
    place = np.argsort(order)
    data = pack(got[0][2].astype(np.uint64), most[order], place[number], np.array([b for b, _ in sent]), np.array([len(x[0]) for x in got]))
    return data, by_part(bounds, words[order], np.zeros(len(words), np.int64))


def swept_unit(data: bytes, lists: list[tuple[int, bytes]], state: list[np.ndarray] | None, at_root: list[np.ndarray],
               sent: list[np.ndarray], given: Given,
               number: int) -> tuple[bytes, list[tuple[int, bytes]], list[tuple[int, bytes]], int, int]:
    """(tables, tables by part, what each piece's words have, words of one customer, of two) after a sweep over a unit."""
    one_hash, most, which, blocks, pieces = unpack(data)
    (hashes, sizes), (_, s1, _), (_, d1, _) = names_of(lists), STRENGTHS, given.discounts
    p0 = at_root[0] / max(given.learned, 1) if state is None else given.root(*at_root)
    t = state[0] if state else (most > 0).astype(np.int64)
    m = sums(which, sent[0], len(most))
    t = draw(m, t.sum() - t, p0, s1, Stirling(d1), mix(hashes + mix(one_hash.astype(np.uint64) + _LEVELS[0])), number)
    totals = [np.full(len(m), x.sum()) for x in (m, t)]
    return pack(t), to_parts(lists, sizes, t), back([m, t, *totals], which, blocks, pieces), int((m == 1).sum()), int((m == 2).sum())


def swept(sweep: bytes, lists: list[tuple[int, bytes]], state: list[np.ndarray] | None, at_root: list[np.ndarray], given: Given,
          number: int) -> tuple[bytes, list[tuple[int, bytes]], list[tuple[int, bytes]], int, int]:
    """(tables, tables of the words by part, nothing for a unit, pairs of one customer, of two) after a sweep over a block.

    ``at_root``: the words' customers and tables there, before the first sweep their frequencies; ``state``: the last tables.
    """
    (once,), n, two, mid, two_hash, two_alone, mid_one, mid_word, mid_alone, one_hash, one_once, word_once = unpack(sweep)
    (hashes, sizes), (_, s1, s2), (_, d1, d2) = names_of(lists), STRENGTHS, given.discounts
    t, mid_t = state or (np.ones(len(n), np.int64), np.ones(len(mid_word), np.int64))
    k1 = one_once + sums(mid_one, mid_t, len(one_once))
    if state is None:
        p0 = (at_root[0] / max(given.learned, 1))[mid_word]
        p1 = p0
    else:
        p0 = given.root(*at_root)[mid_word]
        m = mid_alone + sums(mid, t, len(mid_alone))
        c1 = one_once + sums(mid_one, m, len(one_once))
        p1 = predicted(m, mid_t, c1[mid_one], k1[mid_one], p0, d1, s1)
    k2 = two_alone + sums(two, t, len(two_alone))
    seeds = mix(hashes[mid_word[mid]] + mix(two_hash.astype(np.uint64)[two] + _LEVELS[1]))
    t = draw(n, k2[two] - t, p1[mid], s2, Stirling(d2), seeds, number)
    m = mid_alone + sums(mid, t, len(mid_alone))
    seeds = mix(hashes[mid_word] + mix(one_hash.astype(np.uint64)[mid_one] + _LEVELS[0]))
    mid_t = draw(m, k1[mid_one] - mid_t, p0, s1, Stirling(d1), seeds, number)
    r = word_once + sums(mid_word, mid_t, len(word_once))
    return pack(t, mid_t), to_parts(lists, sizes, r), [], int(once) + int((m == 1).sum()), int((m == 2).sum())


def rows_of(kept: bytes) -> tuple[Rows, list[np.ndarray]]:
    (words,), one, opens_two, word, count, n, texts, text, *names = unpack(kept)
    return Rows(np.cumsum(one, dtype=np.int32), np.cumsum(opens_two, dtype=np.int32) - 1, word, n, int(words)), [count, np.cumsum(texts), text, *names]


def probabilities(rows: Rows, state: list[np.ndarray], at_root: list[np.ndarray], of_unit: list[np.ndarray] | None,
                  given: Given) -> np.ndarray:
    """The probability of each row's word after its context; ``of_unit``: what the unit sent to a piece."""
    (_, s1, s2), (_, d1, d2) = STRENGTHS, given.discounts
    t = (rows.n > 0).astype(np.int32)
    t[rows.again] = state[0]
    if of_unit is None:
        mid_t = (rows.most > 0).astype(np.int32)
        mid_t[rows.mid_again] = state[1]
        m = sums(rows.mid, t, len(rows.most))
        of_unit = [m, mid_t, *(sums(rows.mid_one, x, 1)[rows.mid_one] for x in (m, mid_t))]
    p1 = predicted(*of_unit, given.root(*at_root)[rows.mid_word], d1, s1)
    totals = [sums(rows.two, x, 1)[rows.two] for x in (rows.n, t)]
    return predicted(rows.n, t, *totals, p1[rows.mid], d2, s2)


def rooted(lists: list[tuple[int, bytes]]) -> tuple[bytes, list[tuple[int, bytes]]]:
    """(words, frequencies by block) of a part from the words that blocks sent, in the order of the blocks."""
    sent = [unpack(x) for _, x in lists]
    words, number = np.unique(np.concatenate([x[0] for x in sent]).astype(np.uint64), return_inverse=True)
    trained = sums(number, np.concatenate([x[1] for x in sent]), len(words))
    sizes = np.array([len(x[0]) for x in sent])
    blocks = np.array([b for b, _ in lists])
    return pack(words, trained, number, blocks, sizes), back([trained], number, blocks, sizes)


def back(values: list[np.ndarray], number: np.ndarray, blocks: np.ndarray, sizes: np.ndarray) -> list[tuple[int, bytes]]:
    ends = np.cumsum(sizes)
    return [(int(b), pack(*(x[number[end - size:end]] for x in values))) for b, size, end in zip(blocks, sizes, ends)]


def seated_at_root(part: bytes, state: list[np.ndarray] | None, sent: list[np.ndarray], given: Given,
                   number: int) -> tuple[bytes, list[tuple[int, bytes]], int, int, int, int]:
    """(tables, customers and tables by block, words of one customer, of two, customers, tables) of a part after a sweep."""
    words, trained, which, blocks, sizes = unpack(part)
    r = sums(which, sent[0], len(words))
    t = state[0] if state else (trained > 0).astype(np.int64)
    parent = np.full(len(words), 1.0 / (given.distinct + 1))
    seeds = mix(words.astype(np.uint64) + mix(np.zeros(len(words), np.uint64)))
    t = draw(r, given.tables - t, parent, STRENGTHS[0], Stirling(given.discounts[0]), seeds, number)
    return pack(t), back([r, t], which, blocks, sizes), int((r == 1).sum()), int((r == 2).sum()), int(r.sum()), int(t.sum())
