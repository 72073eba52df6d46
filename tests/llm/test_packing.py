"""Packing against the rules of its result and a sequential best-fit-decreasing, and the one-pass encoder."""
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import encoding, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        if room > n:
            insort(rooms, room - n)
        else:
            insort(rooms, 0)
    return len(rooms)


def packed(spark, lengths, capacity):
    df = spark.createDataFrame([(i, n, 1, 2) for i, n in enumerate(lengths)], "id long, length int, sequence int, room int").repartition(4)
    rows = packing.pack(df, capacity).collect()
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("name, capacity, lengths", [
    ("even", 2048, [random.Random(i).randint(1, 2048) for i in range(3000)]),
    ("short", 2048, [random.Random(i).randint(1, 300) for i in range(3000)]),
    ("a third alike", 512, [171] * 500 + [random.Random(i).randint(1, 512) for i in range(1000)]), ("full", 8, [8] * 9 + [1]),
])
def test_packs_like_best_fit(workers, name, capacity, lengths):
    got, best = packed(workers, lengths, capacity), best_fit(lengths, capacity)
    assert -(-sum(lengths) // capacity) <= got <= best * 1.01 + 2, (got, best)


def test_sweep_is_a_stack():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 400):
        kinds = rng.integers(0, 2, n)
        takes, over = packing.sweep(kinds, kinds, kinds)
        stack, expected = [], np.full(n, -1)
        for i, kind in enumerate(kinds):
            if kind == 0:
                stack.append(i)
            elif stack:
                expected[i] = stack.pop()
        left = sorted([i for i in range(n) if kinds[i] == 1 and expected[i] < 0] + stack)
        assert takes.tolist() == expected.tolist() and over.tolist() == left


def plain_pieces(rows, capacity):
    model = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        out += [(doc_id, i, lo, len(ids[lo:lo + capacity]), zlib.crc32(ids[lo:lo + capacity].tobytes()))
                for i, lo in enumerate(range(0, len(ids), capacity))]
    return out


@pytest.mark.parametrize("capacity", [2048, 100])
def test_documents_equal_the_tokenizer(messy, capacity):
    docs = messy.withColumn("sequence_id", F.lit(1)).withColumn("start", F.lit(1))
    rows = packing.pack_documents(docs, PATH, capacity).collect()
    key = lambda r: (r[0] is not None, *map(lambda x: x or 0, r))
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(plain_pieces([(r.doc_id, r.text) for r in messy.collect()], capacity), key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in s) <= capacity and sorted(s)[0][0] == 0 for s in sequences.values())
    whole = {r.sequence_id: r for r in packing.packed_ids(docs, PATH, capacity).collect()}
    assert sum(r.n_ids for r in whole.values()) == sum(r.length for r in rows) and all(len(r.ids) == 4 * r.n_ids for r in whole.values())


def test_empty(empty):
    assert packing.pack_documents(empty, PATH).collect() == [] and packing.packed_ids(empty, PATH).collect() == []


def test_encoder_keeps_ids_with_a_tiny_table(monkeypatch, messy):
    monkeypatch.setattr(encoding, "SLOT_BITS", 3)
    monkeypatch.setattr(encoding, "MOST_IDS", 50)
    monkeypatch.setattr(encoding, "_stores", {})
    texts = [r.text for r in messy.select("text").collect()] + ["İİ abc", "naïve don't I'LL", "ﬁne ǅ ß", "a" * 300, "ab1c 2.5, x."]
    model = Tokenizer.from_file(PATH)
    for _ in range(2):
        for lo, hi, ids, bounds in encoding.encoded(pa.array(texts), PATH):
            for i in range(lo, hi):
                assert ids[bounds[i - lo]:bounds[i - lo + 1]].tolist() == model.encode(texts[i] or "", add_special_tokens=False).ids
