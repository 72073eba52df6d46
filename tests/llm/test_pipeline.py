"""The pipeline against its stages worked out by brute force, and its stages on messy and empty tables."""
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_text_operators import FOLDER, brute_components, brute_passages, rows_of

from tidemark.llm import mixing


def test_pipeline_equals_brute_force(workers):
    docs = workers.read.parquet(f"{FOLDER}/documents.parquet")
    rows = rows_of(docs, "doc_id", "text")
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    kept = [(i, t) for (i, t) in rows]
    least = {i: c for i, _, c in brute_components(kept, 5)}
    kept = [(i, t) for i, t in kept if least[i] == i]
    leaked = {d for d, _ in brute_passages(kept, rows_of(workers.read.parquet(f"{FOLDER}/benchmark.parquet"), "item_id", "text"))}
    kept = [(i, t) for i, t in kept if i not in leaked]
    left = docs.where(docs.doc_id.isin([i for i, _ in kept]))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, start = [], 0
    texts = dict(kept)
    for r in sorted(mixing.mix(left).collect()):
        for _ in range(r.taken // r["size"] if r["size"] else 0):
            ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
            expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(workers, FOLDER)
    assert sorted(rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32")) == expected


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_on_messy_and_empty_tables(workers, messy, empty, place):
    name, stage = corpus_pipeline.STAGES[place]
    out = stage(workers, messy, FOLDER)
    if place < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == messy.columns and out.count() > 0
    else:
        assert out.count() == messy.count()
    assert stage(workers, empty, FOLDER).collect() == []


def test_one_row_of_repeated_rows_stays(workers, messy):
    kept = Counter(r.doc_id for r in corpus_pipeline.one_of_each(workers, messy, FOLDER).collect())
    assert kept[None] == 2 and kept[7] == kept[8] == kept[10] == 0      # a null id comes first in the group of copies
