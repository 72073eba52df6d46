"""Distinct pieces of a corpus and what a tokenizer makes of each, worked out once per piece.

A piece is a run of bytes other than ASCII white space, but for a full stop or comma that ends it after a letter, which
is a piece of its own; A-Z are lower-cased. The tokenizer used here lower-cases, drops white space and never joins text
across these borders, so the ids of a text are the ids of its pieces, one after the other (tested against whole
texts). Only its special strings depend on the case; blocks of texts with ``<|`` keep it.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import Words, blocks, word_bytes
from tidemark.sources.store import settle

FLUSH_PIECES = 1 << 20      # distinct pieces, summed over blocks, that a task holds before it sends their counts on
ENCODE_ROWS = 4_096
SPECIAL = b"<|"

_tokenizers: dict = {}


def tokenizer(path: str):
    """The tokenizer of a file, one per worker process."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
        _tokenizers[path].no_truncation()
        _tokenizers[path].no_padding()
    return _tokenizers[path]


def encode_pieces(path: str, pieces: list[bytes]) -> list[list[int]]:
    texts = [p.decode("utf-8", "replace") for p in pieces]
    return [e.ids for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


class Pieces(NamedTuple):
    """Pieces of rows lo to hi of a column: distinct hashes, where each first stands, and which one each piece is."""

    lo: int
    hi: int
    words: Words
    distinct: np.ndarray
    first: np.ndarray
    which: np.ndarray
    lower: bool

    def bytes_of(self, chosen: np.ndarray) -> pa.Array:
        return word_bytes(self.words, self.first[chosen], self.lower)


def piece_blocks(column: pa.Array) -> Iterator[tuple[int, int, Words, bool]]:
    """(lo, hi, pieces, lower) for runs of rows; where texts have special strings, ``lower`` is false and each is alone."""
    for lo, hi, words in blocks(column, lower=True, cut=True):
        lower = words.data.tobytes().find(SPECIAL) < 0
        if not lower:
            part = column.slice(lo, hi - lo)
            words = next(blocks(part, lower=False, cut=True))[2] if hi - lo == 1 else words
            if hi - lo > 1:         # row by row, so that only texts with special strings keep their case
                for i in range(hi - lo):
                    yield from ((lo + i, lo + i + 1, w, kept) for _, _, w, kept in piece_blocks(part.slice(i, 1)))
                continue
        yield lo, hi, words, lower


def pieces_of(column: pa.Array) -> Iterator[Pieces]:
    for lo, hi, words, lower in piece_blocks(column):
        distinct, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        yield Pieces(lo, hi, words, distinct.view(np.int64), first, which, lower)


def distinct_pieces(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, freq): every distinct piece of all texts and how often it occurs; counted in tasks, then summed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            hashes = np.concatenate([x[0] for x in held]) if held else np.zeros(0, np.int64)
            counts = np.concatenate([x[1] for x in held]) if held else np.zeros(0, np.int64)
            words = pa.concat_arrays([x[2] for x in held]) if held else pa.array([], pa.binary())
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            held.clear()
            n = np.bincount(which, counts, minlength=len(first)).astype(np.int64)
            return pa.RecordBatch.from_arrays([words.take(pa.array(first)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for block in pieces_of(batch.column(0)):
                everything = np.arange(len(block.distinct))
                held.append((block.distinct, np.bincount(block.which, minlength=len(everything)), block.bytes_of(everything)))
                waiting += len(everything)
                if waiting > FLUSH_PIECES:
                    yield flush()
                    waiting = 0
        yield flush()

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("freq"))


def encoded_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(word, key, freq, n_ids, ids): each distinct piece encoded once; ids as little-endian 16-bit, so ids < 65,536.

    ``key`` is the hash by which ``pieces_of`` knows the piece.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                part = batch.slice(at, ENCODE_ROWS)
                ids = encode_pieces(path, part.column(0).to_pylist())
                keys = np.concatenate([w.hashes for _, _, w in blocks(part.column(0), lower=False)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys), part.column(1), pa.array(map(len, ids), pa.int64()),
                     pa.array([np.array(x, "<u2").tobytes() for x in ids], pa.binary())],
                    ["word", "key", "freq", "n_ids", "ids"])

    fields = "word binary, key long, freq long, n_ids long, ids binary"
    return distinct_pieces(docs, text_col).mapInArrow(encode, fields)


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The words above a frequency chosen so that there are at most ``most`` of them; nothing is sorted.

    Frequencies are put into classes a sixteenth of an octave wide; whole classes are taken from the top.
    """
    klass = F.floor(F.log2("freq") * 16).cast("int")
    sizes = words.groupBy(klass.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()     # about a thousand at most
    taken, least = 0, math.inf
    for row in sorted(sizes, reverse=True):
        if taken + row.n > most:
            break
        taken, least = taken + row.n, row.c
    return words.where(klass >= F.lit(least if least < math.inf else 1 << 30).cast("int"))


class Table:
    """Keys of pieces in order, with their numbers of ids and, if wanted, the ids."""

    def __init__(self, rows: DataFrame, with_ids: bool) -> None:
        table = rows.select("key", "n_ids", *["ids"] * with_ids).toArrow()         # as many rows as ``frequent`` allows
        key = table.column("key").to_numpy()
        order = np.argsort(key)
        self.keys, self.sizes = key[order], table.column("n_ids").to_numpy()[order].astype(np.int32)
        self.ids = np.zeros(0, "<u2")
        if with_ids:
            self.ids = np.frombuffer(b"".join(table.column("ids").take(pa.array(order)).to_pylist()), "<u2")
        self.begins: np.ndarray | None = None

    def find(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of sorted or unsorted keys, and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=bool)
        place = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return place, self.keys[place] == distinct

    def begin(self) -> np.ndarray:
        if self.begins is None:
            self.begins = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])
        return self.begins


def settled_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    return settle(encoded_pieces(docs, path, text_col), "pieces")
