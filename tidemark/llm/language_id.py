"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and 1, drawn from its code point. The vector of an n-gram binds (multiplies)
its letters' vectors, each permuted (rolled) by its place; a text's profile bundles (adds) the vectors of its
n-grams; a language's prototype bundles its training texts. A text gets the language of the prototype with the
largest cosine. Texts are lower-cased; everything between letters is one boundary symbol with a vector of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
NGRAM = 3
UNKNOWN = "und"
BLOCK_TEXTS, BLOCK_CHARS = 128, 1 << 19
NGRAMS_AT_ONCE = 4096
ENOUGH_NGRAMS = 64          # about ten words
MOST_LETTERS = 4096         # letter vectors a worker holds

_letters: dict[int, np.ndarray] = {}
_folds: list[np.ndarray] = []


def folded() -> np.ndarray:
    """For every code point the lower-case letter's code point, or 0 if it is no letter."""
    if not _folds:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                table[c] = ord(x.lower()[0])
        _folds.append(table)
    return _folds[0]


def letter_vector(code: int) -> np.ndarray:
    if code not in _letters:
        if len(_letters) >= MOST_LETTERS:
            _letters.clear()
        bits = np.random.Generator(np.random.PCG64([411, int(code)])).integers(0, 2, DIMENSIONS, dtype=np.int8)
        _letters[code] = bits * np.int8(2) - np.int8(1)
    return _letters[code]


class Block:
    """The n-grams of some texts: distinct ones as rows of letter places, and counts by text."""

    def __init__(self, texts: list[str]) -> None:
        fold = folded()
        codes, sizes = [], []
        for text in texts:
            x = fold[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
            x = np.concatenate([[0], x, [0]]).astype(np.uint32)
            x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]      # one boundary between letters
            codes.append(x)
            sizes.append(max(len(x) - NGRAM + 1, 0) if len(x) >= NGRAM else 0)
        joined = np.concatenate(codes)
        self.alphabet, local = np.unique(joined, return_inverse=True)
        letters, width, at = len(self.alphabet), [], 0
        grams = []
        for x, n in zip(codes, sizes):
            own = local[at:at + len(x)].astype(np.int64)
            at += len(x)
            gram = np.zeros(n, dtype=np.int64)
            for j in range(NGRAM):
                gram = gram * letters + own[j:j + n]
            grams.append(gram)
        gram = np.concatenate(grams)
        owner = np.repeat(np.arange(len(texts)), sizes)
        if letters ** NGRAM <= 1 << 22:
            present = np.zeros(letters ** NGRAM, dtype=bool)
            present[gram] = True
            distinct = np.flatnonzero(present)
            place = np.cumsum(present) - 1
            column = place[gram]
        else:
            distinct, column = np.unique(gram, return_inverse=True)
        self.sizes = np.array(sizes)
        self.owner, self.column, self.distinct = owner, column, distinct

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(counts by text and n-gram, n-gram vectors), a bounded number of n-grams at a time."""
        letters = len(self.alphabet)
        base = np.stack([letter_vector(c) for c in self.alphabet]) if letters else np.zeros((0, DIMENSIONS), np.int8)
        rolled = [np.roll(base, NGRAM - 1 - j, axis=1) for j in range(NGRAM)]
        for at in range(0, len(self.distinct), NGRAMS_AT_ONCE):
            own = self.distinct[at:at + NGRAMS_AT_ONCE]
            vectors = np.ones((len(own), DIMENSIONS), dtype=np.int8)
            for j in range(NGRAM):
                vectors *= rolled[j][own // letters ** (NGRAM - 1 - j) % letters]
            inside = (self.column >= at) & (self.column < at + len(own))
            flat = self.owner[inside] * len(own) + self.column[inside] - at
            counts = np.bincount(flat, minlength=len(self.sizes) * len(own)).reshape(len(self.sizes), len(own))
            yield counts, vectors.astype(np.float32)


def text_blocks(texts: list[str | None]) -> Iterator[tuple[int, Block]]:
    """(first row, block) over all rows; null counts as empty."""
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and to - at < BLOCK_TEXTS and (to == at or chars + len(texts[to] or "") <= BLOCK_CHARS):
            chars += len(texts[to] or "")
            to += 1
        yield at, Block([t or "" for t in texts[at:to]])
        at = to


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their bundled vectors, from all rows of (text, lang). One row per language returns.

    Vectors are sums of counts, so they are whole numbers and the same in every run.
    """
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, block in text_blocks(texts):
                own = langs[at:at + len(block.sizes)]
                names = sorted(set(own))
                member = np.array([[x == y for y in own] for x in names], dtype=np.float64)
                for counts, vectors in block.parts():
                    add = (member @ counts).astype(np.float32) @ vectors
                    for name, row in zip(names, add):
                        sums[name] = sums.get(name, 0) + row.astype(np.int64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, DIMENSIONS).tolist(), pa.string()),
             pa.array(np.tile(np.arange(DIMENSIONS), len(names)), pa.int32()),
             pa.array(np.concatenate([sums[x] for x in names]) if names else [], pa.int64())],
            ["lang", "dimension", "value"])

    parts = labelled.select("text", "lang").mapInArrow(bundle, "lang string, dimension int, value long")
    summed = parts.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toArrow()
    names = sorted(set(summed.column("lang").to_pylist()))
    out = np.zeros((len(names), DIMENSIONS))
    index = {x: i for i, x in enumerate(names)}
    rows = [index[x] for x in summed.column("lang").to_pylist()]
    out[rows, summed.column("dimension").to_numpy()] = summed.column("value").to_numpy()
    return names, out


class Guesser:
    """Nearest prototypes of texts; one unit vector per language."""

    def __init__(self, names: list[str], profiles: np.ndarray) -> None:
        norms = np.linalg.norm(profiles, axis=1, keepdims=True)
        self.names, self.units = names, (profiles / np.where(norms == 0, 1, norms)).astype(np.float32)

    def guess(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and cosines. Ties go to the first language by name; negative cosines count as 0."""
        return self.measured(texts)[:2]

    def measured(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and numbers of n-grams."""
        langs: list[str] = []
        scores, sizes = [], []
        for _, block in text_blocks(texts):
            n = len(block.sizes)
            sizes.append(block.sizes)
            if not self.names:
                langs += [UNKNOWN] * n
                scores.append(np.zeros(n))
                continue
            profile = np.zeros((n, DIMENSIONS), dtype=np.float32)
            for counts, vectors in block.parts():
                profile += counts.astype(np.float32) @ vectors
            length = np.sqrt((profile.astype(np.float64) ** 2).sum(axis=1))
            cosine = profile @ self.units.T / np.where(length == 0, 1, length)[:, None]
            best, known = cosine.argmax(axis=1), block.sizes > 0
            langs += [self.names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.clip(cosine[np.arange(n), best].astype(np.float64), 0, 1)
            scores.append(np.round(np.where(known, score, 0), 6))
        return langs, *(np.concatenate(x) if x else np.zeros(0) for x in (scores, sizes))


def identify(docs: DataFrame, guesser: Guesser, id_col: str = "doc_id", text_col: str = "text",
             carry: list[Column] | None = None) -> DataFrame:
    """(doc_id, carried columns, lang_pred, score): the nearest prototype of every whole text and its cosine.

    A null text, or one without a letter, gets ``und`` and 0, and so does every text when nothing was learned.
    """
    source = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"), *(carry or []))
    kept = source.columns[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    shared = docs.sparkSession.sparkContext.broadcast(guesser)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.guess(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*kept, "lang_pred", "score"])

    return source.mapInArrow(add, schema + ", lang_pred string, score double")


def recognised(docs: DataFrame, guesser: Guesser, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that have letters and are like a language learned.

    A cosine under ``least`` rejects texts of ``ENOUGH_NGRAMS`` or more: that of a shorter text can be small by chance.
    When nothing was learned, all texts with letters stay.
    """
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(guesser)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, scores, sizes = shared.value.measured(batch.column(at).to_pylist())
            unlike = (scores < least) & (sizes >= ENOUGH_NGRAMS) & bool(shared.value.names)
            yield batch.filter(pa.array((sizes > 0) & ~unlike, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id", remainder: int = 0) -> Column:
    """Documents whose crc32 of the id's text leaves ``remainder`` modulo 5 are not learned from; a null id counts as ''."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(5)) == remainder


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from documents not held out that have a language, for all rows.

    Null languages and texts teach nothing, texts without letters neither; an empty language is one like any other;
    repeated rows teach twice; other columns are not read; an empty
    table gives no rows.
    """
    return identify(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col,
                    [held_out(id_col).alias("held_out")])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Guesser:
    labelled = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    return Guesser(*prototypes(labelled.select(F.col(text_col).cast("string").alias("text"),
                                               F.col(lang_col).cast("string").alias("lang"))))
