"""Language-model scores under a hierarchical Pitman-Yor model of words, trained and applied over whole tables.

Tokens are the lower-cased words of a text and one end. Every run of two words before a token is a restaurant of its own,
whose parent is the one word before, whose parent is the root; a text starts after ``START``. In a sweep every word of a
restaurant is a Gibbs step of its own: its customers are taken out, with their tables out of the restaurant's total, and
seated anew given the tables of the other words and the word's probability in the parent (see ``seating.draw``). Both are
those of the sweep before, so all words of a level are seated side by side, levels from the leaves to the root.

Occurrences are shuffled once, to blocks by the word before, as packed arrays (``packed.py``): a block holds its
restaurants of one and of two words whole (``restaurants.py``). The words of the root are divided into parts. A sweep is one
pass over the blocks and one over the parts, which send each other only small numbers: tables of the block's words one way,
customers and tables at the root the other, both in the order of the block's words. Blocks and parts are bucketed tables, so
passes join them with what was sent without shuffling them. The number of blocks follows the tokens, and the occurrences
after a word that would fill a quarter of a block are divided into pieces.

The ``FREQUENT_WORDS`` most frequent words are broadcast and travel as numbers, others as a hash for each task and block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import restaurants
from tidemark.llm.language_id import held_out
from tidemark.llm.packed import give_back, pack, unpack
from tidemark.llm.restaurants import Given
from tidemark.llm.seating import look_up
from tidemark.llm.tokens import blocks, mix
from tidemark.llm.vocabulary import frequent
from tidemark.session import checkpoint_dir
from tidemark.sources.store import settle

FREQUENT_WORDS = 32_768
MOST_PAIRS = 3 << 20            # occurrences of word and context that a task holds before it sends them on
BLOCK_TOKENS = 1 << 21          # occurrences in a block, about
TEXTS = 12                      # scores are summed for 2^TEXTS rows at a time
SWEEPS, BURN_IN = 3, 1
FLUSH_TOKENS = 1 << 21
START, END = np.uint64(0), np.uint64(0x9D2C5680A7F1E3B5)
_BLOCK, _PIECE = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_SENT = "array<struct<to: int, blob: binary>>"


def batch_tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token, whether it opens a text, text) of blocks of texts: words with an end after each text."""
    for lo, _, words in blocks(column):
        counts = np.diff(words.first)
        total, number = len(words.hashes) + len(counts), np.arange(len(counts))
        is_word, opens = np.ones(total, dtype=bool), np.zeros(total, dtype=bool)
        is_word[words.first[1:] + number] = False
        opens[words.first[:-1] + number] = True
        token = np.empty(total, dtype=np.uint64)
        token[is_word], token[~is_word] = words.hashes, END
        yield token, opens, np.repeat(number, counts + 1) + lo


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted values, and how often each is there."""
    opens = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[opens], np.diff(np.append(opens, len(values)))


def count_words(source: DataFrame) -> DataFrame:
    """(word, freq, trained): occurrences of each distinct token, and those in texts that are learned from."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            token = np.concatenate([x for x, _ in held]) if held else np.zeros(0, np.int64)
            learn = np.concatenate([x for _, x in held]) if held else np.zeros(0, bool)
            word, freq = runs(np.sort(token))
            some, often = runs(np.sort(token[learn]))
            trained = np.zeros(len(word), np.int64)
            trained[np.searchsorted(word, some)] = often
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (word, freq, trained)],
                                              ["word", "f", "t"])

        for batch in batches:
            learn = ~batch.column(1).to_numpy(zero_copy_only=False)
            for token, _, text in batch_tokens(batch.column(0)):
                held.append((token.view(np.int64), learn[text]))
                waiting += len(token)
                if waiting > FLUSH_TOKENS:
                    yield flush()
                    waiting = 0
        yield flush()

    counted = source.select("text", "held_out").mapInArrow(count, "word long, f long, t long")
    return counted.groupBy("word").agg(F.sum("f").alias("freq"), F.sum("t").alias("trained"))


class Numbers:
    """Numbers of words: the start, then the frequent words, the same in all tasks, then a task's other words; and the blocks.

    Blocks below ``number`` are those of whole words before, then come the pieces of the ``heavy`` ones, then their units.
    """

    def __init__(self, words: np.ndarray, number: int, heavy: dict[int, int] | None = None) -> None:
        """``words``: hashes of the frequent words, most frequent first; ``heavy``: numbers of pieces by hash."""
        found = sorted((heavy or {}).items())
        self.number, self.heavy = number, np.array([h for h, _ in found], np.uint64)
        self.pieces = np.array([n for _, n in found], np.int64)
        self.begins = number + np.concatenate([[0], np.cumsum(self.pieces)]).astype(np.int64)
        self.blocks = int(self.begins[-1])
        self.shared = np.concatenate([[START], words[words != START]]).astype(np.uint64)
        bits = max(1, (16 * len(self.shared)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.zeros(1 << bits, np.int32)
        self.slots[self.shared >> self.shift] = np.arange(len(self.shared))
        clash = np.flatnonzero(self.slots[self.shared >> self.shift] != np.arange(len(self.shared)))
        self.clash = clash[np.argsort(self.shared[clash])]          # those whose slot another one has

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, those of other words -1; hashes of the other words, one for each -1)."""
        ids = self.slots[hashes >> self.shift]
        other = np.flatnonzero(self.shared[ids] != hashes)
        place, found = look_up(self.shared[self.clash], hashes[other])
        ids[other] = np.where(found, self.clash[place], -1) if len(self.clash) else -1
        return ids, hashes[other[~found]]

    def numbered(self, ids: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Fills in the numbers of the other words; returns their distinct hashes."""
        rare, number = np.unique(others, return_inverse=True)
        ids[ids < 0] = len(self.shared) + number
        return rare

    def unit(self, block: int) -> int | None:
        """The unit of a block that is a piece."""
        return self.blocks + int(np.searchsorted(self.begins, block, side="right")) - 1 if block >= self.number else None

    def sent(self, word: np.ndarray, one: np.ndarray, before: np.ndarray, n: np.ndarray, text: np.ndarray, rows: np.ndarray,
             rare: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(block, blob): occurrences by the block of the word before; ``rows`` of the texts ascend."""
        hashes, shared = np.concatenate([self.shared, rare]), len(self.shared)
        of_word = (mix(hashes ^ _BLOCK) % np.uint64(self.number)).astype(np.uint16 if self.blocks <= 1 << 16 else np.int32)
        block = of_word[one]
        place, heavy = look_up(self.heavy, hashes)
        some = np.flatnonzero(heavy[one])
        if len(some):
            which = place[one[some]]
            block[some] = self.begins[which] + (mix(hashes[before[some]] ^ _PIECE) % self.pieces[which].astype(np.uint64)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        counts = np.bincount(block, minlength=self.blocks)
        ends = np.cumsum(counts)
        for at in np.flatnonzero(counts).tolist():
            own = order[ends[at] - counts[at]:ends[at]]
            ids = [x[own] for x in (word, one, before)]
            used = np.zeros(len(hashes), dtype=bool)
            for x in ids:
                used[x] = True
            used[:shared] = True
            new = np.cumsum(used, dtype=np.int32) - 1
            row = rows[text[own]]
            others = rare[used[shared:]]        # in order, so their differences take fewer bytes
            blob = pack(np.diff(others, prepend=others[:1] * 0), *(new[x] for x in ids), n[own], np.diff(row, prepend=row[0]), row[:1])
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([blob], pa.binary())], ["block", "blob"])


def gathered(source: DataFrame, numbers) -> DataFrame:
    """(block, blob): all occurrences of a word after a context, with their rows and whether they are learned from."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Numbers = numbers.value
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, opens, others, learn, rows = (np.concatenate(x) for x in zip(*held))
            held.clear()
            rare = known.numbered(ids, others)

            def shifted(x: np.ndarray) -> np.ndarray:
                out = np.zeros(len(x), dtype=np.int32)
                out[1:], out[opens] = x[:-1], 0
                return out

            one, text = shifted(ids), np.cumsum(opens, dtype=np.int32) - 1
            return known.sent(ids, one, shifted(one), learn[text], text, rows, rare)

        for batch in batches:
            learn, rows = ~batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            for token, opens, text in batch_tokens(batch.column(0)):
                ids, others = known.of(token)
                held.append((ids, opens, others, learn[text[0]:text[-1] + 1], rows[text[0]:text[-1] + 1]))
                waiting += len(token)
                if waiting > MOST_PAIRS:
                    yield from flush()
                    give_back()
                    waiting = 0
        if held:
            yield from flush()
        give_back()

    return source.select("text", "held_out", "row").mapInArrow(emit, "block int, blob binary")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is written here as soon as it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settled(rows: DataFrame, name: str) -> DataFrame:
    with shuffles_dropped(rows.sparkSession):
        return settle(rows, name)


def bucketed(rows: DataFrame, key: str, number: int, name: str) -> DataFrame:
    """Write a table in ``number`` buckets of its key, so that joins by the key don't shuffle it, and go on from the files."""
    spark, name = rows.sparkSession, f"{name}_{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        rows.write.bucketBy(number, key).option("path", f"{checkpoint_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def each(rows: DataFrame, work: Callable[..., tuple], schema: str) -> DataFrame:
    """``work`` on the values of each row, its results in the order of ``schema`` or a batch of rows."""
    names = [x.split()[0] for x in schema.replace(_SENT, "sent_type").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                done = work(*(x[i].as_buffer() if pa.types.is_binary(x.type) else x[i].as_py() for x in batch.columns))
                if isinstance(done, pa.RecordBatch):
                    yield done
                else:
                    yield pa.RecordBatch.from_arrays([_column(n, v) for n, v in zip(names, done)], names)
                del done
                give_back()

    return rows.mapInArrow(run, schema)


_SENT_TYPE = pa.list_(pa.struct([("to", pa.int32()), ("blob", pa.binary())]))


def _column(name: str, value) -> pa.Array:
    if name in ("sent", "units"):
        return pa.array([[{"to": to, "blob": blob} for to, blob in value]], _SENT_TYPE)
    return pa.array([value], pa.binary() if isinstance(value, bytes) else pa.int32() if name in ("block", "part") else pa.int64())


def mail(rows: DataFrame, key: str, to: str, kind: int = 0, sent: str = "sent") -> DataFrame:
    """(to, kind, source, blob): what rows sent to others, source being their own key."""
    return rows.select(F.col(key).alias("source"), F.explode(sent).alias("x")).select(
        F.col("x.to").alias(to), F.lit(kind).alias("kind"), "source", F.col("x.blob").alias("blob"))


def own(rows: DataFrame, key: str, kind: int = 0) -> DataFrame:
    """The same columns with the rows' own tables, as from source -1."""
    return rows.select(key, F.lit(kind).alias("kind"), F.lit(-1).alias("source"), F.col("state").alias("blob"))


def joined(table: DataFrame, key: str, columns: list[str], *given: DataFrame) -> DataFrame:
    """``table`` with all that was given to each of its rows, in the order of kind and source."""
    rows = reduce(DataFrame.unionByName, given)
    rows = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("kind", "source", "blob"))).alias("given"))
    return table.select(key, *columns).join(rows.hint("merge"), key).select(key, *columns, "given")


def opened(given: list[dict]) -> dict[int, tuple[list[np.ndarray] | None, list[np.ndarray]]]:
    """By kind: the row's own tables, if any, and the arrays of all sources, one after the other."""
    out = {}
    for kind in sorted({x["kind"] for x in given}):
        state = [unpack(x["blob"]) for x in given if x["kind"] == kind and x["source"] < 0]
        sent = [unpack(x["blob"]) for x in given if x["kind"] == kind and x["source"] >= 0]
        out[kind] = (state[0] if state else None, [np.concatenate(x) for x in zip(*sent)])
    return out


def lists(sent: list[dict]) -> list[tuple[int, bytes]]:
    return [(x["to"], x["blob"]) for x in sent]


def discount_of(one: int, two: int) -> float:
    """The discount estimated from the numbers of groups of one and of two customers."""
    return float(np.clip(one / (one + 2 * two), 0.05, 0.95)) if one + two else 0.5


def modelled(occurrences: DataFrame, numbers, learned: int, distinct: int, sweeps: int, burn_in: int, named: bool,
             finish: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """``finish`` (rows, their other arrays, probability, frequencies of the block's words) of each block.

    ``occurrences``: (block, blob) by ``numbers``, a broadcast ``Numbers``; ``learned`` and ``distinct``: tokens learned and
    distinct ones. The probability of a row is averaged over the seatings after the first ``burn_in`` sweeps.
    """
    number, units, unit_state = numbers.value.number, None, None

    def build(table: pa.Table) -> pa.Table:
        block, known = table.column("block")[0].as_py(), numbers.value
        done = restaurants.built([x.as_buffer() for x in table.column("blob")], known.shared, number, named, known.unit(block))
        give_back()
        return pa.table({n: _column(n, v) for n, v in zip(("block", "kept", "sweep", "sent", "units", "one", "two"), (block, *done))})

    held = bucketed(occurrences.repartition(numbers.value.blocks, "block").groupBy("block").applyInArrow(
        build, f"block int, kept binary, sweep binary, sent {_SENT}, units {_SENT}, one long, two long"),
        "block", numbers.value.blocks, "lm_blocks")
    counted = held.agg(F.sum("one").alias("one"), F.sum("two").alias("two")).first()
    first_d2 = discount_of(counted.one or 0, counted.two or 0)

    def sources(table: pa.Table) -> list[tuple[int, bytes]]:
        table = table.sort_by("source")
        return list(zip(table.column("source").to_pylist(), table.column("blob").to_pylist()))

    def unite(table: pa.Table) -> pa.Table:
        done = restaurants.united(sources(table), number)
        return pa.table({n: _column(n, v) for n, v in zip(("block", "words", "sent"), (table.column("block")[0].as_py(), *done))})

    def begin(table: pa.Table) -> pa.Table:
        done = restaurants.rooted(sources(table))
        return pa.table({n: _column(n, v) for n, v in zip(("part", "words", "sent"), (table.column("part")[0].as_py(), *done))})

    asked = mail(held, "block", "part")
    if len(numbers.value.heavy):
        units = bucketed(mail(held, "block", "block", sent="units").groupBy("block").applyInArrow(
            unite, f"block int, words binary, sent {_SENT}"), "block", number, "lm_units")
        asked = asked.unionByName(mail(units, "block", "part"))
    parts = bucketed(asked.groupBy("part").applyInArrow(begin, f"part int, words binary, sent {_SENT}"), "part", number, "lm_parts")
    first = mail(parts, "part", "block")
    given, state, at_root, root_state, kept = Given((0.5, 0.5, 0.5), 0, distinct, learned, distinct), None, first, None, []
    seated = f"block int, state binary, sent {_SENT}, units {_SENT}, one long, two long"
    for k in range(sweeps):
        def sweep(block, rows, sent, got, given=given, k=k):
            got, unit = opened(got), numbers.value.unit(block)
            if unit is None:
                return block, *restaurants.swept(rows, lists(sent), *got[0], given, k)
            return block, *restaurants.swept_piece(rows, lists(sent), *got[0], got[1][1] if 1 in got else None, unit, given, k)

        def unite_sweep(block, words, sent, got, given=given, k=k):
            got = opened(got)
            return block, *restaurants.swept_unit(words, lists(sent), *got[0], got[1][1], given, k)

        def root(part, words, got, given=given, k=k):
            return part, *restaurants.seated_at_root(words, *opened(got)[0], given, k)

        had = [own(x, "block") if x is not None else None for x in (state, unit_state)]
        state = settled(each(joined(held, "block", ["sweep", "sent"], at_root, *([had[0]] if had[0] is not None else []), *(
            [mail(unit_state, "block", "block", 1, "units")] if unit_state is not None else [])), sweep, seated), "lm-state")
        sent = mail(state, "block", "part")
        if units is not None:
            unit_state = settled(each(joined(
                units, "block", ["words", "sent"], at_root, mail(state, "block", "block", 1, "units"),
                *([had[1]] if had[1] is not None else [])), unite_sweep, seated), "lm-unit-state")
            sent = sent.unionByName(mail(unit_state, "block", "part"))
        root_state = settled(each(joined(parts, "part", ["words"], sent, *([own(root_state, "part")] if root_state is not None else [])),
                                  root, f"part int, state binary, sent {_SENT}, one long, two long, c long, k long"), "lm-root")
        at_root = mail(root_state, "part", "block")
        mids, top = (x.agg(*(F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in x.columns if y in ("one", "two", "c", "k"))).first()
                     for x in (state if units is None else state.unionByName(unit_state), root_state))
        given = Given((discount_of(top.one, top.two), discount_of(mids.one, mids.two), first_d2), top.c, top.k, learned, distinct)
        if k >= burn_in:
            kept.append((state, unit_state, root_state, given))

    def end(block, rows, got):
        rows, others = restaurants.rows_of(rows)
        got = opened(got)
        p = sum(restaurants.probabilities(rows, *got[2 * k], got[2 * k + 1][1] if 2 * k + 1 in got else None, x)
                for k, x in enumerate(givens, 1)) / len(givens)
        return finish(rows, others, p, got[0][1][0])

    givens, samples = [x for *_, x in kept], []
    for k, (of_blocks, of_units, of_root, _) in enumerate(kept, 1):
        samples += [own(of_blocks, "block", 2 * k), mail(of_root, "part", "block", 2 * k)]
        if of_units is not None:
            samples.append(mail(of_units, "block", "block", 2 * k + 1, "units"))
    return each(joined(held, "block", ["kept"], first, *samples), end, schema)


def sampled(leaves: DataFrame, words: DataFrame, learned: int, distinct: int, sweeps: int = SWEEPS,
            burn_in: int = BURN_IN) -> DataFrame:
    """(word, two, trained, p): the probability of each word after each context, given how often it was learned there.

    ``leaves`` has (word, one, two, n), ``words`` (word, hot, trained) with the frequent ones marked; ``learned`` and
    ``distinct`` are the sums of ``trained`` and of its signs.
    """
    spark = leaves.sparkSession
    often = words.where("hot").orderBy(F.desc("trained"), "word").select("word").toArrow()
    numbers = spark.sparkContext.broadcast(Numbers(often.column("word").to_numpy().view(np.uint64),
                                                   max(1, -(-learned // BLOCK_TOKENS))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, one, two, n = (x.to_numpy() for x in batch.columns)
            ids, others = numbers.value.of(np.concatenate([word, one, two]).view(np.uint64))
            rare = numbers.value.numbered(ids, others)
            yield from numbers.value.sent(*np.split(ids, 3), n, np.zeros(len(n), np.int32), np.zeros(1, np.int64), rare)

    def finish(rows, others, p, trained) -> pa.RecordBatch:
        word, two = others[3:]
        return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in (word, two, trained[rows.word])), pa.array(p)],
                                          ["word", "two", "trained", "p"])

    occurrences = leaves.select("word", "one", "two", "n").mapInArrow(emit, "block int, blob binary")
    return modelled(occurrences, numbers, learned, distinct, sweeps, burn_in, True, finish,
                    "word long, two long, trained long, p double")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remainder: int = 1,
                frequent_words: int = FREQUENT_WORDS, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, whole texts.

    Learned from the rows whose crc32 of the id's text does not leave ``remainder`` modulo 5. base_score adds
    log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens; score adds log10 of the predictive probability, averaged
    over the sweeps after the first ``burn_in``. Null and empty texts are one end; a null id counts as the empty string; rows with
    equal ids or texts are scored each by itself; with nothing to learn from, every token has the base probability 1;
    other columns are not read; an empty table gives no rows. ``docs`` must give the same rows in the same order each
    time it is read, as files do.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         held_out(id_col, remainder).alias("held_out"), F.monotonically_increasing_id().alias("row"))
    words = settled(count_words(source), "lm-counts")
    size = words.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.coalesce(F.sum("freq"), F.lit(0)).alias("all"),
                     F.coalesce(F.sum(F.signum("trained")), F.lit(0)).cast("long").alias("v")).first()
    learned, distinct = size.n, size.v
    # a text has one end, so what follows its start is as often there; at most four words for each block
    often = words.where(F.col("freq") > max(1, BLOCK_TOKENS // 4)).collect()
    heavy = {int(START if w == END else w): -(-f // max(1, BLOCK_TOKENS // 2))
             for w, f in ((np.int64(x.word).view(np.uint64), x.freq) for x in often)}
    number = max(1, -(-(size.all - sum(x.freq for x in often)) // BLOCK_TOKENS))
    often = frequent(words, frequent_words).select("word", "freq").toArrow().sort_by([("freq", "descending"), ("word", "ascending")])
    numbers = spark.sparkContext.broadcast(Numbers(often.column("word").to_numpy().view(np.uint64),      # at most frequent_words
                                                   number, heavy))

    def finish(rows, others, p, trained) -> pa.RecordBatch:
        count, texts, text = others[:3]
        base = np.log10((trained + 0.5) / (learned + 0.5 * (distinct + 1)))
        by_text = [np.bincount(text, np.repeat(x, count), len(texts))
                   for x in (np.ones(len(p)), np.sign(trained)[rows.word], base[rows.word], np.log10(p))]
        near = texts >> TEXTS
        first = np.flatnonzero(np.diff(near, prepend=-1))
        blobs = [pack(*(x[lo:end].astype(np.int64) for x in (texts, *by_text[:2])), *(x[lo:end].view(np.uint64) for x in by_text[2:]))
                 for lo, end in zip(first, [*first[1:], len(near)])]
        return pa.RecordBatch.from_arrays([pa.array(near[first]), pa.array(blobs, pa.binary())], ["texts", "blob"])

    def add(table: pa.Table) -> pa.Table:
        sent = [unpack(x.as_buffer()) for x in table.column("blob")]
        row, n, known, base, score = (np.concatenate([x[i] for x in sent]) for i in range(5))
        row, text = np.unique(row, return_inverse=True)
        sums = [np.bincount(text, x, len(row)) for x in (n, known, *(x.astype(np.uint64).view(float) for x in (base, score)))]
        return pa.table({"row": row.astype(np.int64), "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64),
                         "base": sums[2], "score": sums[3]})

    by_block = modelled(gathered(source, numbers), numbers, learned, distinct, sweeps, burn_in, False, finish, "texts long, blob binary")
    by_text = by_block.groupBy("texts").applyInArrow(add, "row long, n_tokens long, n_known long, base double, score double")
    both = source.select("row", "doc_id", "held_out").unionByName(by_text, allowMissingColumns=True).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"))
    return both.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(learned).cast("long").alias("train_tokens"),
                       F.round("base", 8).alias("base_score"), F.round("score", 8).alias("score"))


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, n_tokens, base_perplexity, perplexity): 10 to the mean negative score of a token, over all rows.

    ``scored`` is what ``score_texts`` returns; held-out and learned texts are told apart. An empty table gives no rows.
    """
    tokens = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(
        tokens.alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("base_score") / tokens).alias("base_perplexity"),
        F.pow(F.lit(10.0), -F.sum("score") / tokens).alias("perplexity"))
