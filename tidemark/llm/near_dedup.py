"""Near-duplicate groups by MinHash with tensored banding, every link confirmed on the full shingle sets.

Documents of equal shingle sets form a class; all further work is on classes. A class gets two small collections of
half keys, each half key made of a few minima, and one table for every pair of a half key from the first collection
with one from the second: 12 x 12 tables of six minima from 72 minima instead of 864. Two sets of similarity s meet
in some table unless one collection misses, so the miss probability is at most 2 (1 - s^3)^12 (4e-4 at s = 0.8).

Classes that meet in a table become candidate pairs. A bucket of up to ``COMPLETE`` + 1 classes gives all its pairs.
A larger one gives each class its neighbours in the bucket's order and the bucket's leaders, its first classes, so the
number of candidates stays in proportion to the input and is found in one pass over the sorted bucket; what that may
leave unlinked is found exactly: classes of such buckets that still lie in different components meet again through their
rarest shingles, of which two sets of similarity t must share one early enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.components import components, joined_components
from tidemark.llm.tokens import blocks, distinct, mix, shingles
from tidemark.sources.store import settle

HALF_KEYS, HALF_SIZE = 12, 3
COMPLETE, CHAIN = 16, 2

_random = np.random.default_rng(1093)
_FACTORS = _random.integers(0, 2**64, 2 * HALF_KEYS * HALF_SIZE, dtype=np.uint64) | np.uint64(1)
_MASKS = _random.integers(0, 2**64, 2 * HALF_KEYS * HALF_SIZE, dtype=np.uint64)
_PLACES = _random.integers(0, 2**64, 2 * HALF_KEYS, dtype=np.uint64)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Half keys of each non-empty set: a row of 2 x HALF_KEYS integers."""
    out = np.empty((len(first) - 1, 2 * HALF_KEYS), dtype=np.uint64)
    for half in range(2 * HALF_KEYS):
        key = np.full(len(first) - 1, _PLACES[half])
        for j in range(half * HALF_SIZE, (half + 1) * HALF_SIZE):
            key = mix(key + np.minimum.reduceat((sets ^ _MASKS[j]) * _FACTORS[j], first[:-1]))
        out[:, half] = key
    return out


def _sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, words in blocks(column):
        yield lo, hi, *distinct(*shingles(words, k))


def _class_of(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each non-empty set."""
    return mix(np.add.reduceat(mix(sets), first[:-1]) + np.diff(first).astype(np.uint64))


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature); no node for documents without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets, first in _sets_of(batch.column(1), k):
                sizes = np.diff(first)
                full = np.flatnonzero(sizes)
                nodes, keys = [None] * (hi - lo), [None] * (hi - lo)
                if len(full):
                    bounds = np.append(first[:-1][full], first[-1])
                    found = zip(full.tolist(), _class_of(sets, bounds).view(np.int64).tolist(), signatures(sets, bounds))
                    for i, node, row in found:
                        nodes[i], keys[i] = node, row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                     pa.array(keys, pa.binary())], ["doc_id", "n_shingles", "node", "signature"])

    return docs.mapInArrow(sign, f"doc_id {kind}, n_shingles long, node long, signature binary")


def _table_keys(raw: list[bytes]) -> np.ndarray:
    """For each signature, the keys of all tables: every half key of one collection with every one of the other."""
    rows = np.frombuffer(b"".join(raw), dtype=np.uint64).reshape(-1, 2 * HALF_KEYS)
    return mix(rows[:, :HALF_KEYS, None] * np.uint64(3) + rows[:, None, HALF_KEYS:]).reshape(len(rows), -1)


class _Chain:
    """Pairs of neighbours in runs of equal keys, over rows that arrive in the order of their keys."""

    def __init__(self, similar: float) -> None:
        self.similar = similar
        self.keys, self.nodes, self.sizes = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.before = 0         # place in its run of the first row held
        self.leader = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)      # node and size that began that run

    def feed(self, keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray):
        """(pairs' left, pairs' right, nodes of overfull runs, place of each row in its run)."""
        held = len(self.keys)
        keys, nodes, sizes = (np.concatenate(x) for x in
                              ((self.keys, keys), (self.nodes, nodes), (self.sizes, sizes)))
        at = np.arange(len(keys))
        opens = np.ones(len(keys), dtype=bool)
        opens[1:] = keys[1:] != keys[:-1]
        begin = np.maximum.accumulate(np.where(opens, at, 0))
        place, lead, lead_size = at - begin, nodes[begin], sizes[begin]
        if held:
            same = held + int(np.argmax(np.append(keys[held:] != keys[0], True)))
            place[:same] += self.before
            if self.before:
                lead[:same], lead_size[:same] = self.leader
        left, right = [], []
        rows = np.flatnonzero(place > 0)
        rows = rows[rows >= held]
        for back in range(1, COMPLETE + 1):
            rows = rows[place[rows] >= back]
            now = rows if back <= CHAIN else rows[place[rows] <= COMPLETE]
            a, b = sizes[now - back], sizes[now]
            near = np.minimum(a, b) >= self.similar * np.maximum(a, b) - 1e-9
            left.append(nodes[now - back][near])
            right.append(nodes[now][near])
        late = held + np.flatnonzero(place[held:] > COMPLETE)
        first = late[place[late] == COMPLETE + 1]       # with it come the rows before it
        full = np.unique(np.concatenate([late, (first[:, None] - np.arange(COMPLETE + 2)).reshape(-1)]))
        near = lead_size[late] >= self.similar * sizes[late] - 1e-9         # rows come by size, the leader has the least
        left.append(lead[late][near])
        right.append(nodes[late][near])
        overfull = np.unique(nodes[full])
        if len(keys):
            tail = max(int(np.flatnonzero(opens)[-1]), len(keys) - COMPLETE - 1)
            self.keys, self.nodes, self.sizes = keys[tail:], nodes[tail:], sizes[tail:]
            self.before, self.leader = int(place[tail]), (lead[tail], lead_size[tail])
        return np.concatenate(left), np.concatenate(right), overfull, place[held:]


# Rows between the tasks: a row of a table (key, node, size); a candidate pair (any key, node, PAIR, node); a class of an
# overfull bucket (any key, node, MEMBER); a bucket known to be overfull (key, -, MARK), before its rows in order.
FIELDS = "key long, a long, size int, b long"
PAIR, MEMBER, MARK = -1, -2, -3


def _rows(key, a, size, b) -> pa.RecordBatch:
    n = len(key)
    size = np.full(n, size) if isinstance(size, int) else size
    columns = [pa.nulls(n, t) if x is None else pa.array(x, t)
               for x, t in ((key, pa.int64()), (a, pa.int64()), (size, pa.int32()), (b, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["key", "a", "size", "b"])


def _anywhere(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mix((x ^ y).view(np.uint64)).view(np.int64)


def _table_rows(classes: DataFrame, similar: float) -> DataFrame:
    """Rows of all tables. Runs that outgrow COMPLETE in a task are paired there and only their heads go on as rows."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                part = batch.slice(at, 1_024)
                keys = _table_keys(part.column(2).to_pylist()).view(np.int64)
                tables = keys.shape[1]
                nodes = np.repeat(np.array(part.column(0).to_pylist(), dtype=np.int64), tables)
                sizes = np.repeat(np.array(part.column(1).to_pylist(), dtype=np.int64), tables)
                keys = keys.reshape(-1)
                order = np.lexsort((nodes, sizes, keys))
                keys, nodes, sizes = keys[order], nodes[order], sizes[order]
                left, right, _, place = _Chain(similar).feed(keys, nodes, sizes)
                head, late = place <= COMPLETE, place > COMPLETE
                yield _rows(keys[head], nodes[head], sizes[head], None)
                if late.any():                          # pairs among the heads are found again where tables meet
                    yield _rows(_anywhere(left, right), left, PAIR, right)
                    found = np.unique(nodes[late])
                    yield _rows(mix(found.view(np.uint64)).view(np.int64), found, MEMBER, None)
                    yield _rows(np.unique(keys[late]), None, MARK, None)

    return classes.select("node", "n_shingles", "signature").mapInArrow(spread, FIELDS)


def candidates(classes: DataFrame, similar: float) -> DataFrame:
    """(a, b): candidate pairs; with null for b, the classes a of buckets that gave only neighbours and leaders."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, marked = _Chain(similar), np.zeros(0, dtype=np.int64)
        for batch in batches:
            key, a, size, b = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(4))
            row, pair, member = size >= 0, size == PAIR, size == MEMBER
            marked = np.unique(np.concatenate([marked[-1:], key[size == MARK]]))    # the last one's rows may go on
            left, right, nodes, _ = chain.feed(key[row], a[row], size[row].astype(np.int64))
            left, right = np.concatenate([left, a[pair]]), np.concatenate([right, b[pair]])
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
            nodes = np.unique(np.concatenate([nodes, a[member], a[row][np.isin(key[row], marked)]]))
            second = np.concatenate([pairs[:, 1], np.zeros(len(nodes), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs[:, 0], nodes]), pa.int64()),
                 pa.array(second, pa.int64(), mask=np.arange(len(second)) >= len(pairs))], ["a", "b"])

    rows = _table_rows(classes, similar)
    return rows.repartition("key").sortWithinPartitions("key", "size", "a").mapInArrow(meet, "a long, b long").distinct()


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles): the full set of each node, from the text of its first document."""
    wanted = classes.join(nodes, "node", "left_semi").select(F.col("first_id").alias("w_id")).distinct()
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, first in _sets_of(batch.column(1), k):
                full = np.flatnonzero(np.diff(first))
                if not len(full):
                    continue
                bounds = np.append(first[:-1][full], first[-1])
                own = [values[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(_class_of(values, bounds).view(np.int64), pa.int64()),
                                                  pa.array(own, pa.binary())], ["node", "shingles"])

    return texts.mapInArrow(sets, "node long, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, by exact counts."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(check, "a long, b long")


def _left_over(docs, classes, members, roots, k, percent) -> DataFrame:
    """Links between classes of overfull buckets that still lie in different components, found exactly.

    The classes' shingles are ordered by rarity. Two sets of similarity t share one of their first
    n - ceil(t n) + 1, so those are the keys; keys whose classes lie in one component are done. What two sets have in
    common from their first common shingle on is bounded by what follows it in either, and must still be enough.
    """
    sets = settle(_full_sets(docs, classes, members, k), "near-sets")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), node), pa.int64()), pa.array(values, pa.int64()),
                     pa.array(np.full(len(values), len(values)), pa.int64())], ["node", "shingle", "n"])

    rows = sets.mapInArrow(explode, "node long, shingle long, n long")
    spread = rows.groupBy(F.col("shingle").alias("s")).agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(W.partitionBy("node").orderBy("df", "shingle"))
    prefix = (rows.join(spread, F.col("shingle") == F.col("s")).withColumn("rank", rank)
              .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9) + 1))
    placed = settle(prefix.join(roots, "node", "left").select(
        "shingle", "node", "n", "rank", F.coalesce("root", "node").alias("root")), "near-prefixes")
    mixed = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    open_rows = placed.join(mixed.select("shingle"), "shingle", "left_semi")
    x = open_rows.select("shingle", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("r_a"),
                         (F.col("n") - F.col("rank")).alias("after_a"))
    y = open_rows.select("shingle", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("r_b"),
                         (F.col("n") - F.col("rank")).alias("after_b"))
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    enough = (1 + F.least("after_a", "after_b")) * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    pairs = x.join(y, "shingle").where((F.col("r_a") < F.col("r_b")) & near & enough).select("a", "b").distinct()
    return _confirmed(pairs, sets, percent)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``.

    Documents are linked when 100 times the common distinct k-word shingles is at least ``percent`` times all of
    theirs; words are runs without ASCII white space, A-Z lower-cased; with fewer than k words the whole sequence is
    the one shingle. component_id is the smallest id reachable over links, the document itself included; kept holds
    for that document.

    Null and empty texts and texts without words have no shingles, link with nothing and keep their own id. A null id
    never names a component unless all its ids are null (component and kept are then null). Rows with equal ids and
    texts are equal in the result. Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = settle(_signed(docs, k), "near-signed")
    classes = settle(signed.where("node is not null").groupBy("node", "n_shingles").agg(
        F.min("doc_id").alias("first_id"), F.first("signature").alias("signature")), "near-classes")
    found = settle(candidates(classes, percent / 100), "near-candidates")
    pairs = found.where("b is not null")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = settle(_full_sets(docs, classes, nodes, k), "near-sets")
    links = settle(_confirmed(pairs, sets, percent), "near-links")
    roots = settle(components(links), "near-roots")
    members = found.where("b is null").select(F.col("a").alias("node"))
    if not members.isEmpty():
        more = settle(_left_over(docs, classes, members, roots, k, percent), "near-links")
        if not more.isEmpty():
            roots = settle(joined_components(roots, more), "near-roots")
    named = classes.select("node", "first_id").join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = named.join(least, "root").select(F.col("node").alias("c_node"), "component_id")
    own = signed.drop("signature").join(placed, F.col("node") == F.col("c_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"))
