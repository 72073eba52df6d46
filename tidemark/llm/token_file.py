"""Token ids on file: ranks by frequency in byte-aligned variable-length coding with control bytes apart.

Ids are replaced by their rank in the corpus, so frequent ids take one byte. A document's ranks become two byte
strings: control bytes, each with the lengths (1 to 4 bytes) of four ranks in two bits each, and data bytes, the
ranks in little-endian order without leading zero bytes. Both are decoded with numpy through a table of the 256
control bytes. A folder holds ``ids`` (Parquet, one file per range of document ids, ascending inside and from file to
file) and ``ranks`` (rank and id).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.encoding import encoded, id_type
from tidemark.llm.vocabulary import tokenizer
from tidemark.sources.store import settle

IDS_PER_FILE = 16_000_000
BATCH_IDS = 1 << 20         # coded or decoded at once, about; a longer document alone

#: For each control byte, which of the four bytes of each of its four ranks are stored.
STORED = np.array([[[b <= (c >> 2 * i & 3) for b in range(4)] for i in range(4)] for c in range(256)], dtype=bool)


def encode_all(ranks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, their bounds, data bytes, their bounds) of runs of unsigned 32-bit ranks, one run per document."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    first = np.concatenate([[0], np.cumsum(sizes)])
    quads = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    place = np.arange(len(ranks)) + np.repeat(4 * quads[:-1] - first[:-1], sizes)
    padded = np.zeros(4 * quads[-1], dtype=np.uint8)
    padded[place] = codes
    padded = padded.reshape(-1, 4)
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    stored = STORED[control].reshape(-1, 4)[place]
    ends = np.concatenate([[0], np.cumsum(codes.astype(np.int64) + 1)])
    return control, quads, ranks.view(np.uint8).reshape(-1, 4)[stored], ends[first]


def decode_all(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranks back, as unsigned 32-bit, of the documents' control and data bytes one after the other."""
    quads = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    first = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(first[-1]) + np.repeat(4 * quads[:-1] - first[:-1], sizes)
    stored = STORED[control].reshape(-1, 4)[place]
    out = np.zeros((first[-1], 4), dtype=np.uint8)
    out[stored] = data
    return out.reshape(-1).view("<u4")


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of one document's ranks."""
    control, _, data, _ = encode_all(ranks, np.array([len(ranks)]))
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    return decode_all(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([n]))


def _flat(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, one after the other."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def _runs(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``BATCH_IDS`` ids, counted by a column."""
    upto = np.concatenate([[0], np.cumsum(batch.column(column).to_numpy())])
    row = 0
    while row < batch.num_rows:
        to = max(row + 1, int(np.searchsorted(upto, upto[row] + BATCH_IDS, side="right")) - 1)
        yield batch.slice(row, to - row)
        row = to


def token_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, ids): the ids of every whole text, little-endian in as many bits as the vocabulary needs."""
    def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, bounds in encoded(batch.column(1), path):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), _binary(ids.view(np.uint8), bounds * ids.itemsize)],
                    ["doc_id", "n", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode_texts, "doc_id long, n long, ids binary")


def id_counts(ids: DataFrame, path: str) -> DataFrame:
    """(id, n): occurrences in the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, totals = id_type(path), np.zeros(tokenizer(path).get_vocab_size(), dtype=np.int64)
        for batch in batches:
            found = np.bincount(_flat(batch.column(0)).view(kind))
            if len(found) > len(totals):
                totals = np.pad(totals, (0, len(found) - len(totals)))
            totals[:len(found)] += found
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Tokenise every whole text, append ``end_id`` to each document, and write the folder.

    ``id_col`` holds integers. Null or empty text is the end id alone; null ids come first; rows of equal ids all
    stay, next to each other, and may lie in several files; other columns are not read; an empty table writes a folder
    without documents. The ids are written down once, counted, ranked, and sorted into files by ranges of document ids.
    """
    spark = docs.sparkSession
    ids = settle(token_ids(docs, tokenizer_path, id_col, text_col), "token-ids")
    counted = {r.id: r.n for r in id_counts(ids, tokenizer_path).collect()}         # one row per id of the vocabulary
    total, rows = sum(counted.values()), ids.count()
    counted[end_id] = counted.get(end_id, 0) + rows
    order = sorted(counted, key=lambda i: (-counted[i], i))
    spark.createDataFrame(list(enumerate(order)), "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(order) + 1, dtype="<u4")
    rank_of[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank_of)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, kind = 0, id_type(tokenizer_path)
        for batch in batches:
            for run in _runs(batch, "n"):
                sizes = run.column("n").to_numpy() + 1
                ends = np.cumsum(sizes)
                ranks = np.empty(ends[-1], dtype="<u4")
                ranks[ends - 1] = shared.value[end_id]
                own = np.ones(len(ranks), dtype=bool)
                own[ends - 1] = False
                ranks[own] = shared.value[_flat(run.column("ids")).view(kind)]
                control, quads, data, bounds = encode_all(ranks, sizes)
                yield pa.RecordBatch.from_arrays(
                    [run.column("part"), run.column("doc_id"), pa.array(sizes), _binary(control, quads), _binary(data, bounds),
                     pa.array(before + ends - sizes)], ["part", "doc_id", "n_tokens", "control", "data", "first"])
                before += int(ends[-1])

    files = max(1, -(-total // IDS_PER_FILE))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("n"), F.xxhash64("ids")]
    (ids.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
     .select(F.spark_partition_id().alias("part"), "doc_id", "n", "ids")
     .mapInArrow(pack, "part int, doc_id long, n_tokens long, control binary, data binary, first long")
     .write.option("compression", "zstd").parquet(f"{folder}/ids"))


def read_documents(spark: SparkSession, folder: str, digest: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """(doc_id, start, n_tokens, value): every stored document with ``digest`` of its decoded ids.

    ``start`` counts the ids of all documents before it; ``kind`` is the digest's Spark type.
    """
    ranks = spark.read.parquet(f"{folder}/ranks").collect()             # one row per id of the vocabulary
    id_of = np.zeros(len(ranks) + 1, dtype="<u4")
    id_of[[r.rank for r in ranks]] = [r.id for r in ranks]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in _runs(batch, "n_tokens"):
                sizes = run.column("n_tokens").to_numpy()
                ids = id_of[decode_all(_flat(run.column("control")), _flat(run.column("data")), sizes)]
                ends = np.cumsum(sizes).tolist()
                values = [digest(ids[lo:hi]) for lo, hi in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*(run.column(i) for i in range(4)), pa.array(values, value_type)],
                                                 ["part", "doc_id", "first", "n_tokens", "value"])

    stored = spark.read.parquet(f"{folder}/ids")
    value_type = to_arrow_type(kind)
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)      # one row per file
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    decoded = stored.select("part", "doc_id", "first", "n_tokens", "control", "data").mapInArrow(
        unpack, f"part int, doc_id long, first long, n_tokens long, value {kind}")
    return decoded.join(F.broadcast(parts), F.col("part") == F.col("p")).select(      # one row per file
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "value")


def to_arrow_type(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}[kind]


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def stored_digests(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, **columns: str) -> DataFrame:
    """Write the folder, read it back, and return (doc_id, start, n_tokens, ids_crc32) of what was read."""
    write_ids(docs, tokenizer_path, folder, end_id, **columns)
    return read_documents(docs.sparkSession, folder, crc_of, "long").withColumnRenamed("value", "ids_crc32")
