"""Token counts without token ids: ids are counted once per distinct piece and joined to piece frequencies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.vocabulary import Table, frequent, pieces_of, settled_pieces

FREQUENT_WORDS = 262_144        # most pieces whose counts are broadcast: 3 MB


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the tokenizer of the file at ``path`` counts.

    The ids of each distinct piece of the corpus are counted once. The most frequent pieces (at most
    ``frequent_words``, so the broadcast is bounded) are summed where the text is read, which also takes the hot keys
    out of the join; the others leave as (row, piece, frequency) and are joined to their counts.

    Null or empty text has 0 bytes and 0 tokens; ids may be null or repeated, each row is counted by itself; other
    columns are not read; an empty table gives no rows.
    """
    words = settled_pieces(docs, path, text_col).select("word", "key", "freq", "n_ids")
    shared = docs.sparkSession.sparkContext.broadcast(Table(frequent(words, frequent_words), with_ids=False))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            rows, doc_ids = batch.column(0).to_numpy(), batch.column(1)
            sizes = pa.compute.binary_length(batch.column(2)).fill_null(0).cast(pa.int64())
            for block in pieces_of(batch.column(2)):
                n = block.hi - block.lo
                place, found = table.find(block.distinct)
                counts = np.where(found, table.sizes[place], 0) if len(table.keys) else np.zeros(len(place), np.int64)
                total = np.concatenate([[0], np.cumsum(counts[block.which], dtype=np.int64)])
                own = rows[block.lo:block.hi]
                # white space in the key of a document's own row: no piece equals it, and such rows spread out
                yield as_batch(own, doc_ids.slice(block.lo, n), sizes.slice(block.lo, n),
                               pa.array(np.diff(total[block.words.first])),
                               pa.array([b" %d" % r for r in own.tolist()], pa.binary()), None)
                rare = np.flatnonzero(~found[block.which])
                if len(rare):
                    text = np.searchsorted(block.words.first, rare, side="right") - 1
                    pair, times = np.unique(text * len(block.distinct) + block.which[rare], return_counts=True)
                    yield as_batch(own[pair // len(block.distinct)], None, None, None,
                                   block.bytes_of(pair % len(block.distinct)), pa.array(times.astype(np.int64)))

    def as_batch(row, *columns) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        full = [pa.nulls(len(row), t) if c is None else c for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), *full],
                                          ["row", "doc_id", "n_bytes", "known", "word", "n"])

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    found = source.mapInArrow(look_up, f"row long, doc_id {kind}, n_bytes long, known long, word binary, n long")
    pieces = words.select(F.col("word").alias("w"), "n_ids")
    tokens = F.coalesce(F.col("known"), F.col("n") * F.col("n_ids"))
    summed = (found.join(pieces, F.col("word") == F.col("w"), "left")
              .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                                  F.sum(tokens).alias("n_tokens")))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
