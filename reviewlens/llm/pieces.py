"""SentencePiece encoding and decoding, through a table of distinct chunks between white-space marks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.chunks import decode_pieces, piece_table
from reviewlens.llm.common import slices


def _lists(batch: pa.RecordBatch, values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `ids array<int>` of each row: exactly the library's ids of the whole text, without begin or end.

    A null text is empty and has no ids. Repeated rows stay repeated, other columns are dropped, and an empty table
    gives an empty one. Texts of any length are encoded whole.
    """

    def run(batches):
        table, cut = piece_table(model)
        for batch in slices(batches):
            joined = table.join([cut(t or "") for t in batch.column(1).to_pylist()])
            bounds = np.cumsum([0, *(len(j) // 4 for j in joined)])
            values = np.frombuffer(b"".join(joined), dtype="<i4")
            yield pa.record_batch([batch.column(0), _lists(batch, values, bounds)], names=["key", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`key`, `ids` and the decoded text of each row; null ids are none, and no ids give an empty text."""

    def run(batches):
        for batch in slices(batches):
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            sizes = np.asarray(lists.value_lengths())
            values = np.asarray(lists.flatten(), dtype=np.int64)
            texts = decode_pieces(model, values, np.cumsum([0, *sizes]))
            yield pa.record_batch([batch.column(0), lists, pa.array(texts, pa.string())], names=["key", "ids", "text"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    decoded = rows.mapInArrow(run, f"key {kind}, ids array<int>, text string")
    return decoded.toDF(key, ids, out)
