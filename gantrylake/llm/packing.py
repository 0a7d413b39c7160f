"""Concatenate and cut: all documents' tokens as one stream, cut into windows of fixed length.

Pass one tokenizes each partition, keeps running totals inside it and writes the ids to the shared
folder. The partition totals (one row per partition) are summed to give each partition its place in the
stream. Pass two reads the ids again and cuts every document at the window boundaries its place tells;
nothing is shuffled, and a lost task only reads its rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantrylake.llm.arrays import blocks
from gantrylake.llm.bpe import encoder
from gantrylake.session import fresh_path

ENCODED = "part int, place long, doc_id {id}, doc_tokens long, ids binary"
PIECES = "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Token ids that a returned batch holds at most, unless one document has more.
BATCH_IDS = 1 << 20


def encode_documents(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of (partition, tokens before the document in it, document, its ids as 32-bit integers)."""
    selected = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4")
        for batch in batches:
            for rows, _, _ in blocks(batch):
                texts = [text or "" for text in rows.column("text").to_pylist()]
                ids = [np.concatenate([own, end]).astype("<u4") for own in encoder(path).encode(texts)]
                lengths = np.array([len(own) for own in ids], np.int64)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(place + np.cumsum(lengths) - lengths),
                        rows.column("doc_id"),
                        pa.array(lengths),
                        pa.array([own.tobytes() for own in ids], pa.binary()),
                    ],
                    ["part", "place", "doc_id", "doc_tokens", "ids"],
                )
                place += int(lengths.sum())

    return selected.mapInArrow(encoded, ENCODED.format(id=kind))


def pack_documents(
    docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: the part of one document that lies in one window.

    Columns: ``doc_id``, ``start`` (the document's ids before the piece), ``length``, ``doc_tokens`` (with the
    end id), ``sequence_id``, ``offset`` in the window, ``ids`` (little-endian 32-bit). All windows but the
    last are full. A NULL or empty text is its end id alone; repeated rows are packed each; a document
    longer than a window spans several; an empty table gives no rows. Other columns of ``docs`` are not
    read. The order of documents is that of the partitions and their rows.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "packing")
    encode_documents(docs, path, end_id, id_col, text_col).write.option("compression", "zstd").parquet(folder)
    stored = spark.read.parquet(folder)
    totals = stored.groupBy("part").agg(F.sum("doc_tokens").alias("tokens")).collect()  # a row per partition
    sizes = dict(sorted((row["part"], row["tokens"]) for row in totals))
    ends = np.cumsum(list(sizes.values()), dtype=np.int64).tolist()
    bases = spark.sparkContext.broadcast({part: end - size for (part, size), end in zip(sizes.items(), ends, strict=True)})
    kind = stored.schema["doc_id"].dataType
    arrow_id = _arrow_type(kind)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.record_batch(
            [pa.array(columns[0], arrow_id), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            columns = [batch.column(name) for name in ("part", "place", "doc_id", "doc_tokens", "ids")]
            for n in range(batch.num_rows):
                part, place, doc, total, ids = (column[n].as_py() for column in columns)
                at, start = bases.value[part] + place, 0
                while start < total:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, total - start)
                    rows.append((doc, start, length, total, sequence, offset, ids[4 * start : 4 * (start + length)]))
                    start += length
                    held += length
                    if held >= BATCH_IDS:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return stored.mapInArrow(cut, PIECES.format(id=kind.simpleString()))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
