"""Concatenate and cut: documents laid end to end and cut into sequences of a fixed number of tokens.

Two passes. The first writes each document's ids with its offset within its partition, and the partition's total. A
prefix sum over those totals (one number for each partition) places every partition in the whole; the second pass cuts
each document at the window borders it crosses. No row moves between partitions, and no document order is imposed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.llm.bpe import encoded_slices
from inciscope.llm.common import SLICE_ROWS, keyed_text, slices
from inciscope.session import scratch_path

SEQUENCE_TOKENS = 4096
END_ID = 2


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(part, local_start, doc_id, ids): ids of each document with the end id, placed within its partition."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for keys, ids, ends in encoded_slices(batches, path):
            ids, begins = ids.astype("<u4"), np.concatenate([[0], ends[:-1]])
            lengths = ends - begins + 1
            starts = at + np.cumsum(lengths) - lengths
            at += int(lengths.sum())
            parts = pa.array(np.full(len(keys), part, dtype=np.int32))
            rows = [ids[b:e].tobytes() + end for b, e in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [parts, pa.array(starts), keys, pa.array(rows, pa.binary())],
                ["part", "local_start", "doc_id", "ids"],
            )

    return docs.mapInArrow(run, "part int, local_start long, doc_id long, ids binary")


PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, ids_crc32 long"
)


def pack(
    docs: DataFrame, path: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of a document in a sequence, with the ids themselves as little-endian 32-bit numbers.

    Every sequence but the last is full. A null or empty text is its end id alone; an empty table has no rows; rows
    with the same or no doc_id are packed one by one. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    stored = scratch_path(spark, "packing-ids")
    tokenised(keyed_text(docs, id_col, text_col), path, end_id).write.option("compression", "zstd").parquet(stored)
    encoded = spark.read.schema("part int, local_start long, doc_id long, ids binary").parquet(stored)
    # one row for each partition of the first pass
    totals = encoded.groupBy("part").agg(F.max(F.col("local_start") + F.length("ids") / 4).cast("long").alias("n")).collect()
    base, at = {}, 0
    for row in sorted(totals):
        base[row["part"]] = at
        at += row["n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_ROWS // 4):
            out = []
            for part, local, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                first, n, start = base[part] + local, len(ids) // 4, 0
                while start < n:
                    sequence, offset = divmod(first + start, sequence_tokens)
                    length = min(n - start, sequence_tokens - offset)
                    piece = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, length, n, sequence, offset, piece, zlib.crc32(piece)))
                    start += length
            names = [f.split(" ")[0] for f in PIECES.split(", ")]
            types = [pa.int64()] * 6 + [pa.binary(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, names)

    return encoded.mapInArrow(cut, PIECES)
