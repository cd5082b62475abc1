"""Order MinHash fingerprints.

Each k-mer of code points is numbered by how often it occurred before it in the text. Each of ``m`` hash functions
selects the ``l`` numbered k-mers of least hash; kept in text order, they are hashed to one number of the fingerprint.
The share of equal numbers estimates likeness under edits, moved passages included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import keyed_text, slices

K, L, M = 8, 2, 64
#: Hash values held at once.
BLOCK = 1 << 21

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _multipliers(m: int) -> np.ndarray:
    return _mix(np.arange(1, m + 1, dtype=np.uint64) * ODD) | np.uint64(1)


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """Hash of each k-mer and its number of earlier occurrences, in text order; a shorter text is one k-mer."""
    chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if not len(chars):
        return chars
    k = min(k, len(chars))
    kmers = np.zeros(len(chars) - k + 1, dtype=np.uint64)
    for i in range(k):
        kmers = kmers * ODD + chars[i : len(chars) - k + 1 + i]
    kmers = _mix(kmers)
    # occurrence numbers: equal k-mers lie together, in text order, once sorted with their place
    bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    place = np.arange(len(kmers), dtype=np.uint64)
    order = np.sort((kmers >> bits << bits) | place)
    at = (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = np.concatenate([[False], order[1:] >> bits == order[:-1] >> bits])
    if not same.any():
        return kmers
    run = np.arange(len(at))
    number = np.empty(len(at), dtype=np.uint64)
    number[at] = (run - np.maximum.accumulate(np.where(same, 0, run))).astype(np.uint64)
    return np.where(number > 0, _mix(kmers + number * ODD), kmers)


def fingerprint(text: str, k: int = K, l: int = L, m: int = M) -> np.ndarray:
    """``m`` 16-bit numbers; all zero for empty text."""
    kmers = numbered_kmers(text, k)
    out = np.zeros(m, dtype=np.uint64)
    if not len(kmers):
        return out.astype("<u2")
    multipliers, least = _multipliers(m), min(l, len(kmers))
    step = max(1, BLOCK // len(kmers))
    for lo in range(0, m, step):
        part = multipliers[lo : lo + step]
        hashes = part[:, None] * kmers[None, :]
        rows = np.arange(len(part))
        chosen = np.empty((len(part), least), dtype=np.int64)
        for i in range(least):
            chosen[:, i] = hashes.argmin(axis=1)
            hashes[rows, chosen[:, i]] = np.iinfo(np.uint64).max
        chosen.sort(axis=1)  # text order
        for i in range(least):
            out[lo : lo + step] = _mix(out[lo : lo + step] * ODD + kmers[chosen[:, i]])
    return (out >> np.uint64(48)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


FINGERPRINTS = "doc_id long, fingerprint string"
PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row, in place; a null text is empty, an empty text has the fingerprint of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t).tobytes().hex() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, FINGERPRINTS)


def with_successor(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows sorted by descending doc_id within blocks of neighbouring ids, each block ending with its successor's first.

    Columns: block, look (1 for the row lent by the next block; after the last block, by the first), doc_id, text. Rows
    without doc_id come last; rows of one doc_id are ordered by text. The block borders are quantiles of the ids, by
    default for as many blocks as there are shuffle partitions, whatever the number of rows: a block's rows are streamed.
    Texts are shuffled once, each block to a task of its own.
    """
    blocks = blocks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = []
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        found = docs.select(F.percentile_approx("doc_id", shares, 100 * blocks).alias("q")).first()["q"] or []
        borders = sorted(set(found))

    def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(borders, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0)
            value = ids.fill_null(0).to_numpy(zero_copy_only=False)
            place = len(edges) - np.searchsorted(edges, value, side="left")
            place = np.where(ids.is_null().to_numpy(zero_copy_only=False), len(edges) + 1, place)
            yield pa.RecordBatch.from_arrays([ids, pa.array(place, pa.int64())], ["doc_id", "block"])

    # the first doc_id of each block: one row a block
    firsts = docs.select("doc_id").mapInArrow(block_of, "doc_id long, block long").groupBy("block").agg(
        F.max("doc_id").alias("doc_id")
    )
    first = sorted((r["block"], r["doc_id"]) for r in firsts.collect())
    lent_to = {}
    for i, (_, doc_id) in enumerate(first):
        lent_to[doc_id] = first[i - 1][0]

    @F.pandas_udf("array<struct<block:long,look:int>>")
    def targets(ids):
        edges = np.array(borders, dtype=np.int64)
        missing = ids.isna()
        value = ids.fillna(0).astype("int64").to_numpy()
        place = len(edges) - np.searchsorted(edges, value, side="left")
        place = np.where(missing, len(edges) + 1, place)
        out = []
        for block, doc_id, absent in zip(place.tolist(), value.tolist(), missing.tolist()):
            row = [{"block": block, "look": 0}]
            lender = None if absent else doc_id
            if lender in lent_to:
                row.append({"block": lent_to[lender], "look": 1})
            out.append(row)
        import pandas as pd

        return pd.Series(out)

    dealt = docs.select(F.explode(targets("doc_id")).alias("to"), "doc_id", "text").select("to.block", "to.look", "doc_id", "text")
    return dealt.repartitionById(len(borders) + 2, F.col("block").cast("int")).sortWithinPartitions(
        "block", "look", F.col("doc_id").desc_nulls_last(), "text"
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they and the next document's are.

    The next document is the one of the next smaller doc_id; after the last comes the first. A null text is empty. Rows
    without doc_id follow the others, rows of one doc_id are ordered by text, each row is kept. A sole row is its own
    next. Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, doc_id, text, fingerprint), waiting for its next row

        def row(held, text, found):
            changed = edited(held[2], text)
            after = fingerprint(changed)
            return (
                held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), held[3].tobytes().hex(),
                after.tobytes().hex(), likeness(held[3], after), likeness(held[3], found),
            )

        for batch in slices(batches):
            out = []
            for block, look, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0] != block:
                    held = None
                if look and held is None:
                    continue  # a further row of the lent doc_id
                found = fingerprint(text)
                if held:
                    out.append(row(held, text, found))
                held = None if look else (block, doc_id, text, found)
            names = [f.strip().split(" ")[0] for f in PAIRS.split(",")]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_successor(keyed_text(docs, id_col, text_col)).mapInArrow(run, PAIRS)
