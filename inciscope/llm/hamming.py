"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit for each element, set if it is positive. Codes are cut into segments of 16 bits, each with an
index from value to codes. A query looks up all values within radius 0 of its own segments, then 1, 2 and so on. After
radius r every code within ``segments * (r + 1) - 1`` bits has been seen, for one of its segments differs in at most r
bits; so the search ends once the k-th distance found is no larger.

Codes are dealt into blocks of bounded size; each block's index is built once and the queries are streamed past it. Every
query is first searched in one block only: no answer can be further away than the k-th found there, so the search of the
other blocks ends at that distance and they return only what is within it. Of equal codes only the k least ids can be
answers, and equal queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inciscope.session import materialise

K = 10
SEGMENT_BITS = 16
BLOCK_CODES = 32_768


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): the signs of each vector, padded to whole 64-bit words. A null vector has no row.

    A null or NaN element counts as not positive; a vector shorter than others has no positive element beyond its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for vector in batch.column(1):
                values = vector.values.to_numpy(zero_copy_only=False) if len(vector) else np.empty(0)
                with np.errstate(invalid="ignore"):
                    bits = np.packbits(np.asarray(values, dtype=np.float64) > 0, bitorder="little")
                codes.append(bits.tobytes().rstrip(b"\0"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["id", "code"])

    source = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    return source.where(F.col("v").isNotNull() & F.col("id").isNotNull()).mapInArrow(run, "id long, code binary")


@lru_cache(maxsize=32)
def masks(radius: int) -> np.ndarray:
    """Segment values with so many bits set."""
    values = np.arange(1 << SEGMENT_BITS, dtype=np.uint16)
    return values[np.bitwise_count(values) == radius].astype(np.int64)


class MultiIndex:
    def __init__(self, ids: list[int], codes: list[bytes], words: int):
        self.ids = np.array(ids, dtype=np.int64)
        self.words = as_words(codes, words)
        segments = self.words.view("<u2").reshape(len(codes), -1).T
        self.order = [np.argsort(s, kind="stable") for s in segments]
        self.start = [np.concatenate([[0], np.cumsum(np.bincount(s, minlength=1 << SEGMENT_BITS))]) for s in segments]
        self.seen = np.full(len(codes), -1)

    def search(self, number: int, query: np.ndarray, k: int, limit: int) -> list[tuple[int, int]]:
        """The (distance, id) of the k nearest within ``limit``, ties by id. ``number`` tells this search from others."""
        segments = query.view("<u2").astype(np.int64)
        found_id, found = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(SEGMENT_BITS + 1):
            for order, start, own in zip(self.order, self.start, segments):
                values = masks(radius) ^ own
                first, count = start[values], start[values + 1] - start[values]
                hit = count > 0
                first, count = first[hit], count[hit]
                if not len(count):
                    continue
                place = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                new = order[place]
                new = new[self.seen[new] != number]
                self.seen[new] = number
                distance = np.bitwise_count(self.words[new] ^ query).sum(axis=1, dtype=np.int64)
                near = distance <= limit
                found, found_id = np.concatenate([found, distance[near]]), np.concatenate([found_id, self.ids[new[near]]])
            if len(found) > k:
                best = np.lexsort((found_id, found))[:k]
                found, found_id = found[best], found_id[best]
            covered = len(segments) * (radius + 1) - 1
            if limit <= covered or (len(found) >= min(k, len(self.ids)) and found.max(initial=0) <= covered):
                break
        best = np.lexsort((found_id, found))[:k]
        return list(zip(found[best].tolist(), found_id[best].tolist()))


def as_words(codes: list[bytes], words: int) -> np.ndarray:
    return np.frombuffer(b"".join(c.ljust(8 * words, b"\0") for c in codes), dtype="<u8").reshape(len(codes), words)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of each query by Hamming distance of signs, ties by id.

    A query that is among the vectors finds itself. Rows with a null id or vector are left out; rows of one id count once
    for each different vector; fewer than k vectors give fewer rows, none give an empty result.
    """
    codes = sign_codes(vectors, id_col, vector_col).distinct()
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    codes = codes.withColumn("place", place).where(F.col("place") <= k).drop("place")
    asked = sign_codes(queries, id_col, vector_col).distinct()
    n_codes, longest = codes.agg(F.count("*"), F.max(F.length("code"))).first()
    longest_asked = asked.agg(F.max(F.length("code"))).first()[0]
    words = max(1, -(-max(longest or 0, longest_asked or 0) // 8))
    blocks = max(1, -(-n_codes // BLOCK_CODES))
    no_limit = 64 * words

    def block(*of: str) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(blocks)).cast("int")

    indexed = codes.select(block("id", "code").alias("block"), F.lit(0).alias("query"), "id", "code", F.lit(0).alias("limit"))
    queries = asked.select("code").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, own, index, number = None, [], [], None, 0
        for batch in batches:
            out = []
            for at, query, row_id, code, limit in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key:
                    key, ids, own, index = at, [], [], None
                if not query:
                    ids.append(row_id)
                    own.append(code)
                elif ids:
                    index = index or MultiIndex(ids, own, words)
                    number += 1
                    out += [(code, d, i) for d, i in index.search(number, as_words([code], words)[0], k, limit)]
            types = (pa.binary(), pa.int32(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, ["code", "distance", "id"])

    def searched(where: Column, limits: DataFrame) -> DataFrame:
        sent = limits.select(where.alias("block"), F.lit(1).alias("query"), F.lit(None).cast("long").alias("id"), "code", "limit")
        dealt = indexed.union(sent).repartition("block").sortWithinPartitions("block", "query")
        return dealt.mapInArrow(run, "code binary, distance int, id long")

    limits = queries.withColumn("limit", F.lit(no_limit))
    if blocks > 1:
        first = searched(block("code"), limits).groupBy("code").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        limit = F.when(F.col("n") >= k, F.col("kth")).otherwise(no_limit)
        found = queries.join(first, "code", "left").select("code", F.coalesce(limit, F.lit(no_limit)).cast("int").alias("limit"))
        limits = materialise(found, "hamming-limits")
    near = searched(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), limits)
    rank = F.row_number().over(Window.partitionBy("code").orderBy("distance", "id"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= k)
    named = asked.withColumnRenamed("id", "query_id").join(best, "code")
    return named.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def oracle() -> str:
    """Every query against every row."""
    return f"""
        WITH codes AS (
            SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN 1 ELSE 0 END) AS code
            FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                CAST(list_sum(list_transform(list_zip(q.code, c.code), lambda p: abs(p[1] - p[2]))) AS INTEGER) AS distance
            FROM codes q, codes c WHERE q.vec_id % 100 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {K}"""
