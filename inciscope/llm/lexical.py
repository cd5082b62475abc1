"""Ranked lexical search over hashed max-sketches.

The impact of a term on a document is ``(10^9 * tf) div (1000 * tf + 12 * m)``, where m grows with the document's length;
a score sums impacts times the weights of the asked terms. For one document the impact grows with tf, so a sketch of
``WIDTH`` places keeps for each place the largest tf of all terms hashed to it, which is the coordinatewise maximum of
their impacts.

A batch of queries looks its terms up in every sketch. The sums are upper bounds of the scores, since another term in the
same place can only raise them. Documents are then scored exactly in order of falling bound until the next bound is below
the k-th score found. Every partition starts at a threshold common to all: the k-th best of a few documents of high bound
scored exactly beforehand. What reaches it is ranked over all partitions.

Terms are found by hash and confirmed by their bytes, so no two terms are taken for one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from inciscope.llm.common import keyed_text, slices
from inciscope.llm.shingles import run_hashes, same_runs, text_slices
from inciscope.session import materialise

TOP = 20
WIDTH = 2048
#: A place of a sketch holds one byte; this value stands for any larger count as well.
MOST_TF = 255
#: Queries looked up together, sketches held at a time, documents of highest bound scored exactly at a time.
BATCH_QUERIES, SLICE_SKETCHES, STEP = 512, 1024, 8
#: Exact scores that each partition gives towards the common threshold.
SEEDS = 4
SEED_BYTES = 65_536
#: An impact is below this.
IMPACT = 1_000_000

IN_TERM = np.ones(256, dtype=bool)
IN_TERM[:0x80] = [chr(c).isalnum() for c in range(0x80)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def terms(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' terms: where each begins in the lower-cased bytes, its size, its hash and the number of its text."""
    inside = IN_TERM[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[borders] = True
    at = np.flatnonzero(edge)
    begins, ends = at[:-1], at[1:]
    kept = inside[begins] if len(begins) else np.empty(0, bool)
    begins, ends = begins[kept], ends[kept]
    text = np.searchsorted(borders, begins, side="right") - 1
    return begins, ends - begins, run_hashes(data, begins, ends - begins), text


def sketches(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of terms, sketch) of each text."""
    n_texts = len(borders) - 1
    _, _, hashes, text = terms(LOWER[data], borders)
    counts = np.bincount(text, minlength=n_texts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    tf = np.minimum(np.diff(np.append(at, len(hashes))), MOST_TF).astype(np.uint8)
    out = np.zeros(n_texts * WIDTH, dtype=np.uint8)
    np.maximum.at(out, text[at] * WIDTH + place(hashes[at]), tf)
    return counts, out.reshape(n_texts, WIDTH)


def place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (WIDTH.bit_length() - 1))).astype(np.int64)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n, sketch): one row for each row of ``docs``, with its text, its number of terms and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in text_slices(slices(batches)):
            counts, rows = sketches(data, borders)
            columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n", "sketch"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string, n long, sketch binary")


class Vocabulary:
    """The distinct terms of a batch of queries, found in texts by hash and confirmed by bytes."""

    def __init__(self, texts: list[str]):
        encoded = [t.encode() for t in texts]
        data = LOWER[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        begins, sizes, _, query = terms(data, np.cumsum([0, *map(len, encoded)]))
        own: dict[bytes, int] = {}
        which = np.array(
            [own.setdefault(data[b : b + s].tobytes(), len(own)) for b, s in zip(begins.tolist(), sizes.tolist())], np.int64
        )
        self.size = len(own)
        self.sizes = np.array([len(t) for t in own], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(own), dtype=np.uint8)
        self.hashes = run_hashes(self.data, self.begins, self.sizes)
        self.order = np.argsort(self.hashes, kind="stable")
        self.counts = np.zeros((self.size, len(texts)), dtype=np.int64)
        np.add.at(self.counts, (which, query), 1)

    def occurrences(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, tf) of the terms that texts have of this vocabulary."""
        data = LOWER[data]
        begins, sizes, hashes, text = terms(data, borders)
        found = [np.empty(0, np.int64)] * 2
        ranked = self.hashes[self.order]
        at = np.searchsorted(ranked, hashes)
        while True:  # a second round only where two terms of the vocabulary have one hash
            hit = at < self.size
            hit[hit] = ranked[at[hit]] == hashes[hit]
            begins, sizes, hashes, text, at = begins[hit], sizes[hit], hashes[hit], text[hit], at[hit]
            if not len(at):
                break
            term = self.order[at]
            same = same_runs(data, begins, sizes, self.data, self.begins[term], self.sizes[term])
            found = [np.concatenate([found[0], text[same]]), np.concatenate([found[1], term[same]])]
            begins, sizes, hashes, text, at = begins[~same], sizes[~same], hashes[~same], text[~same], at[~same] + 1
        pairs, tf = np.unique(found[0] * max(1, self.size) + found[1], return_counts=True)
        return pairs // max(1, self.size), pairs % max(1, self.size), tf


def document_frequencies(index: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Documents holding each term of the vocabulary; partitions send one row for each term they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary.size, dtype=np.int64)
        for _, data, borders in text_slices(slices(batches), 0):
            total += np.bincount(vocabulary.occurrences(data, borders)[1], minlength=vocabulary.size)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(total[has], pa.int64())], ["term", "df"])

    out = np.zeros(vocabulary.size, dtype=np.int64)
    rows = index.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in rows.collect():  # at most one row for each term of the batch
        out[term] = df
    return out


@dataclass
class Batch:
    """A batch of queries with its weights, and what a partition needs to bound and score documents."""

    vocabulary: Vocabulary
    weights: np.ndarray
    n_docs: int
    n_terms: int

    def __post_init__(self):
        places = place(self.vocabulary.hashes)
        self.places, which = np.unique(places, return_inverse=True)
        self.asked = self.vocabulary.counts * self.weights[:, None]
        self.by_place = np.zeros((len(self.places), self.asked.shape[1]))
        np.add.at(self.by_place, which, self.asked.astype(np.float64))

    def length(self, n: np.ndarray) -> np.ndarray:
        return 75 + np.array([25 * v * self.n_docs // self.n_terms for v in n.tolist()], dtype=np.int64)

    def bounds(self, rows: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(documents, queries): no score is above its bound."""
        tf = rows[:, self.places].astype(np.int64)
        doc, at = np.nonzero(tf)
        value = tf[doc, at]
        impact = np.where(value == MOST_TF, IMPACT, impacts(value, m[doc]))
        table = np.zeros(tf.shape)
        table[doc, at] = impact
        return table @ self.by_place * (1 + 1e-9)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Scorer:
    """Exact scores of a slice's documents, each text's terms being looked up when it is first asked for."""

    def __init__(self, batch: Batch, data: np.ndarray, borders: np.ndarray, m: np.ndarray):
        self.batch, self.data, self.borders, self.m = batch, data, borders, m
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def scores(self, doc: np.ndarray, query: np.ndarray) -> np.ndarray:
        new = np.array(sorted(set(np.unique(doc).tolist()) - self.known.keys()), dtype=np.int64)
        if len(new):
            texts = [self.data[self.borders[d] : self.borders[d + 1]] for d in new.tolist()]
            text, term, tf = self.batch.vocabulary.occurrences(
                np.concatenate(texts), np.cumsum([0, *map(len, texts)])
            )
            impact = impacts(tf, self.m[new[text]])
            ends = np.searchsorted(text, np.arange(len(new) + 1))
            for k, d in enumerate(new.tolist()):
                self.known[d] = term[ends[k] : ends[k + 1]], impact[ends[k] : ends[k + 1]]
        out = np.empty(len(doc), dtype=np.int64)
        order = np.argsort(doc, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else ():
            term, impact = self.known[int(doc[group[0]])]
            out[group] = impact @ self.batch.asked[term[:, None], query[group]]
        return out


def rescored(
    bounds: np.ndarray, scorer: Scorer, best: list[list[tuple[int, int]]], keys: np.ndarray, floor: np.ndarray, most: int = TOP
) -> None:
    """Score documents exactly by falling bound, ``STEP`` of each query at a time, until no bound reaches the query's
    threshold. ``best`` holds each query's (-score, key) so far, ``most`` of them."""
    order = np.argsort(-bounds, axis=0, kind="stable")
    queries = np.arange(bounds.shape[1])
    at = 0
    while len(queries) and at < len(bounds):
        doc = order[at : at + STEP, queries]
        bound = bounds[doc, queries]
        limit = np.array([max(floor[q], -best[q][-1][0] if len(best[q]) == most else 0) for q in queries.tolist()])
        take = (bound >= limit) & (bound > 0)
        query = np.broadcast_to(queries, doc.shape)[take]
        for q, s, key in zip(query.tolist(), scorer.scores(doc[take], query).tolist(), keys[doc[take]].tolist()):
            if s > 0 and s >= floor[q] and (len(best[q]) < most or (-s, key) < best[q][-1]):
                best[q] = sorted([*best[q], (-s, key)])[:most]
        queries = queries[take[-1]] if take.shape[0] == STEP else queries[:0]
        at += STEP


NO_KEY = np.iinfo(np.int64).max


def bounded(batches: Iterator[pa.RecordBatch], batch: Batch) -> Iterator[tuple]:
    """Slices of an index: keys, bytes of the texts and their borders, m, bounds."""
    for part, data, borders in text_slices(slices(batches, SLICE_SKETCHES)):
        rows = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
        m = batch.length(part.column(2).to_numpy())
        yield part.column(0).fill_null(NO_KEY).to_numpy(), data, borders, m, batch.bounds(rows, m)


def thresholds(index: DataFrame, batch: Batch, n_queries: int) -> np.ndarray:
    """For each query a score that TOP documents reach, 0 if unknown: each partition scores exactly the ``SEEDS`` texts of
    highest bound, leaving out very long ones, which it would have to hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros((0, n_queries))  # bounds and numbers of the texts held
        held: list[tuple[bytes, int]] = []
        for _, data, borders, m, bounds in bounded(batches, batch):
            bounds = np.where((np.diff(borders) <= SEED_BYTES)[:, None], bounds, 0)
            every = np.concatenate([top, bounds])
            best = np.argsort(-every, axis=0, kind="stable")[:SEEDS]
            rows = np.unique(best[np.take_along_axis(every, best, axis=0) > 0])
            texts = [(data[borders[d] : borders[d + 1]].tobytes(), int(m[d])) for d in (rows[rows >= len(top)] - len(top)).tolist()]
            held = [held[d] for d in rows[rows < len(top)].tolist()] + texts
            top = every[rows]
        found: list[list[tuple[int, int]]] = [[] for _ in range(n_queries)]
        data = np.frombuffer(b"".join(t for t, _ in held), dtype=np.uint8)
        scorer = Scorer(batch, data, np.cumsum([0, *(len(t) for t, _ in held)]), np.array([m for _, m in held], np.int64))
        rescored(top, scorer, found, np.arange(len(held)), np.zeros(n_queries, np.int64), SEEDS)
        rows = [(q, -s) for q, scores in enumerate(found) for s, _ in scores]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 2
        yield pa.RecordBatch.from_arrays(columns, ["query", "score"])

    found = index.mapInArrow(run, "query long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    floor = np.zeros(n_queries, dtype=np.int64)
    for query, score in found.withColumn("rank", rank).where(F.col("rank") == TOP).select("query", "score").collect():
        floor[query] = score
    return floor


def scanned(index: DataFrame, batch: Batch, floor: np.ndarray) -> DataFrame:
    """(query, doc_id, score): what each partition has at or above the common threshold, ``TOP`` rows a query at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in floor]
        for keys, data, borders, m, bounds in bounded(batches, batch):
            rescored(bounds, Scorer(batch, data, borders, m), best, keys, floor)
        out = [(q, key, -s) for q, found in enumerate(best) for s, key in found]
        columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


SCHEMA = "item_id long, rank int, doc_id long, score long"


def search(index: DataFrame, items: list[Row]) -> DataFrame:
    """(item_id, rank, doc_id, score) of one batch of (item_id, text)."""
    spark = index.sparkSession
    vocabulary = Vocabulary([i.text for i in items])
    n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not vocabulary.size or not n_docs:
        return spark.createDataFrame([], SCHEMA)
    df = document_frequencies(index, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    batch = Batch(vocabulary, weights, n_docs, n_terms)
    found = scanned(index, batch, thresholds(index, batch, len(items)))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    names = spark.createDataFrame([(k, i.item_id) for k, i in enumerate(items)], "query long, item_id long")
    key = F.when(F.col("doc_id") < NO_KEY, F.col("doc_id"))
    return best.join(names, "query").select("item_id", "rank", key.alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, batch_queries: int = BATCH_QUERIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``TOP`` documents of each item with a score above 0, ties by ascending doc_id.

    A null text has no terms. Rows of ``docs`` with one id are documents of their own; a null id comes after all others
    and is given as null. Repeated rows of (item_id, text) count once; texts of one item_id are ranked apart. No
    documents, no items or items without a known term give no rows. Only the id and text columns are read.
    """
    spark: SparkSession = docs.sparkSession
    index = materialise(build(docs), "sketches")
    asked = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    asked = asked.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    batches = -(-asked.count() // batch_queries)
    out = spark.createDataFrame([], SCHEMA)
    for b in range(batches):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == b
        out = out.union(search(index, asked.where(own).orderBy("item_id", "text").collect()))  # about BATCH_QUERIES rows
    return out


def oracle() -> str:
    """Every item against every document that has one of its terms."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all({lowered}, '{pattern}')) AS term FROM documents),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all({lowered}, '{pattern}')) AS term FROM benchmark),
        wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
        scored AS (
            SELECT item_id, c.doc_id,
                CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
            FROM wanted JOIN counts c USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
            GROUP BY item_id, c.doc_id),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                doc_id, score
            FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
