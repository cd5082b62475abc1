"""Toxicity by weak supervision.

Many voters look at a text: one for each word of a lexicon (general insults, and words mined from the labelled rows as
far more frequent in toxic texts) and a few for patterns. A generative model with the true label hidden estimates how
often each voter fires on toxic and on clean texts, and how far voters repeat each other; the given label is one more
voter, so single wrong labels are outvoted. Its posterior labels train a linear classifier over what the voters see.
The classifier alone scores texts.

The model is fitted on a bounded sample of labelled rows (``LABELLED_ROWS``); every text is scored whole, in one pass
without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import crc_mod, keyed_text, slices

FOLDS, HELD_OUT_FOLD = 5, 0
#: The labelled rows that the model is fitted on: those of least hash, all if there are fewer.
LABELLED_ROWS = 40_000
#: Rows of the vote table that the driver works on at a time.
CHUNK_ROWS = 2048
#: Mined voters: at most so many, each found in at least so many and so large a share of the toxic rows, and so many
#: times more likely (as a logarithm) in toxic ones.
MINED_VOTERS, LEAST_ROWS, LEAST_SHARE, LEAST_LOG_RATIO = 512, 3, 0.002, 2.0
#: Share of toxic texts assumed where no row is labelled.
PRIOR = 0.05

#: General insults in the languages of the corpus.
LEXICON = (
    "arschloch asshole bastard bitch connard crap cretin dickhead dumb estúpido fool idiot idiota idiote imbecile imbécil "
    "jerk loser miststück moron pathetic pendejo pute salaud scheiße schwein scum shit slut stupid stupide trash trottel "
    "ugly worthless"
).split()
PATTERNS = {
    "addressed": re.compile(r"\b(?:you|du|tu|eres|vous)\b[^.!?\n]{0,20}\b(?:" + "|".join(LEXICON) + r")\b", re.IGNORECASE),
    "shouting": re.compile(r"\b[A-Z]{4,}(?:[ ,]+[A-Z]{4,}){3}"),
    "exclaiming": re.compile(r"!{3,}"),
    "threat": re.compile(r"\b(?:kill|hurt|destroy) (?:you|him|her|them)\b|\bshut up\b", re.IGNORECASE),
}
STRIPPED = ".,;:!?\"'()[]{}|<>*_-…«»“”„"


def words_of(text: str) -> set[str]:
    return {w.strip(STRIPPED) for w in set(text.lower().split())}


@dataclass
class Model:
    """Voters are words, then patterns in the order of ``PATTERNS``; ``weights`` has their weights and that of the number
    of voters that fired (as log(1 + n))."""

    words: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS) + 1))
    bias: float = float(np.log(PRIOR / (1 - PRIOR)))

    def fired(self, text: str) -> list[int]:
        found = [self.words[w] for w in self.words.keys() & words_of(text)]
        return found + [len(self.words) + k for k, p in enumerate(PATTERNS.values()) if p.search(text)]

    def score(self, text: str) -> float:
        fired = self.fired(text)
        z = self.bias + self.weights[fired].sum() + self.weights[-1] * np.log1p(len(fired))
        return float(1 / (1 + np.exp(-z)))


def held_out(key: Column) -> Column:
    return crc_mod(key, FOLDS) == HELD_OUT_FOLD


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, text, toxic) of the training rows that the model is fitted on; of several labels of one id the highest."""
    key = labels[id_col].cast("long")
    known = labels.select(key.alias("doc_id"), labels[label_col].cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    each = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS)
    return docs.join(F.broadcast(chosen), "doc_id")  # at most LABELLED_ROWS rows of two numbers


def mine(sample: DataFrame) -> list[str]:
    """Words far more frequent in toxic rows than in clean ones; only those kept reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                counts[toxic].update(words_of(text) - {""})
                counts[toxic][""] += 1  # rows
            words = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *(pa.array([counts[t][w] for w in words], pa.int64()) for t in (0, 1))],
                ["word", "clean", "toxic"],
            )

    counted = sample.select("doc_id", "text", "toxic").mapInArrow(count, "word string, clean long, toxic long")
    summed = counted.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rows = summed.where("word = ''").select(F.struct("clean", "toxic")).scalar()
    each = summed.where("word <> ''").withColumn("all", rows)
    ratio = F.log((F.col("toxic") + 0.5) / (F.col("all.toxic") + 1)) - F.log((F.col("clean") + 0.5) / (F.col("all.clean") + 1))
    enough = F.greatest(F.lit(LEAST_ROWS), F.col("all.toxic") * LEAST_SHARE)
    telling = each.where((F.col("toxic") >= enough) & (ratio >= LEAST_LOG_RATIO))
    top = telling.orderBy((F.col("toxic") * ratio).desc(), "word").limit(MINED_VOTERS)
    return [r["word"] for r in top.select("word").collect()]


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability that each row is toxic.

    Expectation maximisation of P(label) * prod P(vote | label), the given label being a voter too. How much voters
    repeat each other within a class, by their correlations, lowers their weight.
    """
    posterior = np.where(given == 1, 0.9, 0.1)
    # the given label is right in most rows: it may be wrong in up to a tenth of either class
    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        single = posterior.astype(votes.dtype)
        on_toxic = (single @ votes + 0.5) / (posterior.sum() + 1)
        on_clean = ((1 - single) @ votes + 0.05) / ((1 - posterior).sum() + 1)
        right = np.clip([(posterior @ given) / max(posterior.sum(), 1), 1 - ((1 - posterior) @ given) / max((1 - posterior).sum(), 1)], 0.9, 0.999)
        products = np.zeros((votes.shape[1], votes.shape[1]))
        for lo in range(0, len(votes), CHUNK_ROWS):
            part, p = votes[lo : lo + CHUNK_ROWS], posterior[lo : lo + CHUNK_ROWS, None]
            rest = part - (p * on_toxic + (1 - p) * on_clean)
            products += rest.T @ rest
        spread = np.sqrt(products.diagonal()) + 1e-9
        alike = np.abs(products / spread[:, None] / spread[None, :])
        np.fill_diagonal(alike, 0)
        weight = 1 / (1 + np.where(alike > 0.1, alike, 0).sum(axis=1))
        fired = np.log(on_toxic) - np.log(on_clean)
        silent = np.log1p(-on_toxic.clip(max=0.999)) - np.log1p(-on_clean.clip(max=0.999))
        z = np.log(prior / (1 - prior)) + votes @ (weight * (fired - silent)).astype(votes.dtype) + (weight * silent).sum()
        z += np.where(given == 1, np.log(right[0] / (1 - right[1])), np.log((1 - right[0]) / right[1]))
        posterior = 1 / (1 + np.exp(-z.clip(-30, 30)))
    return posterior


def train_linear(x: np.ndarray, target: np.ndarray, rounds: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets: full gradient steps with momentum."""
    x, target = x.astype(np.float32), target.astype(np.float32)
    weights, bias = np.zeros(x.shape[1], dtype=np.float32), float(np.log(target.mean() / (1 - target.mean())))
    square = np.einsum("ij,ij->j", x, x) / len(x) + np.float32(1e-4)  # each feature steps by its own scale
    speed, bias_speed = np.zeros_like(weights), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ weights + np.float32(bias)).clip(-30, 30))) - target
        speed = np.float32(0.9) * speed - np.float32(0.1) * ((error @ x) / np.float32(len(x)) + np.float32(l2) * weights) / np.sqrt(square)
        bias_speed = 0.9 * bias_speed - 0.1 * float(error.mean())
        weights, bias = weights + speed, bias + bias_speed
    return weights.astype(np.float64), bias


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """From keyed texts and labels. Without labelled training rows of both classes, every text gets the prior."""
    sample = labelled_sample(docs, labels, id_col, label_col)
    words = list(dict.fromkeys([*LEXICON, *mine(sample)]))
    model = Model({w: k for k, w in enumerate(words)}, np.zeros(len(words) + len(PATTERNS) + 1))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fired = [model.fired(t) for t in batch.column(0).to_pylist()]
            columns = [pa.array(fired, pa.list_(pa.int32())), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["fired", "toxic", "place"])

    # documents of one id may be many: those of least hash, whatever the order of the rows
    voted = sample.select("text", "toxic", F.xxhash64("doc_id", "text").alias("place")).mapInArrow(
        vote, "fired array<int>, toxic int, place long"
    )
    rows = voted.orderBy("place", "toxic").limit(LABELLED_ROWS).collect()
    given = np.array([r["toxic"] for r in rows], dtype=np.float64)
    if len(set(given)) < 2:
        return model
    votes = np.zeros((len(rows), len(words) + len(PATTERNS)), dtype=np.float32)
    for k, row in enumerate(rows):
        votes[k, row["fired"]] = 1
    target = label_model(votes, given)
    model.weights, model.bias = train_linear(np.hstack([votes, np.log1p(votes.sum(axis=1, keepdims=True))]), target)
    return model


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row, by its text alone.

    A null text is empty; an empty text gets what the classifier gives without any voter. Rows without doc_id count as
    empty text for the fold. Repeated rows get equal scores; other columns are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)
    model = fit(keyed, labels, id_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred words and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = np.array([shared.value.score(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return keyed.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, SCORES)


def keep_clean(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic; the order of rows and partitions stays.

    A null text is judged as empty and stays null; repeated rows and null ids are judged one by one; an empty table stays
    empty; columns of other names, whatever they are, go with their rows.
    """
    model = fit(keyed_text(docs, id_col, text_col), labels, id_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = [shared.value.score(t or "") < 0.5 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
