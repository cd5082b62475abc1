"""Hidden Markov language model of words.

The most frequent training words are symbols of their own; every other word is one of two rare symbols (with or without
letters beyond ASCII) times the word's own smoothed share of that symbol, so a text's probability is that of its words.
Baum-Welch: each partition adds up the expected counts of its training texts, the counts are summed by blocks, and the
driver only sees the model. Every round uses all training texts, from a blank start until a round gains less than
``TOLERANCE``. The scaled forward recursion then gives every text's exact likelihood.

Word counts cover all training texts. The counts of frequent words go to every task (a fixed number); a rare word meets
its count by a join on the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import crc_mod, keyed_text
from inciscope.llm.shingles import text_slices, words
from inciscope.session import materialise

FOLDS, HELD_OUT_FOLD = 7, 2
STATES = 8
#: Frequent words that are symbols, and those whose counts every task gets.
SYMBOLS, KNOWN_COUNTS = 8192, 65_536
#: Baum-Welch ends with the first round that gains less than this share of the training texts' log likelihood.
TOLERANCE = 1e-4
#: Steps of all texts whose forward and backward values training holds at a time.
SEGMENT = 512
#: Tokens whose forward values are kept from the first pass; 96 bytes each.
HELD_TOKENS = 1_000_000
#: Texts of more tokens are cut into segments that training works on side by side: step by step, the few of them take as
#: many steps as all others together.
LONG_TEXT = 4096
#: Steps after which products of moves and emissions, in double precision, are scaled.
RESCALE = 8
#: Steps of training between scales, and the least sum of states that they may leave.
UNSCALED, LEAST_SUM = 4, 1e-16
#: Tokens worked on together in training and in scoring.
TRAIN_GROUP, SCORE_GROUP = 200_000, 2_000_000
#: Numbers of a model that are summed as one row.
BLOCK = 8192
#: Partitions whose counts are added up before the last level.
FAN = 256
#: The end of a text; word hashes are even or odd by their letters, so this even one is as unlikely as any other.
END = np.int64(-2)


@dataclass
class Vocabulary:
    """Counts of all training tokens, and the frequent words by hash."""

    total: int
    distinct: int
    known: np.ndarray  # sorted hashes
    known_count: np.ndarray
    known_symbol: np.ndarray  # -1: a rare word of known count
    symbols: int  # number of frequent words; then come the end, the rare and the rare with wide letters
    rare_size: tuple[int, int]  # N + V + 1 of either rare symbol
    end_count: int

    @property
    def end(self) -> int:
        return self.symbols


def word_counts(training: DataFrame) -> DataFrame:
    """(word, count) over the training texts, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in text_slices(batches):
            hashes, _ = words(data, borders, mark_wide=True)
            found, counts = np.unique(hashes.view(np.int64), return_counts=True)
            found, counts = np.append(found, END), np.append(counts, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["word", "count"])

    counted = training.mapInArrow(run, "word long, count long")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    wide = (F.col("word").bitwiseAND(F.lit(1)) == 1) & (F.col("word") != int(END))
    sums = counts.agg(
        F.sum("count"), F.count("*"), F.sum(F.when(wide, F.col("count"))), F.count_if(wide),
        F.max(F.when(F.col("word") == int(END), F.col("count"))),
    ).first()
    total, distinct, wide_total, wide_distinct, end_count = (int(x or 0) for x in sums)
    common = counts.where(F.col("word") != int(END)).orderBy(F.desc("count"), "word").limit(KNOWN_COUNTS).collect()
    top = common[:SYMBOLS]
    top_wide = [r for r in top if r["word"] & 1]
    rare_wide = (wide_total - sum(r["count"] for r in top_wide), wide_distinct - len(top_wide))
    rare_all = (total - end_count - sum(r["count"] for r in top), distinct - bool(end_count) - len(top))
    order = np.argsort([r["word"] for r in common], kind="stable") if common else np.empty(0, np.int64)
    known = np.array([r["word"] for r in common], dtype=np.int64)
    symbol = np.where(np.arange(len(common)) < len(top), np.arange(len(common)), -1)
    return Vocabulary(
        total, distinct, known[order], np.array([r["count"] for r in common], dtype=np.int64)[order], symbol[order],
        len(top), (sum(rare_all) - sum(rare_wide) + 1, sum(rare_wide) + 1), end_count,
    )


ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, rare_log_counts double,"
    " rare_plain long, rare_wide long, symbols binary, tail_words binary, tail_times binary"
)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Symbols of each text, what the frequent words' counts tell, and the words that must be looked up."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # KNOWN_COUNTS words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        base, n_rows = TaskContext.get().partitionId() << 40, 0
        names = [f.strip().split(" ")[0] for f in ENCODED.split(",")]
        for batch, data, borders in text_slices(batches):
            hashes, ends = words(data, borders, mark_wide=True)
            word, at = np.unique(hashes.view(np.int64), return_inverse=True)
            place = np.minimum(np.searchsorted(v.known, word), max(len(v.known) - 1, 0))
            is_known = v.known[place] == word if len(v.known) else np.zeros(len(word), bool)
            count = np.where(is_known, v.known_count[place], 0) if len(v.known) else np.zeros(len(word), np.int64)
            symbol = np.where(is_known, v.known_symbol[place], -1) if len(v.known) else np.full(len(word), -1)
            rare = symbol < 0
            wide = (word & 1).astype(bool)
            symbol = np.where(rare, v.end + 1 + wide, symbol).astype("<u2")
            log_count = np.log10(count + 1.0)
            starts = np.concatenate([[0], ends[:-1]])
            text_of = np.repeat(np.arange(batch.num_rows), ends - starts)

            def per_text(values: np.ndarray) -> np.ndarray:
                return np.bincount(text_of, weights=values[at], minlength=batch.num_rows)

            tokens, end_log = symbol[at], np.log10(v.end_count + 1.0)
            tail = np.flatnonzero(~is_known[at])
            key = np.lexsort((at[tail], text_of[tail]))
            tail_text, tail_word = text_of[tail][key], word[at[tail]][key]
            new = np.concatenate([[True], (tail_text[1:] != tail_text[:-1]) | (tail_word[1:] != tail_word[:-1])])[: len(tail)]
            firsts = np.flatnonzero(new)
            times = np.diff(np.append(firsts, len(tail))).astype("<u4")
            tail_ends = np.searchsorted(tail_text[firsts], np.arange(batch.num_rows), side="right")
            tail_word = tail_word[firsts].astype("<i8")
            tail_starts = np.concatenate([[0], tail_ends[:-1]])
            last = np.array([v.end], dtype="<u2").tobytes()
            spans, tail_spans = list(zip(starts.tolist(), ends.tolist())), list(zip(tail_starts.tolist(), tail_ends.tolist()))
            columns = [
                pa.array(base + n_rows + np.arange(batch.num_rows)), batch.column(0), batch.column(2),
                pa.array(ends - starts + 1), pa.array(per_text(is_known).astype(np.int64) + (v.end_count > 0)),
                pa.array(per_text(log_count) + end_log), pa.array(per_text(np.where(rare, log_count, 0.0))),
                pa.array(per_text(rare & ~wide).astype(np.int64)), pa.array(per_text(rare & wide).astype(np.int64)),
                pa.array([tokens[a:b].tobytes() + last for a, b in spans], pa.binary()),
                pa.array([tail_word[a:b].tobytes() for a, b in tail_spans], pa.binary()),
                pa.array([times[a:b].tobytes() for a, b in tail_spans], pa.binary()),
            ]
            n_rows += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, ENCODED)


def tail_counts(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, tail_known, tail_log): the rare words of each text that training has, and the logarithms of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b, "<i8") for b in batch.column(1).to_pylist()]
            times = [np.frombuffer(b, "<u4") for b in batch.column(2).to_pylist()]
            row = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            columns = (np.concatenate([np.empty(0, np.int64), *found]), row, np.concatenate([np.empty(0, np.int32), *times]))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, (np.int64, np.int64, np.int32))], ["word", "row", "times"])

    tail = encoded.select("row", "tail_words", "tail_times").mapInArrow(run, "word long, row long, times int")
    met = tail.join(counts, "word")  # a word that training lacks has count 0 and logarithm 0
    return met.groupBy("row").agg(
        F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("tail_log")
    )


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol by state


@dataclass
class Counts(Hmm):
    log: float  # log10 likelihood of the texts under the model they are counted by


def blank(vocab: Vocabulary, share: np.ndarray, states: int = STATES, seed: int = 7) -> Hmm:
    """States that tend to stay, each with the words' shares shaken at random."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.gamma(1.0, 1.0, (len(share), states)) + 1e-3 * share[:, None]
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def _steps(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Tokens of pieces, the longest first, laid step by step; how many pieces have each step, and where steps begin."""
    lengths = np.array([len(p) for p in pieces])
    active = len(pieces) - np.cumsum(np.bincount(lengths))[:-1]
    at = [0, *np.cumsum(active).tolist()]
    tokens, place = np.concatenate(pieces).astype(np.intp), np.cumsum(lengths) - lengths
    symbols = np.empty(at[-1], np.intp)
    for a, b in zip(at, at[1:]):
        now = place[: b - a]
        tokens.take(now, out=symbols[a:b], mode="clip")
        now += 1
    return symbols, active, at


def expected_counts(model: Hmm, texts: list[np.ndarray], spare: list[np.ndarray] | None = None) -> Counts:
    """Expected starts, moves and emissions of some texts, and their likelihood, by the scaled forward and backward
    recursions in single precision, from each text's first token to its last.

    Texts are worked on in segments of ``SEGMENT`` steps. A first pass leaves the forward state at every border, and the
    values of segments of ``HELD_TOKENS`` tokens; going back, the other segments' forward values are worked out again from
    there, and all meet the backward values of the next segment. So memory is bounded by the segment and the tokens held,
    and no move is lost at a border. The segments of texts beyond ``LONG_TEXT`` tokens, up to ``HELD_TOKENS`` or twice as many
    at a time, get the states at both borders from ``border_states`` and need not wait for each other.

    Emissions are taken relative to the symbol's largest, so a few steps may pass unscaled; where that leaves less than
    ``LEAST_SUM``, the segment is done again with every step scaled. ``spare`` keeps the memory of segments for the next call.
    """
    texts = sorted(texts, key=len, reverse=True)
    states = len(model.start)
    peak = model.emit.max(axis=1)
    start, move, emit = (np.ascontiguousarray(x, np.float32) for x in (model.start, model.move, model.emit / peak[:, None]))
    back, ones = np.ascontiguousarray(move.T), np.ones((states, states), np.float32)
    log, starts, moved = 0.0, np.zeros(states), np.zeros((states, states))
    emitted, met = np.zeros((len(emit), states)), np.zeros(len(emit), np.int64)
    spare = [] if spare is None else spare

    def forward_of(symbols: np.ndarray, at: list[int], entry: np.ndarray | None, given: np.ndarray, seen: np.ndarray, unscaled: int) -> np.ndarray:
        """The sums of states by which every ``unscaled``-th step and the last are divided; ``given`` gets the emissions over
        them, ``seen`` the states."""
        emit.take(symbols, axis=0, out=given, mode="clip")
        before, steps, sums = entry, len(at) - 1, np.empty((at[1], states), np.float32)
        scaled = [*range(unscaled - 1, steps - 1, unscaled), steps - 1]
        scales = np.empty(sum(at[t + 1] - at[t] for t in scaled), np.float32)
        first = done = 0
        for last in scaled:
            for t in range(first, last + 1):
                a, b = at[t], at[t + 1]
                now = seen[a:b]
                if before is None:
                    np.multiply(given[a:b], start, out=now)
                else:
                    np.dot(before[: b - a], move, out=now)
                    now *= given[a:b]
                before = now
            sum_of = np.dot(now, ones, out=sums[: b - a])
            now /= sum_of
            given[a:b] /= sum_of
            scales[done : done + b - a] = sum_of[:, 0]
            first, done = last + 1, done + b - a
        return scales

    def forward_pass(pieces: list[np.ndarray], entry: np.ndarray | None) -> tuple[np.ndarray, tuple]:
        """The last step's states, and the segment."""
        symbols, active, at = _steps(pieces)
        size = 3 * states * len(symbols)
        fits = [k for k, room in enumerate(spare) if size <= len(room) <= 1.25 * size]
        room = spare.pop(fits[-1]) if fits else np.empty(size, np.float32)
        given, seen, backward = room[:size].reshape(3, -1, states)
        places = np.repeat(at[:-1], active - np.append(active[1:], 0))[::-1] + np.arange(active[0])  # of last tokens
        with np.errstate(divide="ignore", invalid="ignore"):
            scales = forward_of(symbols, at, entry, given, seen, UNSCALED)
            ends = seen[places].sum(axis=1, keepdims=True)
        if not min(scales.min(), ends.min()) >= LEAST_SUM:
            scales = forward_of(symbols, at, entry, given, seen, 1)
            ends = seen[places].sum(axis=1, keepdims=True)
        log_scale = float(np.log(scales).sum(dtype=float) + np.log(ends).sum(dtype=float))
        return seen[at[-2] :], (symbols, active, at, given, seen, backward, places, ends, log_scale, room)

    def leave(room: np.ndarray) -> None:
        spare.append(room)
        while sum(map(len, spare)) > 3 * states * HELD_TOKENS:
            spare.pop(0)

    def count(segment: tuple, entry: np.ndarray | None, exits: np.ndarray | None) -> np.ndarray:
        """Add up a segment, whose first pieces' backward values begin with ``exits``; the products of its first step's
        emissions and backward values. The segment's memory is spare afterwards."""
        nonlocal log, starts, moved, emitted, met
        symbols, active, at, given, seen, backward, places, ends, log_scale, room = segment
        log += log_scale / np.log(10)
        backward[places] = 1 / ends
        if exits is not None:
            backward[places[: len(exits)]] = exits
        for t in range(len(active) - 1, 0, -1):
            a, b = at[t], at[t + 1]
            now = given[a:b]
            now *= backward[a:b]
            np.dot(now, back, out=backward[at[t - 1] : at[t - 1] + b - a])
        width = int(active[0])
        given[:width] *= backward[:width]
        if entry is not None:
            moved += entry.T @ given[:width]
        borders = [0, *(np.flatnonzero(np.diff(active)) + 1).tolist(), len(active)]
        for i, j in zip(borders, borders[1:]):  # steps of as many pieces follow each other place by place
            n = at[i + 1] - at[i]
            if i:
                moved += np.dot(seen[at[i - 1] : at[i - 1] + n].T, given[at[i] : at[i + 1]])
            if j - i > 1:
                moved += np.dot(seen[at[i] : at[j - 1]].T, given[at[i + 1] : at[j]])
        seen *= backward
        if entry is None:
            starts += seen[:width].sum(axis=0, dtype=float)
        met += np.bincount(symbols, minlength=len(emit))
        for k in range(states):
            emitted[:, k] += np.bincount(symbols, seen[:, k], len(emit))
        firsts_given = given[:width].copy()
        leave(room)
        return firsts_given

    side, room = [t for t in texts if LONG_TEXT < len(t) <= HELD_TOKENS], HELD_TOKENS
    batch_of = np.cumsum([len(t) for t in side]) // HELD_TOKENS
    batches = [[t for t, n in zip(side, batch_of) if n == k] for k in np.unique(batch_of)]
    for pieces, entry, exits in (borders for batch in batches for borders in border_states(model, batch)):
        _, segment = forward_pass(pieces, entry)
        _, _, _, _, seen, _, places, *_ = segment
        exits = exits / (seen[places] * exits).sum(axis=1, keepdims=True)
        count(segment, entry, exits.astype(np.float32))

    texts = [t for t in texts if not LONG_TEXT < len(t) <= HELD_TOKENS]
    lengths = np.array([len(t) for t in texts])

    def pieces_of(first: int) -> list[np.ndarray]:
        return [t[first : first + SEGMENT] for t in texts[: int((lengths > first).sum())]]

    firsts = range(0, int(lengths[0]) if texts else 0, SEGMENT)
    before: list[np.ndarray | None] = [None]
    held: dict[int, tuple] = {}
    for first in firsts[:-1]:
        last, segment = forward_pass(pieces_of(first), before[-1])
        before.append(last[: int((lengths > first + SEGMENT).sum())].copy())
        if len(segment[0]) <= room:
            room -= len(segment[0])
            held[first] = segment
        else:
            leave(segment[-1])
        del segment
    later: np.ndarray | None = None  # backward values that the next segment gives to this one's last step
    for first, entry in zip(reversed(firsts), reversed(before)):
        segment = held.pop(first) if first in held else forward_pass(pieces_of(first), entry)[1]
        firsts_given = count(segment, entry, later)
        later = firsts_given @ back if entry is not None else None
        del segment
    return Counts(starts, moved * model.move, emitted, log + float(met @ np.log10(peak)))


def border_states(model: Hmm, texts: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray | None, np.ndarray]]:
    """Segments of texts, the longest first, with the forward states before them (None before a text's first token) and, up
    to a factor, the backward values of their last steps.

    Each segment gives a matrix: how its last step's states follow from each state before it. All matrices are worked out
    side by side; along a text their products give the states at its borders. Segments leave in batches of ``TRAIN_GROUP``
    tokens.
    """
    states = len(model.start)
    cut = [(k, text[i : i + SEGMENT], i == 0) for k, text in enumerate(texts) for i in range(0, len(text), SEGMENT)]
    order = sorted(range(len(cut)), key=lambda c: -len(cut[c][1]))
    symbols, active, at = _steps([cut[c][1] for c in order])
    opens = np.array([cut[c][2] for c in order])
    moves = np.where(opens[:, None, None], model.start, model.move)  # by segment, state before, state of the first step
    for t, n in enumerate(active):
        if t:
            moves[:n] = np.dot(moves[:n].reshape(-1, states), model.move).reshape(-1, states, states)
        moves[:n] *= model.emit.take(symbols[at[t] : at[t + 1]], axis=0)[:, None, :]
        if t % RESCALE == 0:
            moves[:n] /= moves[:n].max(axis=(1, 2), keepdims=True)
    step = np.empty_like(moves)
    step[order] = moves
    entry, leave = np.full((len(cut), states), 1 / states), np.ones((len(cut), states))
    for c in range(1, len(cut)):
        if not cut[c][2]:
            entry[c] = entry[c - 1] @ step[c - 1]
            entry[c] /= entry[c].sum()
    for c in range(len(cut) - 2, -1, -1):
        if not cut[c + 1][2]:
            leave[c] = step[c + 1] @ leave[c + 1]
            leave[c] /= leave[c].sum()
    size = max(1, TRAIN_GROUP // SEGMENT)
    for first in (True, False):
        chosen = [c for c in order if cut[c][2] == first]
        for i in range(0, len(chosen), size):
            batch = chosen[i : i + size]
            yield [cut[c][1] for c in batch], None if first else entry[batch].astype(np.float32), leave[batch]


def add(a: Counts | None, b: Counts) -> Counts:
    return b if a is None else Counts(a.start + b.start, a.move + b.move, a.emit + b.emit, a.log + b.log)


def estimate(counts: Counts, share: np.ndarray) -> Hmm:
    """The model that makes expected counts likeliest, smoothed by a word's share of all tokens."""
    emit = counts.emit + share[:, None]
    move, start = counts.move + 0.01, counts.start + 0.01
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def grouped(texts: list[np.ndarray], limit: int) -> Iterator[list[np.ndarray]]:
    """Texts of like length, of which one segment has about ``limit`` tokens."""
    texts = sorted(texts, key=len)
    lo = total = 0
    for k, t in enumerate(texts):
        size = min(len(t), SEGMENT)
        if total and total + size > limit:
            yield texts[lo:k]
            lo, total = k, 0
        total += size
    if texts[lo:]:
        yield texts[lo:]


def baum_welch_round(training: DataFrame, model: Hmm) -> Counts | None:
    """Counts of one round over all training texts; partial counts are summed by blocks of ``BLOCK`` numbers, those of
    ``FAN`` partitions first."""
    shared = training.sparkSession.sparkContext.broadcast(model)  # states times symbols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, n, spare = None, [], 0, []

        def work() -> Counts | None:
            done = total
            for group in grouped([np.frombuffer(b, "<u2") for b in waiting], TRAIN_GROUP):
                done = add(done, expected_counts(shared.value, group, spare))
            return done

        for batch in batches:
            texts = batch.column(0).to_pylist()
            waiting += texts
            n += sum(map(len, texts))
            if n > 2 * SCORE_GROUP:
                total, waiting, n = work(), [], 0
        total = work()
        if total is not None:
            flat = np.concatenate([[total.log], total.start, total.move.ravel(), total.emit.ravel()])
            parts = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["block", "part"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(*(c.to_pylist() for c in batch.columns)):
                totals[block] = totals.get(block, 0.0) + np.frombuffer(part)
        parts = [totals[b].tobytes() for b in totals]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(parts, pa.binary())], ["block", "part"])

    kind = "block int, part binary"
    partial = training.select("symbols").mapInArrow(run, kind).withColumn("place", F.floor(F.spark_partition_id() / FAN))
    level = partial.repartition("block", "place").select("block", "part").mapInArrow(sums, kind)
    rows = level.repartition("block").mapInArrow(sums, kind).collect()
    shared.destroy()
    if not rows:
        return None
    flat = np.concatenate([np.frombuffer(r["part"]) for r in sorted(rows)])
    k, log, flat = len(model.start), float(flat[0]), flat[1:]
    return Counts(flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k :].reshape(-1, k), log)


def symbol_shares(vocab: Vocabulary) -> np.ndarray:
    counts = np.zeros(vocab.symbols + 3)
    own = vocab.known_symbol >= 0
    counts[vocab.known_symbol[own]] = vocab.known_count[own]
    counts[vocab.end] = vocab.end_count
    counts[vocab.end + 1 :] = vocab.rare_size
    return (counts + 1) / (counts + 1).sum()


def train(training: DataFrame, vocab: Vocabulary, states: int = STATES) -> Hmm:
    """``training`` has the symbols of the training texts."""
    share = symbol_shares(vocab)
    model = blank(vocab, share, states)
    last = -np.inf
    while (counts := baum_welch_round(training, model)) is not None:
        model = estimate(counts, share)
        if counts.log - last < TOLERANCE * abs(counts.log):
            break
        last = counts.log
    return model


def log10_likelihood(model: Hmm, texts: list[np.ndarray]) -> np.ndarray:
    """Of each text, by the forward recursion, scaled every ``UNSCALED`` steps and at the text's end; texts run side by side."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    pieces = [texts[i] for i in order]
    tokens = np.concatenate(pieces).astype(np.intp)
    lengths = np.array([len(p) for p in pieces])
    place = np.cumsum(lengths) - lengths
    active = len(pieces) - np.cumsum(np.bincount(lengths))[:-1]
    out, ones = np.zeros(len(texts)), np.ones(len(model.start))
    forward = None
    for t, n in enumerate(active.tolist()):
        if forward is not None and n < len(forward):
            out[n : len(forward)] += np.log10(forward[n:] @ ones)
        given = model.emit.take(tokens.take(place[:n]), axis=0)
        place[:n] += 1
        forward = given * model.start if forward is None else np.dot(forward[:n], model.move) * given
        if t % UNSCALED == UNSCALED - 1:
            scale = forward @ ones
            forward /= scale[:, None]
            out[:n] += np.log10(scale)
    out[: len(forward)] += np.log10(forward @ ones)
    result = np.empty(len(texts))
    result[order] = out
    return result


def likelihoods(encoded: DataFrame, model: Hmm) -> DataFrame:
    """Columns of ``encoded`` but for the words, with ``symbol_log``: log10 likelihood of the symbols."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    narrow = [c for c in encoded.columns if c not in ("symbols", "tail_words", "tail_times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def scored() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = [np.frombuffer(b, "<u2") for b in table.column("symbols").to_pylist()]
            found = log10_likelihood(shared.value, texts)
            return table.select(narrow).append_column("symbol_log", pa.array(found)).to_batches()[0]

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.column(len(narrow)).nbytes // 2
            if n > SCORE_GROUP:
                yield scored()
                held, n = [], 0
        if held:
            yield scored()

    schema = ", ".join(f for f in map(str.strip, ENCODED.split(",")) if f.split(" ")[0] in narrow)
    return encoded.select(*narrow, "symbols").mapInArrow(run, f"{schema}, symbol_log double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES) -> DataFrame:
    """Token counts, the smoothed unigram score and the model's score (both log10) of each row.

    A null or empty text is its end alone. Rows without doc_id belong to the training texts. Repeated rows are counted
    and scored one by one. Without any training text all words are unknown and the model is its blank start. Other
    columns are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)
    fold = crc_mod(F.col("doc_id"), FOLDS)
    marked = keyed.select("doc_id", "text", (F.col("doc_id").isNotNull() & (fold == HELD_OUT_FOLD)).alias("held_out"))
    counts = materialise(word_counts(marked.where("NOT held_out").select("doc_id", "text")), "hmm-counts")
    vocab = vocabulary(counts)
    encoded = materialise(encode(marked, vocab), "hmm-encoded")
    model = train(encoded.where("NOT held_out"), vocab, states)
    tail = tail_counts(encoded, counts)
    each = likelihoods(encoded, model).join(tail, "row", "left")
    tail_log, tail_known = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("tail_known", F.lit(0))
    plain, wide = (float(np.log10(n)) for n in vocab.rare_size)
    base = F.col("log_counts") + tail_log - F.col("n_tokens") * float(np.log10(vocab.total + vocab.distinct + 1))
    rare = F.col("rare_log_counts") + tail_log - F.col("rare_plain") * plain - F.col("rare_wide") * wide
    return each.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + tail_known).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("symbol_log") + rare).alias("score"),
    )
