"""Ranked lexical search against a plain scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from inciscope.llm import lexical, shingles

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_rank(docs, items):
    own = [(key, Counter(plain_terms(text))) for key, text in docs]
    own = [(key, terms, sum(terms.values())) for key, terms in own if terms]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, terms, _ in own for t in terms)
    out = []
    for item, text in sorted(set(items)):
        scored = []
        for key, terms, n in own:
            m, score = 75 + 25 * n * n_docs // n_terms, 0
            for t in plain_terms(text):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * terms[t] // (1000 * terms[t] + 12 * m))
            if score:
                scored.append((-score, math.inf if key is None else key))
        out += [(item, k + 1, None if key == math.inf else key, -s) for k, (s, key) in enumerate(sorted(scored)[:20])]
    return out


def found_rank(spark, docs, items, batch=512):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical.rank(d, i, batch).collect()), key=lambda r: r[:2])


def text(rng, words, most):
    return rng.choice(" \t-") .join(rng.choice(words) for _ in range(rng.randint(0, most)))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_plain(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Élan", "ÉLAN", "élan", "日本", "A1b", "İ", "\x80x", "ſ"] + ["the"] * 40
    docs = [(k, text(rng, words, 80)) for k in range(150)] + [(500 + k, "the same text w1 w2") for k in range(40)]
    docs += [(7, "repeated id w3"), (7, "repeated id w3"), (None, "no id w4 w5"), (900, None), (901, ""), (902, "... --")]
    docs += [(903, "w6 " * 20_000 + "w7")]
    items = [(k, text(rng, words, 12)) for k in range(20)] + [(30, None), (31, "unheard of"), (32, "w6 w6 w6 w7"), (32, "w6 w6 w6 w7")]
    items = [(k, t or "") for k, t in items]
    assert found_rank(spark, docs, items) == plain_rank(docs, items)
    if not seed:
        assert found_rank(spark, docs, items, batch=5) == plain_rank(docs, items)


def test_empty_tables_and_foreign_columns(spark):
    assert found_rank(spark, [], [(1, "a")]) == [] == found_rank(spark, [(1, "a")], []) == found_rank(spark, [(1, None)], [(1, "a")])
    docs = spark.createDataFrame([(1, "a b", 3, "x", 9)], "doc_id long, text string, n long, sketch string, score long")
    items = spark.createDataFrame([(5, "b", 1)], "item_id long, text string, rank int")
    assert [tuple(r)[:3] for r in lexical.rank(docs, items).collect()] == [(5, 1, 1)]


def test_bounds_are_never_below_scores():
    rng = random.Random(9)
    words = [f"t{i}" for i in range(5000)]
    texts = [text(rng, words, 1500) for _ in range(40)] + ["t1 " * 400]
    asked = [text(rng, words, 30) + " t1" for _ in range(15)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    borders = np.cumsum([0, *(len(t.encode()) for t in texts)])
    counts, rows = lexical.sketches(data, borders)
    vocabulary = lexical.Vocabulary(asked)
    df = np.bincount(vocabulary.occurrences(data, borders)[1], minlength=vocabulary.size)
    weights = np.array([math.floor(1000 * math.log(84 / (2 * d + 1))) for d in df.tolist()])
    batch = lexical.Batch(vocabulary, weights, 41, int(counts.sum()))
    m = batch.length(counts)
    bounds = batch.bounds(rows, m)
    doc, query = np.indices(bounds.shape).reshape(2, -1)
    scores = lexical.Scorer(batch, data, borders, m).scores(doc, query).reshape(bounds.shape)
    assert (bounds >= scores).all() and (scores > 0).any()


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    """Were all hashes equal, bytes would still decide."""
    monkeypatch.setattr(lexical, "run_hashes", lambda data, begins, sizes: np.zeros(len(begins), np.uint64))
    vocabulary = lexical.Vocabulary(["one two three two"])
    text = np.frombuffer(b"two four two Onetwo three", np.uint8)
    found = vocabulary.occurrences(text, np.array([0, 13, 25]))
    names = ["one", "two", "three"]
    assert [(d, names[t], n) for d, t, n in zip(*(x.tolist() for x in found))] == [(0, "two", 2), (1, "three", 1)]


def test_run_hashes_have_no_structure():
    """Thue-Morse words of one length collide under any polynomial hash modulo 2**64."""
    for power in (10, 11, 12):
        word = np.array([bin(i).count("1") % 2 for i in range(1 << power)], dtype=np.uint8)
        pair = np.concatenate([word, 1 - word]) + ord("a")
        size = np.full(2, 1 << power)
        a, b = shingles.run_hashes(pair, np.array([0, 1 << power]), size)
        assert a != b
        assert not shingles.same_runs(pair, np.array([0]), size[:1], pair, np.array([1 << power]), size[:1]).any()
