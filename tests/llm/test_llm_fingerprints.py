"""Order MinHash: its parts against plain versions, and what it is for."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from inciscope.llm import fingerprints as fp


def test_occurrences_are_numbered_in_text_order():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("abé\U0001f600") for _ in range(rng.randint(0, 60)))
        k = min(3, len(text))
        seen, plain = Counter(), []
        for i in range(len(text) - k + 1 if text else 0):
            plain.append((text[i : i + k], seen[text[i : i + k]]))
            seen[text[i : i + k]] += 1
        found = fp.numbered_kmers(text, 3).tolist()
        assert len(found) == len(plain) == len(set(found))
        assert dict(zip(found, plain)) == {h: p for h, p in zip(found, plain)}


def test_same_numbered_kmers_have_same_hash():
    a, b = fp.numbered_kmers("abcabcabc", 3), fp.numbered_kmers("xxabcabc", 3)
    assert set(a.tolist()) & set(b.tolist()) >= {int(fp.numbered_kmers("abc", 3)[0])}
    assert a[0] == b[2] and a[3] == b[5]


def test_tuples_keep_text_order():
    """Selected k-mers, chosen by brute force, give the same numbers; swapping halves changes them."""
    text = "the quick brown fox jumps over the lazy dog and runs away"
    kmers = fp.numbered_kmers(text)
    want = []
    for multiplier in fp._multipliers(fp.M):
        order = sorted(range(len(kmers)), key=lambda i: int(kmers[i]) * int(multiplier) % 2**64)[: fp.L]
        value = np.zeros(1, dtype=np.uint64)
        for i in sorted(order):
            value = fp._mix(value * fp.ODD + kmers[i : i + 1])
        want.append(int(value[0]) >> 48)
    assert fp.fingerprint(text).tolist() == want


def test_likeness_falls_with_edits():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    scores = []
    for share in (0, 0.001, 0.01, 0.05, 0.3):
        changed = list(text)
        for i in rng.sample(range(len(text)), int(share * len(text))):
            changed[i] = "z"
        scores.append(fp.likeness(fp.fingerprint(text), fp.fingerprint("".join(changed))))
    assert scores[0] == 1 and scores == sorted(scores, reverse=True) and scores[2] > scores[4] + 0.3
    turned = text[2000:] + text[:2000]
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(turned)) < 0.9  # the same k-mers in another order


def plain_rows(rows):
    """The whole operator over one sorted list."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[: len(text) - n] + after[:n]
        own, other, following = fp.fingerprint(text), fp.fingerprint(changed), fp.fingerprint(after)
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), other.tobytes().hex(),
             float((own == other).mean()), float((own == following).mean()))
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [1, 22, None])
def test_next_documents_across_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(fp.with_successor, "__defaults__", (blocks,))
    rng = random.Random(9)
    rows = [(k * 7, "".join(rng.choice("ab cé") for _ in range(rng.randint(0, 90))), "x") for k in range(60)]
    rows += [(700, "long \u00e9 " * 30_000, "x"), (701, "another " * 25_000, "x")]
    rows += [(14, rows[2][1], "x"), (21, None, "y"), (21, "other", "y"), (None, "no id", "z"), (None, None, "z"), (-5, "last \U0001f600", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    assert sorted(map(tuple, fp.edited_likeness(docs).collect()), key=str) == plain_rows(rows)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    row = fp.edited_likeness(one).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"aba").hexdigest()
    assert fp.edited_likeness(one.limit(0)).collect() == []
    assert fp.fingerprints(one.union(one)).distinct().count() == 1
