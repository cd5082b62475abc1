"""The similarity join against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from inciscope.llm import ngram_join as nj
from inciscope.llm.components import components
from inciscope.llm.shingles import shingle_sets, text_bytes, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER))


def plain_sets(rows):
    out = []
    for _, text, *_ in rows:
        w = plain_words(text)
        out.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def plain_groups(rows):
    """(doc_id, n_shingles, component_id) and the group of each row."""
    sets, parent, lists = plain_sets(rows), list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        shared = Counter(o for g in s for o in lists[g])
        for o, c in shared.items():
            if 100 * c >= 75 * (len(s) + len(sets[o]) - c):
                parent[root(k)] = root(o)
        for g in s:
            lists[g].append(k)
    least = {}
    for k, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return [(r[0], len(s), least.get(root(k))) for k, (r, s) in enumerate(zip(rows, sets))], [root(k) for k in range(len(rows))]


def edge_rows():
    return [
        (5000, None), (5001, ""), (None, "a b c"), (None, "a b c"), (5002, "A B  c"), (7, "z z z z z z z z z"),
        (7, "z z z z z"), (None, "only null here ok ok ok ok"), (6000, "\n \t"), (6001, "é É é É é"), (6002, "Ü x"),
        (6003, "x " * 30_000), (6004, "y" * 200_000),
    ]


def fuzz(seed, n):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcde") + str(rng.randint(0, 300)) for _ in range(rng.choice([3, 6, 12, 40, 100]))) for _ in range(25)]
    rows = []
    for k in range(n):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice("xyz") + str(rng.randint(0, 30))
        if rng.random() < 0.3:
            w = w[rng.randint(0, 3) :]
        if rng.random() < 0.2:
            w += rng.choice(base).split()[: rng.randint(0, 30)]
        rows.append((k, " ".join(w)))
    return rows


def near_copy_family(seed, n):
    """One text with copies that differ in some words each, and a passage that unrelated texts share."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 10**6))
    first = [word() for _ in range(150)]
    passage = [word() for _ in range(40)]
    rows = []
    for k in range(n):
        w = list(first)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8])):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    return rows + [(n + k, " ".join(passage + [word() for _ in range(rng.choice([5, 12, 60]))])) for k in range(n)]


CASES = {"fuzz": lambda: fuzz(3, 700) + edge_rows(), "family": lambda: near_copy_family(5, 250)}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("limits", [{}, {"MOST_COUNTED": 3, "INDEX_NODES": 4, "FILTER_BITS": 1 << 15}])
def test_groups_as_brute_force(spark, monkeypatch, case, limits):
    for name, value in limits.items():
        monkeypatch.setattr(nj, name, value)
    rows = CASES[case]()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string").repartition(5)
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in nj.groups(docs).collect()]
    assert sorted(found, key=str) == sorted(plain_groups(rows)[0], key=str)


def test_one_row_of_each_group_stays(spark):
    rows = [(k, t, f"_{k}", "n") for k, t in fuzz(8, 200)] + [(k, t, None, "n") for k, t in edge_rows()] + [(3, "a b c", "rep", "n")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string")
    kept = nj.representatives(docs)
    assert kept.schema == docs.schema
    _, group = plain_groups(rows)
    sets = plain_sets(rows)
    least = {}
    for k, r in enumerate(rows):
        if sets[k]:
            least[group[k]] = min(least.get(group[k], 10**9), 10**9 if r[0] is None else r[0])
    want = sorted([v for v in least.values() if v < 10**9] + [r[0] for k, r in enumerate(rows) if not sets[k]])
    found = [tuple(r) for r in kept.collect()]
    assert sorted(r[0] for r in found if r[0] is not None) == want
    assert sum(r[0] is None for r in found) == sum(v == 10**9 for v in least.values())
    assert set(found) <= set(rows)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nj.groups(docs).collect() == [] == nj.representatives(docs).collect()


def test_words_and_sets_of_many_texts_at_once():
    import pyarrow as pa

    texts = ["", "A b", " a  B\n", "Ä ä a\x0bb", "x", "", "q w e r t z u", "Q w e r t z u "]
    ends, data = text_bytes(pa.array(["skip", *texts]).slice(1))
    hashes, stops = words(data[ends[0] : ends[-1]], ends - ends[0])
    known, at = {}, 0
    for text, stop in zip(texts, stops):
        for w, h in zip(plain_words(text), hashes[at:stop].tolist(), strict=True):
            assert known.setdefault(w, h) == h
        at = stop
    assert len(set(known.values())) == len(known)
    sets = [tuple(s) for s in shingle_sets(hashes, stops)]
    assert [len(s) for s in sets] == [0, 1, 1, 1, 1, 0, 3, 3]
    assert sets[1] == sets[2] != sets[3] and sets[6] == sets[7]
    assert all(np.all(np.diff(np.array(s, dtype=np.uint64)) > 0) for s in sets)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(50)] + [(500, 500), (7, 6), (7, 6)]
    edges += [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(150)]
    rng.shuffle(edges)
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    want = {(v, root(v)) for e in edges if e[0] != e[1] for v in e}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_index_finds_a_link_if_there_is_one():
    rng = random.Random(6)
    for _ in range(100):
        pool = [rng.getrandbits(60) for _ in range(40)]
        sets = [np.array(sorted(rng.sample(pool, rng.randint(1, 30)))) for _ in range(30)]
        index = nj.Index([(k, len(s), s) for k, s in enumerate(sets)])
        query = np.array(sorted(rng.sample(pool, rng.randint(1, 30))))
        linked = {k for k, s in enumerate(sets) if nj.links(len(query), len(s), len(set(query) & set(s)))}
        found = index.search(len(query), query)
        assert found in linked if linked else found is None


def test_words_of_like_structure_are_different_words(spark):
    """Thue-Morse words collide under any polynomial hash modulo 2**64; here they share no shingle."""
    for power in (10, 11, 12):
        bits = [bin(i).count("1") % 2 for i in range(1 << power)]
        a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
        rows = [(1, a), (2, b), (3, f"{a} x"), (4, f"{b} x"), (5, f"x {a} y z w v"), (6, f"x {b} y z w v"), (7, a)]
        found = {r.doc_id: r.component_id for r in nj.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}
