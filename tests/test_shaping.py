import random

import pytest
from pyspark.sql import functions as F

from inciscope.operators import shaping, windows


def test_delete_where_keeps_unknown(spark, rows):
    frame = spark.createDataFrame([(0, "1"), (5, "13"), (5, None), (None, "2"), (None, "21")], "area int, district string")
    condition = (F.col("area") == 0) | F.col("district").try_cast("int").isin(13, 21)
    assert rows(shaping.delete_where(frame, condition)) == [(None, "2"), (5, None)]


def test_keep_castable(spark, rows):
    frame = spark.createDataFrame([("1",), (" 2 ",), ("ID",), ("",), (None,), ("3.0",)], "id string")
    assert rows(shaping.keep_castable(frame, "id", "bigint")) == [(" 2 ",), ("1",)]


def test_dedup_is_total_and_prunes_before_the_shuffle(spark, rows, plan):
    data = [(1, "a", 5), (1, "b", 5), (1, "b", 4), (2, None, 1), (2, "z", 1), (None, "n", 9)]
    results = set()
    for _ in range(4):
        random.shuffle(data)
        frame = spark.createDataFrame(data, "id int, v string, seq int").repartition(5)
        kept = shaping.dedup_latest(frame, ["id"], [F.desc("seq")])
        results.add(tuple(rows(kept)))
    assert results == {((1, "a", 5), (2, None, 1))}
    text = plan(kept)
    assert text.count("WindowGroupLimit") == 2  # one before the exchange, one after


def test_dedup_with_one_key_holding_a_third_of_the_rows(spark):
    frame = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("seq")
    )
    kept = shaping.dedup_latest(frame, ["key"], [F.desc("seq")])
    assert kept.count() == 60_001
    assert kept.filter("key = -1").first()["seq"] == 89_997


def test_top_k_per_group_prunes_before_the_shuffle(spark, rows, plan):
    frame = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "g string, v int")
    top = shaping.top_k_per_group(frame, ["g"], [F.desc("v")], 2)
    assert rows(top) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]
    assert plan(top).count("WindowGroupLimit") == 2


def test_union_and_counts(spark, rows):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([("y", 2), ("z", 3)], "b string, a int")
    both = shaping.union_tagged({"one": one, "two": two}, "tag")
    assert rows(both) == [(1, "x", "one"), (2, "y", "two"), (3, "z", "two")]
    report = shaping.row_counts({"one": one, "two": two}, ["one", "two"], "ALL")
    assert rows(report) == [("ALL", 3), ("one", 1), ("two", 2)]


def test_preview_and_projection(spark, rows):
    frame = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "a int, b string")
    assert rows(shaping.preview(frame, [F.asc("a")], 2)) == [(1, "a"), (2, "b")]
    assert shaping.select_as(frame, {"x": "b", "y": F.col("a") + 1}).columns == ["x", "y"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_surrogate_key_is_the_global_dense_rank(spark, seed):
    random.seed(seed)
    words = [None, "", "a", "ab", "abc", "abd", "b", "ba", "Z", "é", "zz"] + [
        "".join(random.choices("abc", k=random.randint(1, 5))) for _ in range(60)
    ]
    data = list({(random.choice(words), random.choice([None, 1, 2, 3])) for _ in range(200)})
    frame = spark.createDataFrame(data, "w string, n int").repartition(4)
    keyed = windows.assign_surrogate_key(frame, ["w", "n"], "key").collect()
    order = sorted(data, key=lambda t: (t[0] is not None, (t[0] or "").encode(), t[1] is not None, t[1] or 0))
    assert {(r["w"], r["n"]): r["key"] for r in keyed} == {t: i + 1 for i, t in enumerate(order)}
    numbers = spark.createDataFrame([(v,) for v in (5, 3, 3, None, 8)], "n int").distinct()
    ranked = windows.assign_surrogate_key(numbers, ["n"], "key").orderBy("key").collect()
    assert [(r["key"], r["n"]) for r in ranked] == [(1, None), (2, 3), (3, 5), (4, 8)]


def test_a_null_period_has_no_earlier_one(spark, rows):
    frame = spark.createDataFrame([("a", None, 5), ("a", 2000, 1), ("a", 2001, 2)], "k string, y int, n int")
    out = windows.period_over_period(frame, ["k"], "y", {"n": "before"})
    assert rows(out.select("y", "before")) == [(None, None), (2000, None), (2001, 1)]


@pytest.mark.parametrize("shared", ["same prefix ", ""])
def test_surrogate_keys_are_ranked_in_range_partitions(spark, shared):
    """A prefix or leading value that all rows share still leaves them in several partitions."""
    frame = spark.range(4000).select(F.concat(F.lit(shared), F.lpad(F.col("id").cast("string"), 5, "0")).alias("w"), F.lit(1).alias("n"))
    keyed = windows.assign_surrogate_key(frame.repartition(8), ["n", "w"], "key")
    assert [r["key"] for r in keyed.orderBy("w").collect()] == list(range(1, 4001))


def test_period_over_period_needs_the_exact_period(spark, rows):
    frame = spark.createDataFrame([("a", 2001, 5), ("a", 2002, 7), ("a", 2004, 9), ("b", 2002, 1)], "k string, y int, n int")
    paired = windows.period_over_period(frame, ["k"], "y", {"n": "prev"})
    assert rows(paired) == [("a", 2001, 5, None), ("a", 2002, 7, 5), ("a", 2004, 9, None), ("b", 2002, 1, None)]


def test_shares_sum_to_a_hundred(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 5)], "g string, k string, n int")
    grand = windows.with_share(frame, "n", "pct").collect()
    assert sum(r["pct"] for r in grand) == pytest.approx(100, abs=0.05)
    within = {(r["g"], r["k"]): r["pct"] for r in windows.with_share(frame, "n", "pct", ["g"]).collect()}
    assert within == {("a", "x"): 33.33, ("a", "y"): 66.67, ("b", "x"): 100.0}
    by_key = {r["g"]: (r["n"], r["pct"]) for r in windows.share_by(frame, "g", "n", "pct").collect()}
    assert by_key == {"a": (2, 66.67), "b": (1, 33.33)}


def test_moving_average_and_ranks(spark, rows):
    frame = spark.createDataFrame([(1, 10), (2, 20), (3, 40), (4, 41)], "t int, n int")
    smoothed = windows.moving_average(frame, ["t"], "n", 3, "avg")
    assert rows(smoothed) == [(1, 10, 10.0), (2, 20, 15.0), (3, 40, 23.0), (4, 41, 34.0)]
    tied = spark.createDataFrame([("g", 5), ("g", 5), ("g", 3)], "g string, n int")
    assert rows(windows.with_rank(tied, ["g"], [F.desc("n")], "r")) == [("g", 3, 3), ("g", 5, 1), ("g", 5, 1)]
    assert rows(windows.with_dense_rank(tied, ["g"], [F.desc("n")], "r")) == [("g", 3, 2), ("g", 5, 1), ("g", 5, 1)]


@pytest.mark.parametrize("stretch", [2, 7, 59, 1000])
def test_moving_average_over_stretches(spark, plan, monkeypatch, stretch):
    monkeypatch.setattr(windows, "STRETCH_ROWS", stretch)
    values = [(None if k == 3 else k // 2, k, (k * 37) % 11) for k in range(60)]
    frame = spark.createDataFrame(values[::-1], "a int, b int, n int").repartition(6)
    found = windows.moving_average(frame, ["a", "b"], "n", 4, "avg", 3)
    got = found.collect()
    assert len(got) == 60 and (stretch >= 60 or "SinglePartition" not in plan(found))
    series = [values[3], *values[:3], *values[4:]]  # NULLs first
    last = [[n for _, _, n in series[max(0, i - 3) : i + 1]] for i in range(60)]
    want = {b: sum(w) / len(w) for (_, b, _), w in zip(series, last)}
    assert {r["b"]: r["avg"] for r in got} == pytest.approx(want, abs=1e-3)


def test_effectiveness(spark, rows):
    frame = spark.createDataFrame([(1, 30.5, 1), (1, 20.0, 2), (2, 10.0, 1)], "y int, rate double, rank int")
    assert rows(windows.effectiveness(frame, "rate", "rank", ["y"], "score")) == [
        (1, 20.0, 2, -80.0), (1, 30.5, 1, -19.5), (2, 10.0, 1, -90.0),
    ]
