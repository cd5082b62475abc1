import datetime as dt

import pytest
from pyspark.sql import functions as F

from inciscope import config, session
from inciscope.bindings import raw
from inciscope.bindings import star as star_bindings
from inciscope.operators import dims, features, shaping, views, windows
from inciscope.plans import gold, silver

SMOKE_DIR = "/root/testdata/sf0.001"

CONFORMED = (
    "crime_id long, case_number string, incident_datetime timestamp, incident_year int, incident_month int,"
    " incident_hour int, incident_dayofweek int, primary_type string, fbi_code string, location_description string,"
    " is_arrest boolean, is_domestic boolean, beat string, district_code string, district_name string, ward_num int,"
    " ward_label string, community_area_num int, community_name string, lat_final double, lon_final double,"
    " source_year_range string, _source_file string"
)


def record(i, ts, kind="THEFT", code="06", place="STREET", arrest=True, domestic=False, district=4, ward=1, area=25):
    when = dt.datetime.fromisoformat(ts)
    name = None if district is None else f"D{district}"
    return (
        i, f"C{i}", when, when.year, when.month, when.hour, when.isoweekday() % 7 + 1, kind, code, place, arrest, domestic,
        "0111", None if district is None else str(district), name, ward, None if ward is None else f"Ward {ward}", area,
        None if area is None else f"A{area}", None, None, "x", "f.csv",
    )


@pytest.fixture(scope="module")
def built(spark):
    data = [
        record(1, "2016-01-01 01:00"), record(2, "2016-01-01 13:00", "ROBBERY", "03", arrest=False),
        record(3, "2016-02-10 13:00", "ROBBERY", "03", place=None), record(4, "2017-01-07 23:00", place="MOON", ward=2),
        record(5, "2017-01-08 23:00", domestic=True, ward=None), record(6, "2017-03-08 06:00", area=None, domestic=None),
        record(7, "2017-03-08 14:00", "GAMBLING", "77", district=None, arrest=None), record(8, "2014-03-08 22:00", place=" "),
    ]
    frame = spark.createDataFrame(data, CONFORMED)
    made = gold.star(frame)
    return gold.Star(**{**vars(made), "fact": made.fact.persist()})


def test_dates_have_date_grain(built):
    days = built.dim_date.orderBy("date_key").collect()
    assert [r["date_key"] for r in days] == [20140308, 20160101, 20160210, 20170107, 20170108, 20170308]
    first = days[1].asDict()
    assert (first["month_name"], first["quarter"], first["day_name"], first["day_of_week_num"]) == ("January", "Q1", "Friday", 6)
    assert [r["weekday_type"] for r in days] == ["Weekend", "Weekday", "Weekday", "Weekend", "Weekend", "Weekday"]


def test_types_and_places(built):
    kinds = {r["primary_type"]: r.asDict() for r in built.dim_crime_type.collect()}
    assert {k: v["crime_type_key"] for k, v in kinds.items()} == {"GAMBLING": 1, "ROBBERY": 2, "THEFT": 3}
    assert kinds["ROBBERY"]["fbi_description"] == "Robbery" and kinds["GAMBLING"]["fbi_description"] == "FBI Code 77"
    assert [kinds[k]["crime_category"] for k in sorted(kinds)] == ["OTHER", "VIOLENT", "PROPERTY"]
    places = {r["location_description"]: r["location_category"] for r in built.dim_location_type.collect()}
    assert places == {"STREET": "OUTDOOR / TRANSPORT", "MOON": "OTHER"}


def test_shifts(built):
    shifts = {r["hour_of_day"]: r["shift_type"] for r in built.dim_shift.collect()}
    assert len(shifts) == 24
    assert [shifts[h] for h in (0, 5, 6, 13, 14, 21, 22)] == ["NIGHT", "NIGHT", "DAY", "DAY", "EVENING", "EVENING", "NIGHT"]


def test_fact_neither_multiplies_nor_loses_places(built):
    fact = {r["crime_id"]: r.asDict() for r in built.fact.collect()}
    assert sorted(fact) == list(range(1, 9))
    assert dims.duplicate_keys(built.dim_location, dims.LOCATION_KEY).isEmpty()
    assert fact[6]["location_key"] is not None  # NULL area
    assert fact[5]["location_key"] is not None  # NULL ward
    assert fact[7]["location_key"] is None  # no district
    assert fact[1]["location_key"] == fact[2]["location_key"] != fact[4]["location_key"]
    assert fact[1]["date_key"] == 20160101 and fact[1]["shift_key"] == 1
    assert fact[8]["location_type_key"] is None


def test_monthly_trend_counts_each_record_once(built):
    months = views.monthly_trend(built.fact, built.dim_date).orderBy("incident_year", "incident_month").collect()
    assert sum(r["total_crimes"] for r in months) == 8
    assert [(r["month_name"], r["total_crimes"], r["rolling_3m_avg"]) for r in months] == [
        ("March", 1, 1.0), ("January", 2, 2.0), ("February", 1, 1.0), ("January", 2, 2.0), ("March", 2, 2.0),
    ]


def test_yoy_and_gaps(built):
    changes = {r["incident_year"]: r.asDict() for r in views.yoy_change(built.fact).collect()}
    assert changes[2014]["prev_year_crimes"] is None and changes[2014]["trend_direction"] == "STABLE"
    assert changes[2016]["prev_year_crimes"] is None  # 2015 is missing
    assert changes[2017]["yoy_change_abs"] == 0 and changes[2017]["yoy_change_pct"] == 0.0


def test_profile_modes_and_change(built):
    profile = views.entity_profile(built.fact, (2016, 2017)).first().asDict()
    assert profile["community_name"] == "A25" and profile["total_crimes"] == 7
    assert profile["peak_crime_hour"] == 13 and profile["dominant_crime_type"] == "THEFT"
    assert (profile["crimes_2016"], profile["crimes_2017"], profile["yoy_pct_2017_vs_2016"]) == (3, 3, 0.0)
    assert (profile["violent_crimes"], profile["property_crimes"]) == (2, 4)


def test_modes_ignore_null_and_break_ties_low(spark, rows):
    cells = spark.createDataFrame(
        [("g", 3, "b", 2), ("g", 1, "a", 2), ("g", 2, None, 9), ("h", 5, None, 1)], "g string, hour int, kind string, n long"
    )
    rolled = views.roll_up_modes(cells, ["g"], "n", {"kind_mode": "kind", "hour_mode": "hour"}, ["n"])
    assert rows(rolled) == [("g", 13, "a", 2), ("h", 1, None, 5)]


def test_flag_analysis_with_unknown_flags(built):
    row = views.flag_analysis(built.fact).filter("incident_year = 2017 and district_name = 'D4'").first().asDict()
    assert (row["total_crimes"], row["domestic_count"], row["non_domestic_count"]) == (2, 1, 1)
    assert (row["domestic_pct"], row["domestic_arrest_rate_pct"], row["domestic_rate_rank"]) == (50.0, 100.0, 1)


def test_kpis(built):
    row = views.kpi_summary(built.fact).first().asDict()
    assert (row["total_crimes"], row["years_covered"], row["first_year"], row["last_year"]) == (8, 3, 2014, 2017)
    assert (row["communities_with_crime"], row["districts_covered"]) == (1, 1)
    assert (row["most_common_crime"], row["most_common_location_type"]) == ("THEFT", "STREET")


def test_feature_flags(spark):
    profile = spark.createDataFrame(
        [(i, f"A{i}", 10 * i, 50.0 - i, 1.0, float(i), i, i, 5, 3.0) for i in range(1, 6)] + [(None, "none", 1000, 0.0, 1.0, 9.0, 9, 9, 5, 3.0)],
        "community_area_num int, community_name string, total_crimes long, arrest_rate_pct double, domestic_pct double,"
        " violent_pct double, violent_crimes long, property_crimes long, peak_crime_hour int, change double",
    )
    made = {r["community_area_num"]: r.asDict() for r in features.entity_features(profile, 4, "change").collect()}
    assert sorted(made) == [1, 2, 3, 4, 5]
    assert [made[i]["is_high_volume_area"] for i in range(1, 6)] == [False, False, False, True, True]
    assert [made[i]["is_low_arrest_area"] for i in range(1, 6)] == [False, False, False, True, True]
    assert [made[i]["is_high_violent_area"] for i in range(1, 6)] == [False, False, False, False, True]
    assert made[1]["avg_crimes_per_year"] == 3.0 and made[1]["violent_share_pct"] == 10.0


def test_views_shuffle_counts_not_records(spark, plan, tmp_path):
    spark.range(1000).select(
        (F.col("id") % 3 + 20160101).cast("int").alias("date_key"), (F.col("id") % 24).cast("int").alias("shift_key"),
        (F.col("id") % 24).cast("int").alias("incident_hour"), (F.col("id") % 2 == 0).alias("is_arrest"),
        F.lit(True).alias("is_domestic"), F.lit(False).alias("is_violent"),
    ).write.parquet(str(tmp_path / "fact"))
    text = plan(views.shift_analysis(spark.read.parquet(str(tmp_path / "fact")), dims.build_dim_shift(spark)))
    fact_side = text.split("FileScan")[0].splitlines()
    below_exchange = fact_side[max(i for i, line in enumerate(fact_side) if "Exchange" in line) + 1]
    assert "HashAggregate" in below_exchange and "partial_count" in below_exchange


def test_views_with_one_group_holding_a_third_of_the_rows(spark):
    n = 60_000
    frame = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("int").alias("community_area_num"),
        (F.xxhash64("id") % 12).alias("h"),
        (F.col("id") % 4 + 2014).cast("int").alias("incident_year"),
    ).select(
        "community_area_num",
        F.concat(F.lit("A"), F.col("community_area_num").cast("string")).alias("community_name"),
        F.col("community_area_num").cast("string").alias("district_code"),
        F.concat(F.lit("D"), F.col("community_area_num").cast("string")).alias("district_name"),
        (F.abs("h") % 24).cast("int").alias("incident_hour"),
        F.concat(F.lit("T"), (F.abs("h") % 5).cast("string")).alias("primary_type"),
        F.when(F.col("h") == 0, None).otherwise(F.col("h") > 0).alias("is_arrest"),
        (F.col("h") % 2 == 0).alias("is_domestic"),
        (F.col("h") == 3).alias("is_violent"),
        F.when(F.col("h") > 5, "PROPERTY").otherwise("OTHER").alias("crime_category"),
        "incident_year",
    )
    data = frame.toPandas()
    profile = views.entity_profile(frame.repartition(7), (2016, 2017)).toPandas().set_index("community_name")
    for name, part in data.groupby("community_name"):
        row = profile.loc[name]
        assert row["total_crimes"] == len(part)
        assert row["total_arrests"] == (part["is_arrest"] == True).sum()  # noqa: E712
        assert row["peak_crime_hour"] == part["incident_hour"].mode().min()
        assert row["dominant_crime_type"] == part["primary_type"].mode().min()
        assert row["crimes_2017"] == (part["incident_year"] == 2017).sum()
    assert profile["total_crimes"].sum() == n and profile.loc["A1", "total_crimes"] == n // 3
    ranked = views.group_performance(frame).toPandas()
    assert set(ranked.loc[ranked["district_name"] == "D1", "crime_volume_rank"]) == {1}
    assert ranked["total_crimes"].sum() == n


def test_first_list_decides_for_overlapping_codes():
    assert len(config.OFFENCE_CODES) == 24
    assert "ROBBERY" in config.CATEGORY_RULES[0][1] and "ROBBERY" in config.CATEGORY_RULES[1][1]


def test_latest_incidents_moves_no_derived_columns(spark):
    """What follows from other columns is worked out after the shuffle, and is as it was typed."""
    typed = raw.typed(spark, SMOKE_DIR)
    newest = [F.desc("_ingest_seq"), F.desc("source_year_range")]
    found = silver.latest_incidents(typed, newest)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window [") :].splitlines()[0]
    assert not any(name in window for name in ("incident_year", "lat_final", "coord_source"))
    plain = shaping.dedup_latest(typed.dropna(subset=["incident_datetime"]), ["crime_id"], newest)
    assert found.columns == plain.columns
    names = [c for c in plain.columns if c != "_transform_ts"]
    assert found.select(names).exceptAll(plain.select(names)).isEmpty() and found.count() == plain.count()


def test_surrogate_keys_work_their_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(500).mapInArrow(watched, "id bigint")
    keyed = windows.assign_surrogate_key(rows, ["id"], "key")
    assert keyed.filter("key = id + 1").count() == 500
    assert seen.value == 500


def test_raw_dimensions_and_views_store_no_fact(spark):
    begun = len(session._written)
    star_bindings.QUERIES["raw_dim_type"](spark, SMOKE_DIR)
    star_bindings.QUERIES["raw_kpi_summary"](spark, SMOKE_DIR)
    assert not any("/fact-" in path for path in session._written[begun:])


def test_latest_values_moves_only_what_is_asked_for(spark, rows, plan):
    """Ties of the order are still settled by all columns, nulls first, and the others are not moved."""
    data = [
        (1, 5, "b", "x", 1), (1, 5, "b", "w", 2), (1, 4, "a", "a", 3),  # a tie that a column not asked for settles
        (2, 1, "c", "x", 4), (2, 2, "d", "x", 5),  # no tie
        (3, None, "e", "x", 6), (3, None, None, "y", 7),  # a tie of nulls
        (4, 7, "f", "x", 8), (4, 7, "f", "x", 8),  # equal rows
        (5, 1, "g", "x", 9), (5, 1, "g", "x", 9), (5, 2, "h", "x", 10),  # a tie below the newest
        (None, 1, "i", "x", 11),
    ]
    frame = spark.createDataFrame(data, "id int, seq int, a string, b string, out int")
    newest = [F.desc("seq")]
    plain = shaping.dedup_latest(frame, ["id"], newest)
    assert rows(shaping.latest_values(frame, ["id"], newest, ["out"])) == rows(plain.select("out")) == [(10,), (2,), (5,), (7,), (8,)]
    assert rows(shaping.latest_values(frame, ["id"], newest, ["a", "id"])) == rows(plain.select("a", "id"))
    hot = spark.range(30_000).select(F.lit(1).alias("id"), F.lit(1).alias("seq"), (F.col("id") * 7 % 30_000).alias("a"))
    assert rows(shaping.latest_values(hot, ["id"], newest, ["a"])) == [(0,)]  # one key, all tied


def test_narrow_latest_incidents_are_those_of_whole_rows(spark, rows):
    names = ["incident_year", "primary_type", "lat_final", "coord_source", "district"]
    begun = len(session._written)
    found = raw.latest(spark, SMOKE_DIR, names)
    assert found.columns == names
    stored = [p for p in session._written[begun:] if "/latest-" in p]
    assert len(stored) == 1 and "block" not in spark.read.parquet(stored[0]).columns
    assert rows(found) == rows(raw.latest(spark, SMOKE_DIR).select(*names))


def test_ids_and_times_are_worked_out_once(spark, rows, plan):
    """Neither is worked out in a filter and again in the projection, and rows without either are still left out."""
    frame = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "text string, out string")
    once = shaping.computed_once(frame.withColumn("n", F.col("text").try_cast("int")), ["n"])
    assert once.columns == ["text", "out", "n"]
    assert rows(once.filter("n IS NOT NULL")) == [("1", "a", 1)]
    assert rows(once) == [(None, "c", None), ("1", "a", 1), ("x", "b", None)]
    found = plan(raw.latest(spark, SMOKE_DIR))
    assert found.count("gettimestamp") == 2  # one for each format
    assert found.count("as bigint) END") == 1


def test_tied_ids_are_met_before_the_columns_of_raw_records(spark, monkeypatch):
    seen = {}

    def watched(df, label):
        seen[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return session.materialise(df, label)

    monkeypatch.setattr(raw, "materialise", watched)
    items = spark.createDataFrame(
        [(1, 5, 3, 2, "R", "O", "1996-01-02"), (1, 5, 8, 2, "A", "F", "1996-01-02")],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate string",
    ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    monkeypatch.setattr(raw, "read", lambda *_: items)
    whole = raw.latest(spark, SMOKE_DIR).select("is_arrest", "crime_id").collect()
    assert raw.latest(spark, SMOKE_DIR, ["is_arrest", "crime_id"]).collect() == whole and len(whole) == 1
    assert "xx w Main st" not in seen["open"]
