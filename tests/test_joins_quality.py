import datetime as dt

from pyspark.sql import functions as F

from inciscope.operators import joins, profiling, quality
from inciscope.operators.typing import clean_dim, recover_coordinates, to_typed

RAW = (
    "id string, case_number string, date string, block string, iucr string, primary_type string, description string,"
    " location_description string, arrest string, domestic string, beat string, district string, ward string,"
    " community_area string, fbi_code string, x_coordinate string, y_coordinate string, year string, updated_on string,"
    " latitude string, longitude string, location string, _source_file string"
)


def raw_row(**changes):
    base = dict(
        id="7", case_number=" C7 ", date="01/02/2003 11:04:05 PM", block=" main st", iucr="0110", primary_type=" theft ",
        description="x", location_description="street", arrest="TRUE", domestic="false", beat="0111", district="4.0",
        ward="1.0", community_area="25.0", fbi_code="06", x_coordinate=None, y_coordinate=None, year="2003",
        updated_on=None, latitude="41.5", longitude="-87.5", location="(41.5, -87.5)", _source_file="f_2001_to_2004.csv",
    )
    return tuple({**base, **changes}.values())


def test_left_joins_keep_every_row(spark, rows):
    facts = spark.createDataFrame([(1, "4"), (2, "13"), (3, None), (4, "x")], "id int, district string")
    dim = spark.createDataFrame([(4, "FOURTH"), (5, "FIFTH")], "num int, label string")
    spec = joins.DimSpec(dim, "num", F.col("district").try_cast("int"), {"label": "district_name"})
    assert rows(joins.conform(facts, [spec])) == [(1, "4", "FOURTH"), (2, "13", None), (3, None, None), (4, "x", None)]
    flagged = joins.with_known_flag(facts, F.col("district").try_cast("int"), dim, "num", "known")
    assert [r[2] for r in rows(flagged)] == [True, False, False, False]


def test_existence_and_lookup(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(2, "b"), (2, "a"), (3, "c")], "k int, v string")
    assert rows(joins.exists_in(left, right, ["k"])) == [(2,), (2,)]
    assert rows(joins.not_exists_in(left, right, ["k"])) == [(1,)]
    assert rows(joins.lookup_first(left, right, ["k"], "v", "first")) == [(1, None), (2, "a"), (2, "a")]


def test_key_validation(spark, rows):
    facts = spark.createDataFrame([("1.0", "9"), ("2.0", "9"), (None, "8"), ("2.0", "7")], "d string, w string")
    first = spark.createDataFrame([(1,)], "n int")
    second = spark.createDataFrame([(9,)], "n int")
    code = lambda c: F.col(c).try_cast("double").try_cast("int")
    specs = {"d_missing": joins.DimSpec(first, "n", code("d")), "w_missing": joins.DimSpec(second, "n", code("w"))}
    assert tuple(joins.join_key_validation(facts, specs).first()) == (1, 2)
    assert rows(joins.unmatched_keys(facts, code("d"), first, "n", "d", "n_rows")) == [(2, 2)]


def test_typed_record(spark):
    frame = spark.createDataFrame([raw_row()], RAW)
    row = to_typed(frame).first()
    assert row["crime_id"] == 7 and row["case_number"] == "C7" and row["primary_type"] == "THEFT"
    assert row["incident_datetime"] == dt.datetime(2003, 1, 2, 23, 4, 5)
    assert [row[f"incident_{p}"] for p in ("year", "month", "day", "hour", "dayofweek")] == [2003, 1, 2, 23, 5]
    assert (row["is_arrest"], row["is_domestic"]) == (True, False)
    assert (row["district"], row["ward"], row["community_area"]) == ("4", 1, 25)
    assert (row["coord_source"], row["source_year_range"]) == ("DIRECT", "2001_2004")


def test_coordinate_sources(spark):
    data = [("41.0", "-87.0", None), (None, None, "(41.2, -87.2)"), (None, "-87.0", None), ("", " ", "no"), ("x", "-8", "(4, 5)")]
    frame = spark.createDataFrame(data, "lat string, lon string, loc string")
    found = recover_coordinates(frame, "lat", "lon", "loc").select("lat_final", "lon_final", "coord_source").collect()
    assert [tuple(r) for r in found] == [
        (41.0, -87.0, "DIRECT"), (41.2, -87.2, "RECOVERED_FROM_STR"), (None, -87.0, "NULL"), (None, None, "NULL"),
        (4.0, -8.0, "RECOVERED_FROM_STR"),
    ]


def test_clean_dim_drops_bad_keys_and_geometry(spark, rows):
    frame = spark.createDataFrame([("G", " 1 ", "2.5"), ("G", "WARD", "1"), ("G", None, "1"), ("G", "", "x")], "g string, ward string, area string")
    cleaned = clean_dim(frame, "ward", "ward_num", {"label": F.concat(F.lit("Ward "), F.trim("ward"))}, {"area": "area"})
    assert rows(cleaned) == [(1, "Ward 1", 2.5)]


def test_every_gate_fires_in_one_scan(spark, plan, tmp_path):
    changes = [
        dict(id=None), dict(date=" "), dict(date="soon"), dict(date="01/01/2100 01:00:00 AM"), dict(date="1/1/1999 1:00"),
        dict(primary_type=" "), dict(primary_type="iucr"), dict(arrest="maybe"), dict(community_area=None),
        dict(community_area="0"), dict(district=None), dict(district="13.0"), dict(ward=""),
        dict(latitude=None, longitude=None, location=None), dict(),
    ]
    frame = spark.createDataFrame([raw_row(**{"id": str(i), **c}) for i, c in enumerate(changes)], RAW)
    frame.write.parquet(str(tmp_path / "raw"))
    districts = spark.createDataFrame([(4,)], "district_num int")
    now = F.lit("2020-01-01").cast("timestamp")
    failures = quality.incident_failures(
        to_typed(spark.read.parquet(str(tmp_path / "raw"))), districts, quality.incident_gates(now)
    )
    found = {(r["record_id"], r["reason_code"], r["raw_value"]) for r in failures.collect()}
    assert found == {
        ("C7", "NULL_CRIME_ID", None), ("1", "NULL_DATE", None), ("2", "UNPARSEABLE_DATE", "soon"),
        ("3", "FUTURE_DATE", "2100-01-01 01:00:00"), ("3", "INVALID_YEAR", "2100"), ("4", "INVALID_YEAR", "1999"),
        ("5", "NULL_PRIMARY_TYPE", None), ("6", "INVALID_PRIMARY_TYPE", "IUCR"), ("7", "NULL_ARREST_FLAG", None),
        ("8", "NULL_COMMUNITY_AREA", None), ("9", "COMMUNITY_AREA_ZERO", "0"), ("10", "NULL_DISTRICT", None),
        ("11", "UNMATCHED_DISTRICT", "13"), ("12", "NULL_WARD", None), ("13", "NO_COORDINATES", None),
    }
    assert plan(failures).count("FileScan") == 1
    summary = {r["reason_code"]: (r["failed_records"], r["pct_of_total"]) for r in quality.gate_summary(failures, 15).collect()}
    assert summary["INVALID_YEAR"] == (2, 13.3333)


def test_profiles(spark, rows):
    frame = spark.createDataFrame(
        [("1", "a", "f1"), ("1", "a", "f2"), ("2", " ", "f1"), (None, None, "f1"), ("3", "b", "f1"), ("3", "b", "f1")],
        "id string, v string, src string",
    )
    assert tuple(profiling.null_profile(frame, ["id", "v"]).first()) == (6, 1, 2)
    assert rows(profiling.null_profile(frame, ["v"], ["src"])) == [("f1", 5, 2), ("f2", 1, 0)]
    assert rows(profiling.missing_counts(frame, ["id", "v", "src"])) == [("id", 1), ("v", 1)]
    assert rows(profiling.duplicate_summary(frame, "id", "src")) == [("f1", 5, 3, 2, 1), ("f2", 1, 1, 0, 0)]
    assert rows(profiling.duplicate_histogram(frame, "id", "src")) == [(1, 1, "3"), (2, 1, "1")]
    assert rows(profiling.duplicate_rows(frame, "id", 1)) == [("1", "a", "f1"), ("1", "a", "f2")]
    ordered = spark.createDataFrame([("10",), ("9",), ("x",)], "v string")
    assert [r[0] for r in profiling.numeric_order(ordered, "v").collect()] == ["x", "9", "10"]
