import pytest
from pyspark.sql import functions as F

from inciscope import config
from inciscope.bindings import raw as raw_binding
from inciscope.plans.gold import build_gold
from inciscope.plans.segments import segment
from inciscope.plans.silver import build_silver
from inciscope.session import materialise, scratch, scratch_path, scratch_root
from inciscope.sources import csv, logs, tables

SF = "/root/testdata/sf0.001"
HEADERS = {"ID": "id", "Primary Type": "primary_type"}


def write_text(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_matched_by_name_and_bad_rows_kept(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", "Primary Type,Extra,ID", "THEFT,x,1", '"A, B",y,2', "short", "ARSON,,3,tail", ",,")
    landed = csv.land_csv(spark, path, HEADERS, "bronze.incidents")
    found = {(r["id"], r["primary_type"]): r for r in landed.collect()}
    assert set(found) == {("1", "THEFT"), ("2", "A, B"), (None, "short"), ("3", "ARSON"), (None, None)}
    assert found[("3", "ARSON")]["_corrupt_record"] == "ARSON,,3,tail"
    row = found[("1", "THEFT")]
    assert row["_source_file"] == "a.csv" and row["_source_path"].endswith("/a.csv")
    assert row["_bronze_table"] == "bronze.incidents" and row["_ingest_ts"] is not None


def test_missing_columns_are_an_error(spark, tmp_path):
    path = write_text(tmp_path / "b.csv", "ID,Other", "1,2")
    with pytest.raises(ValueError, match="Primary Type"):
        csv.read_raw_csv(spark, path, list(HEADERS))


def test_one_failing_file_does_not_stop_the_others_and_reruns_add_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = [
        csv.FileSpec(write_text(tmp_path / f"{n}.csv", "ID,Primary Type", *[f"{n}{i},THEFT" for i in range(n)]), "bronze/incidents", HEADERS)
        for n in (2, 3)
    ]
    absent = csv.FileSpec(str(tmp_path / "absent.csv"), "bronze/incidents", HEADERS)
    wrong = csv.FileSpec(write_text(tmp_path / "wrong.csv", "X,Y", "1,2"), "bronze/incidents", HEADERS)
    broken = csv.FileSpec(write_text(tmp_path / "broken.csv.gz", "not compressed"), "bronze/incidents", HEADERS)
    report = csv.ingest_files(spark, [good[0], absent, wrong, broken, good[1]], root, "r1")
    assert report.status == "PARTIAL_SUCCESS" and report.rows_processed == 5
    assert [o.status for o in report.outcomes] == ["SUCCESS", "FAILED", "FAILED", "FAILED", "SUCCESS"]
    assert all(o.error for o in report.outcomes[1:4])

    again = csv.ingest_files(spark, good, root, "r2")
    assert again.status == "SUCCESS" and [o.status for o in again.outcomes] == ["SKIPPED", "SKIPPED"]
    assert tables.read_table(spark, f"{root}/bronze/incidents").count() == 5

    log = tables.read_table(spark, f"{root}/{logs.RUN_LOG}")
    assert log.count() == 4  # RUNNING and a closing row per run
    latest = {r["run_id"]: r for r in logs.latest_status(log).collect()}
    assert (latest["r1"]["status"], latest["r2"]["status"]) == ("PARTIAL_SUCCESS", "SUCCESS")
    assert latest["r1"]["error_message"] == "3 file(s) failed to load" and latest["r1"]["run_by"]
    logs.log_run(spark, root, "r3", "bronze_bulk_ingest", "BRONZE", "RUNNING")
    history = {r["run_id"]: r for r in logs.run_history(tables.read_table(spark, f"{root}/{logs.RUN_LOG}")).collect()}
    assert history["r1"]["status"] == "PARTIAL_SUCCESS" and history["r1"]["end_ts"] > history["r1"]["start_ts"]
    assert history["r1"]["rows_processed"] == 5
    assert history["r3"]["status"] == "RUNNING" and history["r3"]["end_ts"] is None
    files = tables.read_table(spark, f"{root}/{logs.FILE_LOG}").filter("run_id = 'r1'")
    assert {r["source_file_name"]: r["row_count"] for r in files.collect()} == {
        "2.csv": 2, "3.csv": 3, "absent.csv": 0, "wrong.csv": 0, "broken.csv.gz": 0,
    }


def test_files_of_one_name_changed_files_and_second_targets_all_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    for folder in "ab":
        (tmp_path / folder).mkdir()
    first = write_text(tmp_path / "a" / "x.csv", "ID,Primary Type", "1,THEFT", "2,THEFT")
    second = write_text(tmp_path / "b" / "x.csv", "ID,Primary Type", "3,ARSON")
    specs = [csv.FileSpec(p, "bronze/one", HEADERS) for p in (first, second)]

    def ids(target):
        return sorted(r["id"] for r in tables.read_table(spark, f"{root}/bronze/{target}").collect())

    assert csv.ingest_files(spark, specs, root, "r1").rows_processed == 3
    assert ids("one") == ["1", "2", "3"]
    report = csv.ingest_files(spark, [csv.FileSpec(first, "bronze/two", HEADERS), *specs], root, "r2")
    assert [o.status for o in report.outcomes] == ["SUCCESS", "SKIPPED", "SKIPPED"] and ids("two") == ["1", "2"]
    write_text(tmp_path / "a" / "x.csv", "ID,Primary Type", "1,THEFT", "2,THEFT", "4,THEFT")
    report = csv.ingest_files(spark, specs, root, "r3")
    assert [(o.status, o.row_count) for o in report.outcomes] == [("SUCCESS", 3), ("SKIPPED", 0)]
    assert ids("one") == ["1", "2", "3", "4"]
    write_text(tmp_path / "b" / "x.csv", "ID,Primary Type")
    assert csv.ingest_files(spark, specs, root, "r4").outcomes[1].status == "SUCCESS" and ids("one") == ["1", "2", "4"]
    sizes = tables.read_table(spark, f"{root}/{logs.FILE_LOG}").filter("status <> 'FAILED'")
    assert sizes.filter("file_size_bytes IS NULL OR file_modified_ts IS NULL").count() == 0


def test_a_failed_run_is_logged_as_failed(spark, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(Exception):
        build_gold(spark, root, "g1")
    history = logs.run_history(tables.read_table(spark, f"{root}/{logs.RUN_LOG}")).first()
    assert history["status"] == "FAILED" and history["error_message"] and history["end_ts"] is not None


def test_writes_report_their_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(i, i % 2) for i in range(10)], "v int, p int")
    assert tables.write_table(frame, path, partition_by=["p"]) == 10
    assert tables.write_table(frame.limit(3), path, partition_by=["p"]) == 3
    assert tables.read_table(spark, path).count() == 13
    assert tables.replace_table(frame.filter("p = 0"), path, ["p"]) == 5
    assert tables.replace_partitions(frame.filter("p = 1").limit(2), path, ["p"]) == 2
    assert tables.read_table(spark, path).count() == 7
    audit = tables.write_audited(frame, lambda d: d.filter("v < 4"), str(tmp_path / "u"), "STEP")
    assert (audit.target_table, audit.rows_in, audit.rows_out, audit.rows_dropped) == ("u", 10, 4, 6)


def test_empty_writes_report_zero(spark, tmp_path):
    empty = spark.createDataFrame([], "v int, p int")
    assert tables.write_table(empty, str(tmp_path / "a")) == 0
    assert tables.write_table(spark.range(5).filter("id > 9"), str(tmp_path / "b")) == 0
    assert tables.write_table(spark.range(5).filter("false"), str(tmp_path / "c")) == 0
    audit = tables.write_audited(spark.range(5), lambda d: d.filter("false"), str(tmp_path / "d"), "STEP")
    assert (audit.rows_in, audit.rows_out) == (5, 0)


def test_scratch_follows_the_session_setting(spark, rows):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    frame = spark.range(5).withColumn("v", F.col("id") * 2)
    stored = materialise(frame, "five")
    assert rows(stored) == rows(frame) and stored.schema.names == frame.schema.names


def test_export_keeps_padding(spark, tmp_path, rows):
    frame = spark.createDataFrame([(" a ", 1), ("b, c", 2), (None, 3)], "t string, n int")
    csv.export_csv(frame, str(tmp_path / "out"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "out"))) == [(None, "3"), (" a ", "1"), ("b, c", "2")]


def test_csv_files_to_segments(spark, tmp_path):
    """Files in, typed and conformed records, star schema, views and clusters out; counts reconcile."""
    root = str(tmp_path / "lake")
    back = {landed: header for header, landed in config.INCIDENT_HEADERS.items()}
    raw = raw_binding.raw(spark, SF)
    specs = []
    for tag, name in raw_binding.SOURCES.items():
        path = f"{tmp_path}/{name}"
        rows_of = raw.filter(F.col("_source_file") == name).select(*raw_binding.TEXT_COLUMNS)
        csv.export_csv(rows_of.withColumnsRenamed(back), path)
        specs.append(csv.FileSpec(path, f"bronze/incidents_{tag}", config.INCIDENT_HEADERS))
    boundaries = {
        "bronze/districts": (raw_binding.districts_raw(spark, SF), config.DISTRICT_HEADERS),
        "bronze/wards": (raw_binding.wards_raw(spark, SF), config.WARD_HEADERS),
        "bronze/areas": (raw_binding.areas_raw(spark, SF), config.AREA_HEADERS),
    }
    for target, (frame, headers) in boundaries.items():
        path = f"{tmp_path}/{target.rsplit('/')[-1]}.csv"
        csv.export_csv(frame.withColumnsRenamed({v: k for k, v in headers.items()}), path)
        specs.append(csv.FileSpec(path, target, headers))
    report = csv.ingest_files(spark, specs, root, "bronze-1")
    assert report.status == "SUCCESS"
    assert sum(o.row_count for o in report.outcomes[:2]) == raw.count()

    landings = {tag: f"{root}/bronze/incidents_{tag}" for tag in raw_binding.SOURCES}
    dims = tuple(f"{root}/{target}" for target in boundaries)
    summary = {r["reason_code"]: r["failed_records"] for r in build_silver(spark, root, landings, dims, "silver-1").collect()}
    steps = {r["target_table"]: r for r in tables.read_table(spark, f"{root}/{logs.STEP_LOG}").collect()}
    typed = tables.read_table(spark, f"{root}/silver/crimes_typed")
    conformed = tables.read_table(spark, f"{root}/silver/crimes_conformed")
    assert steps["crimes_typed"]["rows_in"] == raw.count()
    assert steps["crimes_typed"]["rows_out"] == typed.count() == raw_binding.typed(spark, SF).count()
    assert steps["crimes_conformed"]["rows_out"] == conformed.count() == raw_binding.latest(spark, SF).count()
    assert conformed.select("crime_id").distinct().count() == conformed.count()
    assert summary["NULL_WARD"] == typed.filter("ward is null").count()
    assert "NULL_CRIME_ID" not in summary

    published = build_gold(spark, root, "gold-1")
    assert published["fact_crimes"].count() == conformed.count()
    features = published["ml_community_features"]
    audit = {r["target_table"]: r["rows_out"] for r in tables.read_table(spark, f"{root}/{logs.PUBLICATION_LOG}").collect()}
    assert len(audit) == 19
    assert audit["ml_community_features"] == features.count() == published["v_geo_community_profile"].count()
    assert published["v_temporal_monthly_trend"].agg(F.sum("total_crimes")).first()[0] == conformed.count()

    made = segment(features, "community_area_num", k=3, n_init=2)
    assert made.labelled.count() == features.count()
    assert made.profiles.agg(F.sum("size")).first()[0] == features.count()


def test_scratch_folders_are_released_and_shared(spark, monkeypatch):
    with scratch(spark):
        path = scratch_path(spark, "made")
        spark.range(3).write.parquet(path)
        stored = materialise(spark.range(2), "kept")
        assert stored.count() == 2 and spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    class Conf:
        def get(self, key, default=None):
            return "file:/home/x/warehouse" if key == "spark.sql.warehouse.dir" else default

    class Elsewhere:
        conf = Conf()

        class sparkContext:
            _jvm, _jsc, master = spark.sparkContext._jvm, spark.sparkContext._jsc, "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Elsewhere())
    Elsewhere.sparkContext.master = "local[4]"
    assert scratch_root(Elsewhere()) == "file:/home/x/warehouse/scratch"


def test_landed_files_do_not_follow_the_scan_splits(spark, tmp_path):
    """A text scanned in many small splits lands in no more files than there are cores."""
    from inciscope.sources.csv import FileSpec, ingest_files
    from inciscope.sources.tables import read_table

    text = tmp_path / "in.csv"
    text.write_text("a\n" + "".join(f"{i}\n" for i in range(40_000)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "4k")
        ingest_files(spark, [FileSpec(str(text), "bronze/many", {"a": "a"})], str(tmp_path / "lake"), "many-1")
        landed = read_table(spark, f"{tmp_path}/lake/bronze/many")
        assert len(landed.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert landed.count() == 40_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_packed_export_holds_the_same_rows_in_small_files_of_bounded_rows(spark, tmp_path, rows, monkeypatch):
    """Spaces, quotes, empty and missing text come back as from plain files; a file that only one task reads is bounded."""
    monkeypatch.setattr(csv, "PACKED_ROWS", 400)
    frame = spark.range(1000).select(
        F.concat(F.lit(" a, "), F.col("id").cast("string"), F.lit('" ')).alias("t"),
        F.when(F.col("id") % 3 > 0, F.lit("street")).alias("place"), F.lit("").alias("empty"),
    )
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    csv.export_csv(frame.coalesce(1), plain)
    csv.export_csv(frame.coalesce(1), packed, packed=True)
    headers = {c: c for c in frame.columns}
    read = {p: csv.land_csv(spark, p, headers, "bronze/x") for p in (plain, packed)}
    assert rows(read[packed].select(*headers)) == rows(read[plain].select(*headers)) and read[packed].count() == 1000
    files = [r["n"] for r in read[packed].groupBy("_source_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sorted(files) == [200, 400, 400]
    assert csv.file_version(spark, packed)[0] < csv.file_version(spark, plain)[0] / 2


def test_text_of_the_whole_runs_is_packed(spark, tmp_path, monkeypatch):
    """The runs write their records as text once or twice; as plain text these would be most of their disk."""
    from inciscope.bindings import runs

    items = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    made = spark.range(50).selectExpr("id", "id % 7 as p", "id % 3 as s", "int(id % 4)", "'R'", "'O'", "timestamp '1996-03-04'")
    made.toDF(*[c.split()[0] for c in items.split(", ")]).write.parquet(str(tmp_path / "lineitem.parquet"))
    runs._export(spark, str(tmp_path), [runs.ONE], str(tmp_path / "out"))
    written = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert written and all(name.endswith(".csv.gz") for name in written)
    assert csv.read_raw_csv(spark, str(tmp_path / "out"), list(config.INCIDENT_HEADERS)).count() == 50


def test_landed_text_goes_and_the_dedup_moves_only_what_the_conformed_records_need(spark, tmp_path, monkeypatch):
    """What is typed but not conformed is neither sorted nor moved; ties are still settled by all columns before it."""
    from inciscope.bindings import runs
    from inciscope.plans import silver

    moved, given = [], silver.latest_incidents

    def watched(typed, order_by, *rest):
        moved.append(typed.columns)
        return given(typed, order_by, *rest)

    monkeypatch.setattr(silver, "latest_incidents", watched)
    items = "l_orderkey l_partkey l_suppkey l_linenumber l_returnflag l_linestatus l_shipdate"
    twice = spark.range(120).selectExpr("id % 60", "5 + id % 60 + 60 * int(id / 60)", "id % 3", "int(1)", "'R'", "'O'", "timestamp '1996-03-04'")
    twice.toDF(*items.split()).withColumns({c: F.col(c).cast("bigint") for c in items.split()[:3]}).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name, key in (("nation", "n_nationkey bigint, n_name string"), ("region", "r_regionkey bigint, r_name string"),
                      ("supplier", "s_suppkey bigint"), ("customer", "c_custkey bigint")):
        one = [(1, "One")] if "name" in key else [(1,)]
        spark.createDataFrame(one, key).write.parquet(str(tmp_path / f"{name}.parquet"))
    with scratch(spark):
        root, _ = runs._silver(spark, str(tmp_path))
        assert len(moved) == 1 and not {"_raw_date", "_silver_step", "_transform_ts"} & set(moved[0])
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.text(f"{root}/in")
        typed = tables.read_table(spark, f"{root}/silver/crimes_typed")
        conformed = tables.read_table(spark, f"{root}/silver/crimes_conformed")
        whole = given(typed, [F.desc("_ingest_ts"), F.desc("source_year_range")])
        assert typed.count() > whole.count() > 0
        columns = ["crime_id", "block", "iucr", "primary_type", "incident_datetime", "lat_final", "lon_final", "coord_source"]
        assert sorted(map(str, conformed.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
