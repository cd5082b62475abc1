"""Published table states: deletes, replacements, replays and writers that meet."""

import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from inciscope.session import SHUFFLE_CLEANUP, side_by_side
from inciscope.sources import csv, logs, tables

HEADERS = {"ID": "id", "Primary Type": "primary_type"}


@pytest.fixture
def table(spark, tmp_path):
    """Ids 0 to 29 in three files by part: text with letters that paths escape, and a null part."""
    path = str(tmp_path / "t")
    part = F.element_at(F.array(F.lit("a b/c%=1"), F.lit(None).cast("string"), F.lit("ü")), (F.col("id") % 3 + 1).cast("int"))
    frame = spark.range(30).select("id", F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"), part.alias("part"))
    assert tables.write_table(frame, path, ["part"]) == 30
    return path


def ids(spark, path):
    return sorted(r["id"] for r in tables.read_table(spark, path).collect())


def test_delete_rewrites_only_the_files_that_hold_rows(spark, table):
    before = set(tables._paths(spark, table, tables.state(spark, table)))
    found = tables.delete_rows(spark, table, (F.col("part") == "ü") & (F.col("v") > 10))
    gone = [i for i in range(30) if i % 3 == 2 and i % 5 and i > 10]
    assert (found.rows_in, found.rows_out, found.rows_dropped, found.files, found.files_rewritten) == (30, 30 - len(gone), len(gone), 3, 1)
    assert ids(spark, table) == [i for i in range(30) if i not in gone]
    assert {r["part"] for r in tables.read_table(spark, table).collect()} == {"a b/c%=1", None, "ü"}
    live = tables.state(spark, table).live
    assert sorted(len(e["dropped"]) for e in live.values()) == [0, 1] and len(before) == 1
    again = tables.delete_rows(spark, table, (F.col("part") == "ü") & (F.col("v") > 10))
    assert (again.rows_dropped, again.files_rewritten) == (0, 0)
    assert tables.delete_rows(spark, table, F.col("id") == 0).files_rewritten == 1
    assert tables.delete_rows(spark, table, F.col("id") >= 0).rows_out == 0
    assert ids(spark, table) == [] and tables.read_table(spark, table).columns == ["id", "v", "part"]
    assert tables.write_table(spark.range(3).selectExpr("id", "id AS v", "'x' AS part"), table, ["part"]) == 3
    assert ids(spark, table) == [0, 1, 2]


def test_interrupted_delete_leaves_the_old_rows(spark, table, monkeypatch):
    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_publish", broken)
        with pytest.raises(OSError):
            tables.delete_rows(spark, table, F.col("id") < 20)
    assert ids(spark, table) == list(range(30))
    assert tables.delete_rows(spark, table, F.col("id") < 20).rows_out == 10 and ids(spark, table) == list(range(20, 30))


def test_failing_replace_leaves_the_old_table(spark, table):
    bad = spark.range(1000).select("id", F.when(F.col("id") == 999, F.raise_error(F.lit("bad row"))).otherwise(F.lit(1)).alias("v"))
    with pytest.raises(Exception, match="bad row"):
        tables.replace_table(bad, table)
    assert ids(spark, table) == list(range(30))


def test_reader_that_began_before_a_replace_finishes(spark, table):
    reader = tables.read_table(spark, table)
    assert tables.replace_table(spark.range(100, 105).toDF("id"), table) == 5
    assert sorted(r["id"] for r in reader.collect()) == list(range(30))
    assert ids(spark, table) == list(range(100, 105)) and tables.read_table(spark, table).columns == ["id"]
    tables.replace_table(spark.range(7).toDF("id"), table)
    assert len(tables._manifests(spark, table)) == 2  # the newest state and the one before


def test_replayed_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (3, 4, 4):
        tables.write_table(spark.range(rows).toDF("id"), path, token="file-1")
    tables.write_table(spark.range(10, 12).toDF("id"), path, token="file-2")
    assert ids(spark, path) == [0, 1, 2, 3, 10, 11]
    extra = spark.range(20, 21).selectExpr("id", "'new' AS added")
    tables.write_table(extra, path)
    assert {(r["id"], r["added"]) for r in tables.read_table(spark, path).collect()} >= {(0, None), (20, "new")}


def test_writers_that_meet_both_succeed(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(0).toDF("id"), path)

    def write(k):
        if k % 4 == 3:
            tables.delete_rows(spark, path, F.col("id") == 1000 + k)
        return tables.write_table(spark.range(k, k + 1).toDF("id"), path)

    with ThreadPoolExecutor(6) as pool:
        assert sum(pool.map(write, range(12))) == 12
    assert ids(spark, path) == list(range(12))


def test_delete_starts_again_after_another_writer(spark, table, monkeypatch):
    publish, calls = tables._publish, []

    def slow(session, path, new):
        calls.append(new.number)
        if len(calls) == 1:  # another writer is first
            tables.publish(session, path, [tables.stage(spark.range(5, 6).selectExpr("id", "id AS v", "'ü' AS part"), path, ["part"])])
        return publish(session, path, new)

    monkeypatch.setattr(tables, "_publish", slow)
    assert tables.delete_rows(spark, table, F.col("id") == 5).rows_dropped == 2
    assert ids(spark, table) == [i for i in range(30) if i != 5] and len(calls) == 3


def test_compaction_keeps_rows_and_later_appends(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for k in range(5):
        tables.write_table(spark.range(k, k + 1).toDF("id"), path)
    stage, done = tables.stage, []

    def slow(df, at, *args, **kwargs):
        found = stage(df, at, *args, **kwargs)
        if not done:
            done.append(True)
            tables.write_table(spark.range(50, 51).toDF("id"), path)
        return found

    monkeypatch.setattr(tables, "stage", slow)
    tables.compact(spark, path, lambda df: df.coalesce(1))
    assert ids(spark, path) == [0, 1, 2, 3, 4, 50] and len(tables.state(spark, path).live) == 2


def test_folders_of_another_kind_are_refused(spark, table, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(3).write.parquet(path)
    assert ids(spark, path) == [0, 1, 2]
    with pytest.raises(ValueError, match="another kind"):
        tables.write_table(spark.range(3).toDF("id"), path)
    with pytest.raises(ValueError, match="partitioned by"):
        tables.write_table(tables.read_table(spark, table), table, ["id"])
    with pytest.raises(ValueError, match="no published table"):
        tables.delete_rows(spark, path, F.lit(True))


def test_logs_stay_a_bounded_number_of_files(spark, tmp_path):
    root = str(tmp_path)
    outcomes = [
        [csv.FileOutcome(csv.FileSpec(f"/in/{k}-{i}.csv", "bronze/one", HEADERS), "SUCCESS", i, version=(1, None)) for i in range(20)]
        for k in range(50)
    ]
    for k, batch in enumerate(outcomes):
        logs.log_files(spark, root, f"r{k // 10}", batch)
    path = f"{root}/{logs.FILE_LOG}"
    assert logs.read_log(spark, path).count() == 1000
    files = [f for f in (tmp_path / logs.FILE_LOG).rglob("*.parquet")]
    assert len(files) <= 2 * (logs.MOST_APPENDS + 1) and len(tables.state(spark, path).live) <= logs.MOST_APPENDS
    for k in (0, 49):  # replays of an append that was rewritten, and of one that was not
        logs.log_files(spark, root, f"r{k // 10}", outcomes[k])
    assert logs.read_log(spark, path).count() == 1000
    for _ in range(3):
        logs.log_run(spark, root, "r0", "x", "BRONZE", "RUNNING")
        logs.log_run(spark, root, "r0", "x", "BRONZE", "SUCCESS", 5)
    history = logs.run_history(logs.read_log(spark, f"{root}/{logs.RUN_LOG}")).collect()
    assert [(r["status"], r["rows_processed"]) for r in history] == [("SUCCESS", 5)]
    assert tables.read_table(spark, f"{root}/{logs.RUN_LOG}").count() == 2


def test_files_overlap_in_time_and_one_failure_stays_alone(spark, tmp_path, monkeypatch):
    specs = []
    for k in range(6):
        (tmp_path / f"{k}.csv").write_text("X,Y\n1,2\n" if k == 2 else f"ID,Primary Type\n{k},THEFT\n")
        specs.append(csv.FileSpec(str(tmp_path / f"{k}.csv"), "bronze/one", HEADERS))
    times, land = [], csv.land_csv

    def timed(*args):
        start = time.time()
        time.sleep(0.5)
        try:
            return land(*args)
        finally:
            times.append((start, time.time()))

    monkeypatch.setattr(csv, "land_csv", timed)
    root = str(tmp_path / "lake")
    report = csv.ingest_files(spark, specs + specs[:1], root, "r1", parallel=3, batch_files=4)
    assert [o.status for o in report.outcomes] == ["SUCCESS", "SUCCESS", "FAILED", "SUCCESS", "SUCCESS", "SUCCESS", "SKIPPED"]
    assert any(a < d and c < b for i, (a, b) in enumerate(times) for c, d in times[i + 1 :])
    assert ids(spark, f"{root}/bronze/one") == ["0", "1", "3", "4", "5"]
    assert tables.state(spark, f"{root}/bronze/one").number == 2  # one state for each batch


def test_unpublished_landings_of_a_broken_run_are_loaded_again(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("ID,Primary Type\n1,THEFT\n")
    spec, root = csv.FileSpec(str(tmp_path / "a.csv"), "bronze/one", HEADERS), str(tmp_path / "lake")

    def broken(*_):
        raise OSError()

    with monkeypatch.context() as patch:
        patch.setattr(logs, "log_files", broken)
        with pytest.raises(OSError):
            csv.ingest_files(spark, [spec], root, "r1")
    assert csv.ingest_files(spark, [spec], root, "r1").outcomes[0].status == "SUCCESS"
    assert ids(spark, f"{root}/bronze/one") == ["1"]
    assert csv.first_line(OSError()) == "OSError"


def test_rows_set_apart_are_deleted_without_rewriting(spark, tmp_path):
    """A delete of the rows that were set apart drops their files; later writes and deletes go on as on any table."""
    path = str(tmp_path / "apart")
    frame = spark.range(0, 40, 1, 4).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("v"))
    doomed = F.col("v") == 0
    assert tables.replace_table(frame, path, apart=doomed) == 40
    assert tables.read_table(spark, path).columns == ["id", "v"] and ids(spark, path) == list(range(40))
    found = tables.delete_rows(spark, path, doomed)
    kept = [i for i in range(40) if not (i % 7 and i % 5 == 0)]
    assert (found.rows_in, found.rows_out, found.files_rewritten) == (40, len(kept), 4)
    assert ids(spark, path) == kept and len(tables.state(spark, path).live) == 1  # no generation of rewritten rows
    assert tables.delete_rows(spark, path, F.col("id") == 1).rows_dropped == 1
    tables.write_table(spark.range(50, 52).selectExpr("id", "id AS v"), path)
    assert ids(spark, path) == [i for i in kept if i != 1] + [50, 51]
    tables.compact(spark, path)
    assert ids(spark, path) == [i for i in kept if i != 1] + [50, 51]
    with pytest.raises(ValueError, match="partition"):
        tables.replace_table(frame, path, ["v"], apart=doomed)


def test_stored_tables_are_packed_closely_and_leave_no_shuffle_files(spark, tmp_path):
    """Shuffle files of a write go with it, also where writes run side by side, and the setting is as it was."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        found = manager.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP, "false")
    frame = spark.range(1000).withColumn("p", F.col("id") % 3)
    side_by_side(spark, [lambda n=n: tables.write_table(frame, str(tmp_path / n), ["p"]) for n in "abcd"])
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(SHUFFLE_CLEANUP, "false") == setting
    again = tables.read_table(spark, str(tmp_path / "a"))
    assert again.count() == 1000 and all(f.endswith(".zstd.parquet") for f in again.inputFiles())
