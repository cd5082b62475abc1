"""Control logs; the state of a run is its latest row.

A row's token says what it records (a status of a run, the outcome of a file). An append of rows logged before takes the
place of the first, so a replay adds nothing. Every ``MOST_APPENDS`` appends a log is rewritten as one generation, with
the newest row of each token, so that it stays a bounded number of files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope.operators.shaping import dedup_latest
from inciscope.sources.tables import compact, read_table, state, write_table

RUN_LOG = "meta/etl_run_log"
FILE_LOG = "meta/file_ingestion_log"
STEP_LOG = "meta/silver_transform_log"
PUBLICATION_LOG = "meta/gold_publication_log"
FAILURE_LOG = "meta/quality_failures"

RUN_SCHEMA = (
    "run_id string, pipeline_name string, zone string, script_name string, status string, rows_processed bigint,"
    " rows_rejected bigint, error_message string"
)
FILE_SCHEMA = (
    "run_id string, source_file_name string, source_file_path string, target_table string, zone string,"
    " row_count bigint, file_size_bytes bigint, file_modified_ts timestamp, status string, error_message string"
)
STEP_SCHEMA = (
    "run_id string, step_name string, source_table string, target_table string, rows_in bigint, rows_out bigint,"
    " rows_dropped bigint, notes string"
)
#: When a row was logged, by log.
STAMPS = ("logged_at", "ingest_ts", "transform_ts")
# Fixed values of a publication row.
PUBLICATION_STEP, PUBLICATION_SOURCE = "GOLD_STEP9_FINAL_PUBLICATION", "N/A"
PUBLICATION_NOTE = "Object Type: {kind} - Published and verified successfully."


TOKEN = "_token"
#: Appends after which a log is rewritten as one.
MOST_APPENDS = 32


def _newest(log: DataFrame) -> DataFrame:
    """The newest row of each token."""
    stamp = next(c for c in STAMPS if c in log.columns)
    return dedup_latest(log, [TOKEN], [F.desc(stamp)])


def _append(
    spark: SparkSession, rows: Iterable[tuple], schema: str, stamps: Mapping[str, Column], path: str, key: Sequence[int]
) -> None:
    """Append rows; those at the places ``key`` make a row's token."""
    marked = [(*row, "/".join(str(row[k]) for k in key)) for row in rows]
    if not marked:
        return
    frame = spark.createDataFrame(marked, f"{schema}, {TOKEN} string").withColumns(dict(stamps)).coalesce(1)
    token = hashlib.sha256("\n".join(row[-1] for row in marked).encode()).hexdigest()[:32]
    write_table(frame, path, token=token)
    if len(state(spark, path).live) > MOST_APPENDS:
        compact(spark, path, lambda log: _newest(log).coalesce(1))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log's rows, each recorded event once."""
    log = read_table(spark, path)
    return _newest(log).drop(TOKEN) if TOKEN in log.columns else log


def log_run(
    spark: SparkSession,
    root: str,
    run_id: str,
    name: str,
    zone: str,
    status: str,
    processed: int | None = None,
    rejected: int | None = None,
    error: str | None = None,
    script: str | None = None,
) -> None:
    row = (run_id, name, zone, script, status, processed, rejected, error)
    stamps = {"logged_at": F.current_timestamp(), "run_by": F.current_user()}
    _append(spark, [row], RUN_SCHEMA, stamps, f"{root}/{RUN_LOG}", key=(0, 1, 4))


@dataclass
class RunCounts:
    processed: int | None = None
    rejected: int | None = None
    status: str = "SUCCESS"
    error: str | None = None


@contextmanager
def logged_run(spark: SparkSession, root: str, run_id: str, name: str, zone: str, script: str) -> Iterator[RunCounts]:
    """Log a run as RUNNING and, at its end, with what the caller has set on the counts; FAILED if it raises."""
    log_run(spark, root, run_id, name, zone, "RUNNING", script=script)
    counts = RunCounts()
    try:
        yield counts
    except Exception as error:
        message = (str(error).strip() or type(error).__name__).splitlines()[0]
        log_run(spark, root, run_id, name, zone, "FAILED", counts.processed, counts.rejected, message, script)
        raise
    log_run(spark, root, run_id, name, zone, counts.status, counts.processed, counts.rejected, counts.error, script)


def log_files(spark: SparkSession, root: str, run_id: str, outcomes: Iterable) -> None:
    rows = []
    for outcome in outcomes:
        spec, (size, modified) = outcome.spec, outcome.version or (None, None)
        rows.append(
            (run_id, spec.name, spec.path, spec.target, "BRONZE", outcome.row_count, size, modified, outcome.status, outcome.error)
        )
    _append(spark, rows, FILE_SCHEMA, {"ingest_ts": F.current_timestamp()}, f"{root}/{FILE_LOG}", key=(0, 2, 3, 8))


def log_steps(spark: SparkSession, root: str, run_id: str, audits: Iterable, log: str = STEP_LOG) -> None:
    rows = [
        (run_id, a.step_name, a.source_table, a.target_table, a.rows_in, a.rows_out, a.rows_dropped, a.notes) for a in audits
    ]
    _append(spark, rows, STEP_SCHEMA, {"transform_ts": F.current_timestamp()}, f"{root}/{log}", key=(0, 1, 3))


def loaded_versions(spark: SparkSession, root: str, paths: Sequence[str]) -> dict[tuple[str, str], tuple]:
    """(size, modification time) of the version last loaded, by path and target, for those of ``paths`` that were."""
    try:
        log = read_log(spark, f"{root}/{FILE_LOG}")
    except AnalysisException:
        return {}
    done = log.filter((F.col("status") == "SUCCESS") & F.col("source_file_path").isin(*paths))
    newest = done.groupBy("source_file_path", "target_table").agg(
        F.max_by(F.struct("file_size_bytes", "file_modified_ts"), "ingest_ts").alias("version")
    )
    return {(r["source_file_path"], r["target_table"]): tuple(r["version"]) for r in newest.collect()}


def latest_status(log: DataFrame, run: str = "run_id", order_by: Sequence[Column] | None = None) -> DataFrame:
    """Current row of each run: what an UPDATE in place would have left."""
    return dedup_latest(log, [run], order_by or [F.desc("logged_at")])


def run_history(log: DataFrame) -> DataFrame:
    """One row per run: when it started and ended, its current status, counts and error."""
    last = ["status", "rows_processed", "rows_rejected", "error_message"]
    newest = F.max_by(F.struct(*last), F.struct("logged_at", F.col("status") != "RUNNING"))
    history = log.groupBy("run_id", "pipeline_name", "zone", "run_by").agg(
        F.min("logged_at").alias("start_ts"), F.max("logged_at").alias("_last_ts"), newest.alias("_last")
    )
    ended = F.when(F.col("_last.status") != "RUNNING", F.col("_last_ts"))
    return history.select(
        "run_id", "pipeline_name", "zone", "run_by", "start_ts", ended.alias("end_ts"), *[f"_last.{c}" for c in last]
    )


def publication_log(
    objects: Mapping[str, DataFrame], run_id: str, types: Mapping[str, str] | None = None, counts: Mapping[str, int] | None = None
) -> DataFrame:
    """One audit row with the row count of every published object; ``counts`` has those that a write has counted."""
    kinds, known = types or {}, counts or {}
    rows = []
    for name, df in objects.items():
        if name in known:
            counted = df.sparkSession.range(1).select(F.lit(known[name]).cast("bigint").alias("rows_out"))
        else:
            counted = df.agg(F.count(F.lit(1)).alias("rows_out"))
        rows.append(
            counted.select(
                F.lit(run_id).alias("run_id"),
                F.lit(PUBLICATION_STEP).alias("step_name"),
                F.lit(PUBLICATION_SOURCE).alias("source_table"),
                F.lit(name).alias("target_table"),
                F.col("rows_out").alias("rows_in"),
                "rows_out",
                F.lit(0).cast("bigint").alias("rows_dropped"),
                F.lit(PUBLICATION_NOTE.format(kind=kinds.get(name, "TABLE"))).alias("notes"),
                F.current_timestamp().alias("log_ts"),
            )
        )
    return reduce(DataFrame.unionByName, rows)
