"""Delimited text: landing reads, per-file ingestion and result export."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inciscope.sources import logs, tables

CORRUPT = "_corrupt_record"
FILE_KEY = "_file_key"
#: Bytes of text that a landed Parquet file is made of, as they are stored, at most as many files as cores being smaller.
LANDED_BYTES = 128 << 20
#: Most rows of a compressed text file, which one task has to read whole.
PACKED_ROWS = 100_000
#: Files landed side by side, and files that become visible and are logged together.
PARALLEL_FILES, BATCH_FILES = 8, 64
LINEAGE = ["_source_file", "_source_path", "_ingest_ts", "_bronze_table"]


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Every column as text, matched by header name; malformed rows are kept, with their text set aside.

    Only the header line is read up front. A missing column is an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    schema = StructType([StructField(c, StringType()) for c in [*header, CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # a row is only known to be malformed when it is parsed whole
        .csv(path)
    )
    return rows.select(*columns, CORRUPT, "_metadata")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_lineage(df: DataFrame, target: str, at: datetime | None = None) -> DataFrame:
    """Stamp file name, path, ingest time (by default now) and target table on rows read by ``read_raw_csv``."""
    return df.withColumns(
        {
            "_source_file": F.col("_metadata.file_name"),
            "_source_path": F.col("_metadata.file_path"),
            "_ingest_ts": F.lit(at) if at else F.current_timestamp(),
            "_bronze_table": F.lit(target),
        }
    ).drop("_metadata")


def land_csv(
    spark: SparkSession, path: str, headers: Mapping[str, str], target: str, at: datetime | None = None
) -> DataFrame:
    return with_lineage(rename_columns(read_raw_csv(spark, path, list(headers)), headers), target, at)


@dataclass(frozen=True)
class FileSpec:
    path: str
    target: str
    headers: Mapping[str, str]

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    @property
    def key(self) -> str:
        """Names the file's rows: by its whole path, since folders may hold files of one name."""
        return hashlib.sha256(self.path.rstrip("/").encode()).hexdigest()[:32]


@dataclass(frozen=True)
class FileOutcome:
    spec: FileSpec
    status: str
    row_count: int = 0
    error: str | None = None
    version: tuple | None = None


@dataclass(frozen=True)
class IngestReport:
    run_id: str
    status: str
    outcomes: list[FileOutcome]

    @property
    def rows_processed(self) -> int:
        return sum(o.row_count for o in self.outcomes)


def file_version(spark: SparkSession, path: str) -> tuple:
    """Bytes and last modification of a file or of all files in a folder; contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("length", "modificationTime")
    return tuple(found.agg(F.sum("length"), F.max("modificationTime")).first())


def first_line(error: Exception) -> str:
    return (str(error).strip() or type(error).__name__).splitlines()[0]


def _land_one(
    spark: SparkSession, spec: FileSpec, root: str, loaded: tuple | None, at: datetime
) -> tuple[FileOutcome, tables.Staged | None]:
    """Land a file as a generation that is not published yet."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "ingest")
    version = None
    try:
        version = file_version(spark, spec.path)
        if version == loaded:
            return FileOutcome(spec, "SKIPPED", version=version), None
        rows = land_csv(spark, spec.path, spec.headers, spec.target, at).withColumn(FILE_KEY, F.lit(spec.key))
        # Scans are split for wide sorts; a task that only lands text takes several splits, so that no small files are left.
        rows = rows.coalesce(max(spark.sparkContext.defaultParallelism, -(-(version[0] or 0) // LANDED_BYTES)))
        staged = tables.stage(rows, f"{root}/{spec.target}", token=spec.key)
        return FileOutcome(spec, "SUCCESS", staged.rows, version=version), staged
    except (PySparkException, Py4JJavaError, ValueError, OSError) as error:
        return FileOutcome(spec, "FAILED", 0, first_line(error), version), None


def _batches(specs: Sequence[FileSpec], size: int) -> Iterator[list[FileSpec]]:
    """In order; a path that comes twice for one target is in two batches."""
    batch: list[FileSpec] = []
    for spec in specs:
        if len(batch) == size or any((s.path, s.target) == (spec.path, spec.target) for s in batch):
            yield batch
            batch = []
        batch.append(spec)
    if batch:
        yield batch


def ingest_files(
    spark: SparkSession, specs: Sequence[FileSpec], root: str, run_id: str, parallel: int = PARALLEL_FILES,
    batch_files: int = BATCH_FILES,
) -> IngestReport:
    """Land each file in its own jobs, ``parallel`` files side by side; one failing file does not stop the others.

    The files of a batch become visible together, in one state of each landing table, and are logged in one append.
    Each path is a generation of its own of the landing table, so files of one name in several folders stay apart. A file
    is skipped only if the same path was loaded into the same target with this size and modification time; a changed one
    replaces its own rows. A repeated or resumed run thus neither duplicates nor loses rows. Ingest times follow the
    order of ``specs``, whichever file is done first: later steps take the newest row of a key.
    """
    with logs.logged_run(spark, root, run_id, "bronze_bulk_ingest", "BRONZE", "sources/csv.py") as run:
        done = logs.loaded_versions(spark, root, [s.path for s in specs])
        outcomes: list[FileOutcome] = []
        newest = datetime.min.replace(tzinfo=UTC)
        with ThreadPoolExecutor(parallel) as pool:
            for batch in _batches(specs, batch_files):
                landing = inheritable_thread_target(spark)(
                    lambda spec, at: _land_one(spark, spec, root, done.get((spec.path, spec.target)), at)
                )
                begun = max(datetime.now(UTC), newest)
                stamps = [begun + timedelta(microseconds=k + 1) for k in range(len(batch))]
                newest = stamps[-1]
                landed = list(pool.map(landing, batch, stamps))
                by_target: dict[str, list[tables.Staged]] = {}
                for outcome, staged in landed:
                    if staged:
                        by_target.setdefault(outcome.spec.target, []).append(staged)
                for target, staged in by_target.items():
                    tables.publish(spark, f"{root}/{target}", staged)
                logs.log_files(spark, root, run_id, [outcome for outcome, _ in landed])
                outcomes += [outcome for outcome, _ in landed]
                done |= {(o.spec.path, o.spec.target): o.version for o, _ in landed if o.status == "SUCCESS"}
        failed = sum(o.status == "FAILED" for o in outcomes)
        report = IngestReport(run_id, "PARTIAL_SUCCESS" if failed else "SUCCESS", outcomes)
        run.status, run.processed = report.status, report.rows_processed
        run.error = f"{failed} file(s) failed to load" if failed else None
    return report


def export_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """Write with a header, keeping leading and trailing spaces; ``packed`` as gzip files of at most ``PACKED_ROWS`` rows."""
    packing = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": PACKED_ROWS} if packed else {}
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**packing)
        .csv(path)
    )
