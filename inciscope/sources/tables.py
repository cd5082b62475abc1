"""Stored Parquet tables whose writes are seen whole or not at all.

A write goes to a folder of its own, ``_gen=<id>``, below the table's. What a reader sees is named by the newest manifest
in ``_manifests``: the generations that are live, and the files of them that a delete has replaced. A manifest is written
aside and renamed, which fails if another writer was first; so a write that breaks off leaves the table as it was, and of
two writers one starts again from the other's state. A reader holds the files it began with until ``KEPT`` further states
have been published.

Appends may carry a token: a second append of the same token takes the place of the first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inciscope.session import shuffles_removed

MANIFESTS, GENERATION, APART = "_manifests", "_gen", "_apart"
#: Earlier states whose files are left for readers that still use them.
KEPT = 1
#: Appends after which older states are deleted.
TIDY_EVERY = 16
#: Stored tables stay, so they are packed more closely than what is read once.
CODEC = "zstd"
#: How often a writer starts again after another one was first.
ATTEMPTS = 20


class ConflictError(RuntimeError):
    """Other writers kept changing the table."""


@dataclass(frozen=True)
class State:
    """A published state: live generations with their token and the relative paths of files that are no longer read."""

    number: int = 0
    schema: str = ""
    partition_by: tuple[str, ...] = ()
    live: Mapping[str, dict] = field(default_factory=dict)

    def with_generation(self, name: str, df_schema: StructType, partition_by: Sequence[str], token: str | None) -> State:
        if self.live and tuple(partition_by) != self.partition_by:
            raise ValueError(f"the table is partitioned by {list(self.partition_by)}")
        known = StructType.fromJson(json.loads(self.schema)).fields if self.schema else []
        new = [f for f in df_schema.fields if f.name not in {k.name for k in known}]
        live = {g: e for g, e in self.live.items() if token is None or e["token"] != token}
        live[name] = {"token": token, "dropped": []}
        return replace(self, schema=StructType([*known, *new]).json(), partition_by=tuple(partition_by), live=live)


def _fs(spark: SparkSession, path: str):
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(settings), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _load(spark: SparkSession, path: str, name: str) -> State:
    fs, at = _fs(spark, f"{path}/{MANIFESTS}/{name}")
    stream = fs.open(at)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return State(found["number"], found["schema"], tuple(found["partition_by"]), found["live"])


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]


def state(spark: SparkSession, path: str) -> State:
    """The newest published state; an empty one if nothing was published."""
    found = _manifests(spark, path)
    return _load(spark, path, found[-1]) if found else State()


def _publish(spark: SparkSession, path: str, new: State) -> bool:
    """Publish as the next state; False if another writer has published that number."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    number = new.number + 1
    body = {"number": number, "schema": new.schema, "partition_by": list(new.partition_by), "live": dict(new.live)}
    fs, aside = _fs(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(json.dumps(body).encode())
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{number:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), no_options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _change(spark: SparkSession, path: str, change: Callable[[State], State]) -> State:
    """Publish ``change`` of the newest state, again from the start where another writer was first."""
    for _ in range(ATTEMPTS):
        now = state(spark, path)
        if not now.number and any(not n.startswith(("_", ".")) for n in _names(spark, path)):
            raise ValueError(f"{path} holds files of another kind")
        new = change(now)
        if _publish(spark, path, new):
            return replace(new, number=now.number + 1)
    raise ConflictError(path)


def vacuum(spark: SparkSession, path: str, kept: int = KEPT) -> int:
    """Delete states older than the newest and ``kept`` before it, and the generations that only they name."""
    names = _manifests(spark, path)
    old, held = names[: -1 - kept], names[-1 - kept :]
    used = {g for n in held for g in _load(spark, path, n).live}
    gone = {g for n in old for g in _load(spark, path, n).live} - used
    for generation in gone:
        _delete(spark, f"{path}/{GENERATION}={generation}")
    for name in old:
        _delete(spark, f"{path}/{MANIFESTS}/{name}")
    return len(gone)


def _relative(file_path: str, generation: str) -> str:
    return unquote(file_path.split(f"/{GENERATION}={generation}/", 1)[1])


def _paths(spark: SparkSession, path: str, now: State) -> list[str]:
    """Folders of live generations; of one that a delete has touched, the files left."""
    out = []
    for generation, entry in now.live.items():
        folder = f"{path}/{GENERATION}={generation}"
        if not entry["dropped"]:
            out.append(folder)
            continue
        gone = set(entry["dropped"])
        files = spark.read.schema(StructType.fromJson(json.loads(now.schema))).parquet(folder).inputFiles()
        out += [f"{folder}/{r}" for r in (_relative(f, generation) for f in files) if r not in gone]
    return out


def _read(spark: SparkSession, path: str, now: State, paths: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(now.schema))
    paths = _paths(spark, path, now) if paths is None else paths
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if now.partition_by:
        return reader.option("basePath", path).parquet(*paths)
    return reader.option("recursiveFileLookup", True).parquet(*paths)  # folders of rows set apart are no columns


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest published state; a folder written by other means is read as plain Parquet."""
    now = state(spark, path)
    if not now.number:
        return spark.read.parquet(path)
    return _read(spark, path, now).select(*StructType.fromJson(json.loads(now.schema)).names)


def _rows(counted: Observation, uncounted) -> int:
    """Observed rows; ``uncounted()`` where the optimizer proved the branch empty and dropped the observation."""
    try:
        return counted.get["rows"]
    except Py4JJavaError:
        return uncounted()


@dataclass(frozen=True)
class Staged:
    """A written generation that no reader sees yet."""

    generation: str
    schema: StructType
    partition_by: tuple[str, ...]
    rows: int
    token: str | None


def stage(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), token: str | None = None, apart: Column | None = None
) -> Staged:
    """Write a generation without publishing it; rows are counted by the same job.

    Rows for which ``apart`` is true go to files of their own, so that deleting them later drops those files and rewrites
    none. Every task then writes up to two files, without a shuffle; such a table has no partition columns.

    A partitioned table is rebalanced by its partition columns first: otherwise each of many tasks would leave a
    small file in every partition. Rebalancing also splits a partition that holds a large part of the rows. Rows are
    counted after the last shuffle, where a task that runs again after an executor is lost counts once.
    """
    if apart is not None and partition_by:
        raise ValueError("rows are set apart in tables without partition columns only")
    generation, schema, folders = uuid.uuid4().hex, df.schema, partition_by
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if apart is not None:
        observed, folders = observed.withColumn(APART, F.coalesce(apart, F.lit(False))), [APART]
    with shuffles_removed(df.sparkSession):
        observed.write.partitionBy(*folders).option("compression", CODEC).parquet(f"{path}/{GENERATION}={generation}")
    return Staged(generation, schema, tuple(partition_by), _rows(counted, int), token)


def publish(spark: SparkSession, path: str, staged: Sequence[Staged], fresh: bool = False) -> State:
    """Make staged generations part of the table, all at once; ``fresh`` drops what it held before."""

    def change(now: State) -> State:
        new = State(now.number) if fresh else now
        for s in staged:
            new = new.with_generation(s.generation, s.schema, s.partition_by, s.token)
        return new

    done = _change(spark, path, change)
    if done.number % TIDY_EVERY == 0:
        vacuum(spark, path)
    return done


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), token: str | None = None) -> int:
    """Append and return the rows written. With a token, rows appended under it before are replaced, so that a replay
    adds nothing."""
    staged = stage(df, path, partition_by, token)
    publish(df.sparkSession, path, [staged])
    return staged.rows


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), apart: Column | None = None) -> int:
    """Replace all rows and return how many there are now. The old rows stay readable until the new ones are complete,
    and for readers that have begun. For ``apart`` see ``stage``."""
    staged = stage(df, path, partition_by, apart=apart)
    publish(df.sparkSession, path, [staged], fresh=True)
    vacuum(df.sparkSession, path)
    return staged.rows


@dataclass(frozen=True)
class Deleted:
    rows_in: int
    rows_out: int
    files: int
    files_rewritten: int

    @property
    def rows_dropped(self) -> int:
        return self.rows_in - self.rows_out


def delete_rows(spark: SparkSession, path: str, condition: Column, added: Sequence[Staged] = ()) -> Deleted:
    """Delete the rows for which ``condition`` is true (not those for which it is NULL); ``added`` generations become
    visible together with that.

    One scan finds the files that hold such rows, and only those are rewritten: their other rows go to a new generation,
    which replaces them in the next state. If the table has changed meanwhile, the delete starts again.
    """
    for _ in range(ATTEMPTS):
        now = state(spark, path)
        if not now.number:
            raise ValueError(f"{path} is no published table")
        rows = _read(spark, path, now)
        hit = F.coalesce(condition, F.lit(False))
        counts = (
            rows.select(F.col("_metadata.file_path").alias("file"), hit.alias("hit"))
            .groupBy("file")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hit")).alias("hits"))
        )
        per_file = counts.collect()  # one row for each file, as the planner's own listing
        rows_in, hits = sum(r["n"] for r in per_file), sum(r["hits"] for r in per_file)
        touched = [r["file"] for r in per_file if r["hits"]]
        outcome = Deleted(rows_in, rows_in - hits, len(per_file), len(touched))
        if not touched and not added:
            return outcome
        by_generation: dict[str, list[str]] = {}
        for file in touched:
            generation = next(g for g in now.live if f"/{GENERATION}={g}/" in file)
            by_generation.setdefault(generation, []).append(_relative(file, generation))
        paths = [f"{path}/{GENERATION}={g}/{f}" for g, files in by_generation.items() for f in files]
        names = StructType.fromJson(json.loads(now.schema)).names
        live = {g: {**e, "dropped": [*e["dropped"], *by_generation.get(g, [])]} for g, e in now.live.items()}
        new, rest = replace(now, live=live), []
        if hits < sum(r["n"] for r in per_file if r["hits"]):
            rest = [stage(_read(spark, path, now, paths).filter(~hit).select(*names), path, now.partition_by)]
        for s in (*rest, *added):
            new = new.with_generation(s.generation, s.schema, s.partition_by, s.token)
        if _publish(spark, path, new):
            vacuum(spark, path)
            return outcome
        for s in rest:
            _delete(spark, f"{path}/{GENERATION}={s.generation}")
    raise ConflictError(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the rows of the partitions that are in ``df``; the others stay."""
    spark, staged = df.sparkSession, stage(df, path, partition_by)
    if not state(spark, path).number:
        publish(spark, path, [staged])
        return staged.rows
    folder = f"{path}/{GENERATION}={staged.generation}"
    written = spark.read.schema(staged.schema).option("basePath", path).parquet(folder)
    condition = F.lit(False)
    for row in written.select(*partition_by).distinct().collect():  # one row for each partition written
        same = [F.col(c).eqNullSafe(F.lit(value)) for c, value in row.asDict().items()]
        condition = condition | reduce(Column.__and__, same)
    delete_rows(spark, path, condition, [staged])
    return staged.rows


def compact(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> State:
    """Rewrite all live rows, changed by ``transform`` if given, as one generation; tokens given before are forgotten.

    What others append meanwhile stays beside it; a generation that they replace or delete from makes it start again.
    """
    for _ in range(ATTEMPTS):
        now = state(spark, path)
        rows = _read(spark, path, now).select(*StructType.fromJson(json.loads(now.schema)).names)
        staged = stage(transform(rows) if transform else rows, path, now.partition_by)

        def change(newer: State) -> State:
            if any(newer.live.get(g) != e for g, e in now.live.items()):
                raise ConflictError(path)
            rest = {g: e for g, e in newer.live.items() if g not in now.live}
            return replace(newer, live={staged.generation: {"token": None, "dropped": []}, **rest})

        try:
            done = _change(spark, path, change)
        except ConflictError:
            _delete(spark, f"{path}/{GENERATION}={staged.generation}")
            continue
        vacuum(spark, path)
        return done
    raise ConflictError(path)


@dataclass(frozen=True)
class AuditRow:
    step_name: str
    target_table: str
    rows_in: int
    rows_out: int
    source_table: str | None = None
    notes: str | None = None

    @property
    def rows_dropped(self) -> int:
        return self.rows_in - self.rows_out


def write_audited(
    source: DataFrame, transform, path: str, step: str, rows_in: int | None = None, source_table: str | None = None,
    notes: str | None = None, apart: Column | None = None,
) -> AuditRow:
    """Write ``transform(source)``, counting rows in and out within the one write job.

    Give ``rows_in`` where it is known and the transform shuffles: below a shuffle, rows read again after an
    executor is lost would be counted again.
    """
    taken = Observation()
    watched = source if rows_in is not None else source.observe(taken, F.count(F.lit(1)).alias("rows"))
    rows_out = replace_table(transform(watched), path, apart=apart)
    rows_in = _rows(taken, source.count) if rows_in is None else rows_in
    return AuditRow(step, path.rstrip("/").rsplit("/", 1)[-1], rows_in, rows_out, source_table, notes)
