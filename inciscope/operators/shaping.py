"""Projection, union, row removal and deduplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inciscope.functions.rules import first_like
from inciscope.functions.text import cast_or_null
from inciscope.session import materialise


def select_as(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Project to ``{output name: expression or source column}``."""
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in spec.items()])


def keep_castable(df: DataFrame, col: str, data_type: str) -> DataFrame:
    """Drop rows whose value is NULL, blank or not convertible (stray header rows, for instance)."""
    return df.filter(cast_or_null(F.trim(F.col(col)), data_type).isNotNull())


def union_tagged(frames: Mapping[str, DataFrame], tag_col: str) -> DataFrame:
    """UNION ALL by column name, each row tagged with its source."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows a DELETE would leave: a condition that is NULL deletes nothing."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def computed_once(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df``, whose ``cols`` are worked out once for each row that other filters leave, even if rows are filtered by them.

    Spark moves a filter below the projection that gives its columns, where they are worked out a second time, but not
    below a generator, here of one row each.
    """
    fixed = F.inline(F.array(F.struct(*cols)))
    return df.select(*[c for c in df.columns if c not in cols], fixed).select(*df.columns)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order_by``; rows with a NULL key are excluded.

    Remaining ties are settled by all other columns, so the result never depends on task order. The ``= 1``
    filter lets Spark keep one row per key in each map task before the shuffle, so a key holding a large part
    of the rows does not reach one reducer whole.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ranking = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    present = df.dropna(subset=list(keys))
    return present.withColumn("_rn", F.row_number().over(ranking)).filter("_rn = 1").drop("_rn")


def latest_values(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], columns: Sequence[str],
    rows_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The ``columns`` of the rows that ``dedup_latest`` leaves, without sorting and moving the others.

    A task hands on at most two rows per key, so the second tells whether the first ties with another. Only rows of such
    keys need all their columns to be compared: they are read again, restricted to these keys. ``rows_of`` gives the rows
    of ``df`` for a table of keys, where they can be found before ``df`` is worked out. The result is stored.
    """
    spark, present = df.sparkSession, df.dropna(subset=list(keys))
    ranking = Window.partitionBy(*keys).orderBy(*order_by)
    two = present.withColumns({"_rn": F.row_number().over(ranking), "_rank": F.rank().over(ranking)}).filter("_rn <= 2")
    second = F.max(F.when(F.col("_rn") == 2, F.col("_rank"))).over(Window.partitionBy(*keys))
    best = two.withColumn("_tied", F.coalesce(second == 1, F.lit(False))).filter("_rn = 1")
    open_keys = {f"_open_{k}": F.when(F.col("_tied"), F.col(k)) for k in keys}
    found = materialise(best.select(*columns, *[expr.alias(name) for name, expr in open_keys.items()]), "latest")
    is_open = F.col(f"_open_{keys[0]}").isNotNull()
    tied = materialise(found.filter(is_open).select(*[F.col(f"_open_{k}").alias(k) for k in keys]), "tied")
    settled = found.filter(~is_open).select(*columns)
    if tied.isEmpty():
        return settled
    compared = dedup_latest(rows_of(tied) if rows_of else df.join(tied, list(keys), "left_semi"), keys, order_by).select(*columns)
    return settled.unionByName(materialise(compared, "compared"))


def bucket_source(df: DataFrame, col: str, patterns: Sequence[tuple[str, str]], out: str) -> DataFrame:
    return df.withColumn(out, first_like(F.col(col), patterns, "UNKNOWN"))


def preview(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in a total order, so repeated calls show the same rows."""
    return df.orderBy(*order_by).limit(n)


def row_counts(frames: Mapping[str, DataFrame], total_of: Sequence[str] = (), total_label: str = "TOTAL") -> DataFrame:
    """One row per table with its row count, plus an optional total over ``total_of``."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in frames.items()]
    report = reduce(DataFrame.unionByName, counts)
    if not total_of:
        return report
    total = (
        report.filter(F.col("table_name").isin(*total_of))
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.lit(total_label).alias("table_name"), "row_count")
    )
    return report.unionByName(total)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)


def top_k_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group; each map task keeps at most ``k`` per group before the shuffle."""
    ranking = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("rank_in_group", F.row_number().over(ranking)).filter(F.col("rank_in_group") <= k)
