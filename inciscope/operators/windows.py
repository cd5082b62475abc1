"""Ranking, shares, moving averages, period comparison and surrogate keys.

The window operators run on aggregated rows (one per group), never on raw records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inciscope.session import materialise

#: Rows of a series that are averaged in one task.
STRETCH_ROWS = 65_536


def with_rank(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], out: str) -> DataFrame:
    return df.withColumn(out, F.rank().over(Window.partitionBy(*by).orderBy(*order_by)))


def with_dense_rank(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], out: str) -> DataFrame:
    return df.withColumn(out, F.dense_rank().over(Window.partitionBy(*by).orderBy(*order_by)))


def with_position(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """Number rows from 0 in the given order, NULLs first. Rows are range-partitioned and stored with their partition
    number, and numbered within their partition; the sizes of the earlier ones are added."""
    order = [F.col(c).asc_nulls_first() for c in order_by]
    dealt = materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = sorted(dealt.groupBy("_part").agg(F.count(F.lit(1))).collect())  # one row per partition
    begins = accumulate((n for _, n in sizes), initial=0)
    rows = [(part, begin) for (part, _), begin in zip(sizes, begins)]
    offsets = df.sparkSession.createDataFrame(rows, "_part int, _offset bigint")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = dealt.withColumn("_local", local).join(F.broadcast(offsets), "_part")  # one row per partition
    return numbered.withColumn(out, F.col("_local") + F.col("_offset")).select(*df.columns, out)


def moving_average(df: DataFrame, order_by: Sequence[str], value: str, n: int, out: str, digits: int = 0) -> DataFrame:
    """Average over the current and up to ``n - 1`` preceding rows of a series.

    A stored series of up to ``STRETCH_ROWS`` rows is one stretch, averaged in one task. A longer one is numbered in order
    and cut into such stretches; each lends its last ``n - 1`` rows to the next, so every stretch is averaged on its own.
    """
    size, series = max(STRETCH_ROWS, n - 1), materialise(df, "series")
    average = F.round(F.avg(value).over(Window.partitionBy("_stretch").orderBy(*order_by).rowsBetween(1 - n, Window.currentRow)), digits)
    if series.count() <= size:
        return series.withColumn("_stretch", F.lit(0)).withColumn(out, average).drop("_stretch")
    at = F.col("_position")
    own = F.floor(at / size)
    lent = F.when(F.pmod(at, F.lit(size)) > size - n, F.array(own, own + 1)).otherwise(F.array(own))
    placed = with_position(series, order_by, "_position").withColumn("_stretch", F.explode(lent))
    return placed.withColumn(out, average).where(F.col("_stretch") == own).drop("_position", "_stretch")


def with_share(df: DataFrame, value: str, out: str, by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Percentage of the partition's (or the grand) total of an aggregated measure."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(out, F.round(F.lit(100.0) * F.col(value) / total, digits))


def share_by(df: DataFrame, key: str, count_name: str, share_name: str, digits: int = 2) -> DataFrame:
    """Row count per key and its share of all rows.

    The base is the sum of the counts as a scalar subquery: it reuses their shuffle, so rows are read once, and no
    window has to gather the keys in one task.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    base = counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn(share_name, F.round(F.lit(100.0) * F.col(count_name) / base, digits))


def period_over_period(
    df: DataFrame, keys: Sequence[str], period: str, measures: Mapping[str, str], lag: int = 1
) -> DataFrame:
    """Add each measure's value ``lag`` periods earlier as ``{measure: output}``.

    Matches by period value, not by position: a missing period gives NULL, and so does a NULL one (whose frame would
    hold the NULL periods themselves).
    """
    earlier = Window.partitionBy(*keys).orderBy(period).rangeBetween(-lag, -lag)
    known = F.col(period).isNotNull()
    return df.withColumns({out: F.when(known, F.max(measure).over(earlier)) for measure, out in measures.items()})


def effectiveness(df: DataFrame, rate: str, rank: str, by: Sequence[str], out: str, digits: int = 2) -> DataFrame:
    """Rate minus the rank scaled to 0-100 by the group's highest rank."""
    worst = F.max(rank).over(Window.partitionBy(*by))
    return df.withColumn(out, F.round(F.col(rate) - F.col(rank) * F.lit(1.0) / worst * F.lit(100), digits))


def assign_surrogate_key(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """Dense rank over all rows as an int key, NULLs first.

    Rows are range-partitioned by the ordering columns and stored with their partition number. Ranks are taken within
    each partition and shifted by the sizes of the earlier ones, so a task holds one partition's rows and only one row
    per partition meets in a single task, whatever prefix or leading value the keys share. Rows are stored before, since
    range partitioning works them out twice.
    """
    df = materialise(df, "unranked")
    order = [F.col(c).asc_nulls_first() for c in order_by]
    dealt = materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    ranked = dealt.withColumn("_local", F.dense_rank().over(Window.partitionBy("_part").orderBy(*order)))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_part")
        .agg(F.max("_local").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    keyed = ranked.join(F.broadcast(offsets), "_part")  # one row per partition
    return keyed.withColumn(out, (F.col("_local") + F.col("_offset")).cast("int")).select(out, *df.columns)
