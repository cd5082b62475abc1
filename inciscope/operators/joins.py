"""Dimension lookups, existence tests and key validation.

No join carries a broadcast hint: Spark broadcasts a side whose known size is under its threshold and otherwise
sort-merges with adaptive skew handling. Keys are reduced to their distinct values before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DimSpec:
    """Lookup of ``take`` (dim column -> output name) where ``key_expr`` equals the dim's ``key``."""

    dim: DataFrame
    key: str
    key_expr: Column
    take: Mapping[str, str] = field(default_factory=dict)


def conform(df: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """Left-join each dimension; unmatched rows stay, with NULLs."""
    for position, spec in enumerate(specs):
        key = f"_dim_key_{position}"
        lookup = spec.dim.select(F.col(spec.key).alias(key), *[F.col(c).alias(out) for c, out in spec.take.items()])
        df = df.join(lookup, spec.key_expr == F.col(key), "left").drop(key)
    return df


def with_known_flag(df: DataFrame, key_expr: Column, dim: DataFrame, key: str, out: str) -> DataFrame:
    """Flag rows whose key is in the dimension; a NULL key is not."""
    known = dim.select(F.col(key).alias("_known_key")).distinct()
    return (
        df.join(known, key_expr == F.col("_known_key"), "left")
        .withColumn(out, F.col("_known_key").isNotNull())
        .drop("_known_key")
    )


def exists_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def not_exists_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def lookup_first(df: DataFrame, other: DataFrame, on: Sequence[str], value: str, out: str) -> DataFrame:
    """Correlated single-value lookup: the smallest ``value`` per key, so the choice is repeatable."""
    first = other.groupBy(*on).agg(F.min(value).alias(out))
    return df.join(first, list(on), "left")


def unmatched_keys(df: DataFrame, key_expr: Column, dim: DataFrame, key: str, out: str, count_name: str) -> DataFrame:
    """Keys absent from the dimension, with their row counts."""
    counts = df.select(key_expr.alias(out)).dropna().groupBy(out).agg(F.count(F.lit(1)).alias(count_name))
    return counts.join(dim.select(F.col(key).alias(out)).distinct(), [out], "left_anti")


def unmatched_after_join(df: DataFrame, code: str, name: str, count_name: str) -> DataFrame:
    """Codes of a conformed table whose lookup gave no name, with their row counts."""
    unnamed = df.filter(F.col(name).isNull() & F.col(code).isNotNull())
    return unnamed.groupBy(code).agg(F.count(F.lit(1)).alias(count_name))


def join_key_validation(df: DataFrame, dims: Mapping[str, DimSpec]) -> DataFrame:
    """One row: for each named dimension, how many distinct keys of ``df`` it lacks.

    All keys are taken in one scan and reduced to distinct (dimension, key) pairs before the anti join.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("dim"), s.key_expr.cast("string").alias("code")) for name, s in dims.items()])
    used = df.select(F.inline(pairs)).dropna().distinct()
    known = reduce(
        DataFrame.unionByName,
        [s.dim.select(F.lit(name).alias("dim"), F.col(s.key).cast("string").alias("code")) for name, s in dims.items()],
    ).distinct()
    missing = used.join(known, ["dim", "code"], "left_anti")
    return missing.agg(*[F.count_if(F.col("dim") == name).alias(name) for name in dims])
