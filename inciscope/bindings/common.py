"""Shared readers and SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def sql_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def sql_pct(num: str, den: str, digits: int = 2) -> str:
    """100 * num / den for non-negative integers, rounded half up exactly, as a double."""
    scale = 10**digits
    return f"(CAST((CAST(2 * {scale} * 100 AS HUGEINT) * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / {scale})"


def sql_signed_pct(num: str, den: str, digits: int = 2) -> str:
    return f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * {sql_pct(f'abs({num})', den, digits)})"


def sql_count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def sql_sum(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def sql_round_even(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * {10**digits}.0::DOUBLE, 0) / {10**digits})"
