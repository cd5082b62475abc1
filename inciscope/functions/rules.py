"""Value lookup and first-match classification."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_values(col: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Replace each listed value; others take ``default`` or NULL."""
    result = None
    for value, label in mapping.items():
        result = F.when(col == value, label) if result is None else result.when(col == value, label)
    if result is None:
        return default if default is not None else F.lit(None)
    return result if default is None else result.otherwise(default)


def classify(col: Column, rules: Iterable[tuple[str, Iterable]], default: str) -> Column:
    """Label of the first rule listing the value."""
    result = F.when(F.lit(False), default)
    for label, values in rules:
        result = result.when(col.isin(*values), label)
    return result.otherwise(default)


def first_like(col: Column, patterns: Iterable[tuple[str, str]], default: str) -> Column:
    """Label of the first LIKE pattern the text matches."""
    result = F.when(F.lit(False), default)
    for pattern, label in patterns:
        result = result.when(col.like(pattern), label)
    return result.otherwise(default)
