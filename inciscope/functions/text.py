"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inciscope import config


def is_blank(col: Column) -> Column:
    """True for NULL, empty and all-space text; never NULL itself."""
    return F.coalesce(F.trim(col), F.lit("")) == ""


def standardise(col: Column) -> Column:
    return F.upper(F.trim(col))


def parse_flag(col: Column) -> Column:
    """'true'/'false' in any case and padding; every other text is NULL."""
    word = F.lower(F.trim(col))
    return F.when(word == "true", True).when(word == "false", False)


def is_bad_flag(col: Column) -> Column:
    """Present, but neither true nor false."""
    return ~is_blank(col) & parse_flag(col).isNull()


def pad_code(col: Column, width: int, fill: str = "0") -> Column:
    return F.lpad(F.trim(col), width, fill)


INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")
INTEGER_TEXT = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"


def cast_or_null(col: Column, data_type: str) -> Column:
    """``try_cast`` of text that does not raise and catch an error for each non-integer.

    Columns such as "1.0" fail an integer cast on every row, so text without integer form skips the attempt.
    """
    attempt = col.try_cast(data_type)
    return F.when(col.rlike(INTEGER_TEXT), attempt) if data_type in INTEGER_TYPES else attempt


def numeric_text_to_int(col: Column) -> Column:
    """Integers stored as decimal text ("1.0"); a direct cast to int would give NULL."""
    return F.trim(col).try_cast("double").try_cast("int")


def is_uncastable(col: Column, data_type: str) -> Column:
    """Present, but not convertible to ``data_type``."""
    return ~is_blank(col) & cast_or_null(col, data_type).isNull()


def coordinate_from_text(col: Column, pattern: str) -> Column:
    """First group of ``pattern`` as a double; no match extracts '' which casts to NULL."""
    return F.regexp_extract(F.trim(col), pattern, 1).try_cast("double")


def latitude_from_text(col: Column) -> Column:
    return coordinate_from_text(col, config.LATITUDE_PATTERN)


def longitude_from_text(col: Column) -> Column:
    return coordinate_from_text(col, config.LONGITUDE_PATTERN)
