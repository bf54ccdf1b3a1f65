"""Lenient typing. Every helper takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Texts that stand for a missing id.
MISSING_IDS = ["nan", "None", "<NA>"]


def text_id(col: Column) -> Column:
    """Id as trimmed text without a trailing ``.0``; anything missing is ''."""
    text = F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), r"^\s+|\s+$", "")
    text = F.regexp_replace(text, r"\.0$", "")
    return F.when(text.isin(MISSING_IDS), "").otherwise(text)


def number(col: Column) -> Column:
    """Double, 0 where the text is no number."""
    value = col.try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def instant(col: Column) -> Column:
    """Timestamp, null where the text is none."""
    return F.try_to_timestamp(col.cast("string"))


def day(col: Column) -> Column:
    """Calendar day, null where the text is none."""
    return F.to_date(instant(col))


def text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def finite(col: Column) -> Column:
    """0 for null, NaN and both infinities."""
    value = col.cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, 0.0).otherwise(value)


def is_active(status: Column) -> Column:
    return F.upper(F.coalesce(status, F.lit(""))) == "ACTIVE"


def first_value(df: DataFrame, names: list[str]) -> Column:
    """First non-null value among those of ``names`` that ``df`` has."""
    present = [F.col(name) for name in names if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None)


def first_column(columns: list[str], names: list[str]) -> str | None:
    """First of ``names`` that exists, decided when the plan is built."""
    return next((name for name in names if name in columns), None)


def align_features(df: DataFrame, names: list[str]) -> DataFrame:
    """All model columns, finite; columns the frame lacks become 0."""
    ready = {
        name: finite(F.col(name)) if name in df.columns else F.lit(0.0) for name in names
    }
    return df.withColumns(ready)
