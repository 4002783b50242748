"""Checks and summaries of exports and of the merged table."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import ValidationError
from ..functions.weeks import WEEK
from ..sources.staging import stage_observed
from .clean import reject_cells, strict_cells


@dataclass(frozen=True)
class Profile:
    """What the job that wrote an export saw of it."""

    rows: int
    first_week: date | None
    last_week: date | None


def stage_strict(df: DataFrame, metrics: Sequence[str], source: str) -> tuple[DataFrame, Profile]:
    """Write an export with its week and metrics typed, and return it with its profile.

    Rows, first and last week and unreadable cells are counted by the write itself; the table isn't
    read again. Any unreadable cell rejects the export.
    """
    cells = strict_cells(df, metrics)
    bad = {f"bad_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(cells)}
    measures = {"rows": F.count(F.lit(1)), "first_week": F.min(WEEK), "last_week": F.max(WEEK), **bad}
    written, seen = stage_observed(df.withColumns(cells), source, measures)
    reject_cells({c: seen[f"bad_{i}"] for i, c in enumerate(cells)}, source)
    return written, Profile(seen["rows"], seen["first_week"], seen["last_week"])


def grain_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key that another row already has."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def check_grain(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """Return ``df`` unchanged, or fail with the number of duplicate rows."""
    duplicates = grain_duplicates(df, keys).first()["duplicate_rows"]
    if duplicates:
        raise ValidationError(f"{source}: {duplicates} rows repeat the key ({', '.join(keys)}) of another")
    return df


def date_windows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """First and last week of every source that has rows."""
    bounds = [
        df.agg(F.min(WEEK).alias("first_week"), F.max(WEEK).alias("last_week")).select(
            F.lit(name).alias("source"), "first_week", "last_week"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, bounds).where(F.col("first_week").isNotNull())


def window_mismatch(windows: DataFrame) -> DataFrame:
    """One row: do the sources disagree on the first or on the last week?"""
    return windows.agg(
        F.count_distinct("first_week").alias("starts"), F.count_distinct("last_week").alias("ends")
    ).select("starts", "ends", ((F.col("starts") > 1) | (F.col("ends") > 1)).alias("mismatch"))


def check_windows(windows: DataFrame, strict: bool = False) -> bool:
    """True when all sources agree. A mismatch warns, or fails when strict."""
    return _windows_agree(not window_mismatch(windows).first()["mismatch"], strict)


def check_profiles(profiles: Mapping[str, Profile], strict: bool = False) -> bool:
    """As ``check_windows``, from the profiles of exports that have rows."""
    weeks = [(p.first_week, p.last_week) for p in profiles.values() if p.first_week is not None]
    return _windows_agree(all(len(set(bounds)) < 2 for bounds in zip(*weeks)), strict)


def _windows_agree(agree: bool, strict: bool) -> bool:
    if agree:
        return True
    message = "Sources do not share the same first and last week."
    if strict:
        raise ValidationError(message)
    warnings.warn(message, stacklevel=2)
    return False


def merge_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, companies, weeks and newest week of a merged table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.count_distinct("companyId").alias("companies"),
        F.count_distinct(WEEK).alias("weeks"),
        F.max(WEEK).alias("latest_week"),
    )
