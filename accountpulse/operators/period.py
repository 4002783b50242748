"""Weekly and monthly rollups of the merged table, and change against the previous period."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..functions.numbers import pct_change
from ..functions.weeks import MONTH, WEEK, month_start
from ..sources.contracts import SIGNUP_METRICS
from ..sources.readers import fractional_columns, typed_column
from .clean import to_numeric_fill0
from .merge import company_metrics

# --- Fixed values -----------------------------------------------------------
STAGE_TOTALS = ("kyc_document_check_total", "kyc_liveness_total", "kyc_facematch_total")
STAGE_PREFIXES = ("kyc_document_check_", "kyc_liveness_", "kyc_facematch_")
MESSAGE_TYPES = ("MARKETING", "UTILITY", "AUTHENTICATION")
# ----------------------------------------------------------------------------


def metric_columns(columns: Sequence[str], family: str) -> list[str]:
    """Columns of one family: message, plan, app, stage or status. Change columns are not metrics."""
    plain = [c for c in columns if not c.endswith("_wow")]
    if family == "message":
        return [c for c in MESSAGE_TYPES if c in plain]
    if family == "plan":
        return sorted(c for c in plain if c.startswith("connect_plan_") and c != "connect_plan_list")
    if family == "app":
        return sorted(c for c in plain if c.startswith("marketplace_app_"))
    staged = [c for c in plain if c.startswith(STAGE_PREFIXES)]
    if family == "stage":
        preferred = [c for c in STAGE_TOTALS if c in plain]
        return preferred or sorted(c for c in staged if c.endswith("_total"))
    if family == "status":
        return sorted(c for c in staged if not c.endswith("_total"))
    raise ValueError(f"Unknown metric family: {family}")


def load_merged(df: DataFrame) -> DataFrame:
    """A merged table as read from a file: week as a date, metrics as numbers, names filled.

    Metrics written as text are whole numbers again, unless some value of theirs has a fraction.
    """
    week = F.col(WEEK)
    if isinstance(df.schema[WEEK].dataType, T.StringType):
        week = F.try_to_timestamp(F.trim(WEEK)).cast("date")
    metrics = [*company_metrics(df.columns), *[m for m in SIGNUP_METRICS if m in df.columns]]
    text = {m: T.LongType() for m in metrics if isinstance(df.schema[m].dataType, T.StringType)}
    whole = text.keys() - set(fractional_columns(df, text))
    typed = df.withColumns({m: typed_column(df, m, T.LongType()) for m in metrics if m in whole})
    loaded = to_numeric_fill0(typed, metrics).withColumn(WEEK, week.cast("date"))
    if "companyName" in loaded.columns:
        loaded = loaded.withColumn("companyName", F.coalesce("companyName", F.lit("Unknown")))
    return loaded


def combine_plan_lists(col: Column | str) -> Column:
    """Aggregate: union of comma-separated labels over a group, trimmed, distinct, sorted."""
    lists = F.collect_set(F.col(col) if isinstance(col, str) else col)
    labels = F.flatten(F.transform(lists, lambda text: F.split(text, ",")))
    trimmed = F.filter(F.transform(labels, lambda label: F.trim(label)), lambda label: label != "")
    return F.array_join(F.array_sort(F.array_distinct(trimmed)), ", ")


def weekly_companies(df: DataFrame) -> DataFrame:
    """Company rows with their plan list in normal form. The week is already the period."""
    if "connect_plan_list" not in df.columns:
        return df
    labels = F.transform(F.split("connect_plan_list", ","), lambda label: F.trim(label))
    distinct = F.array_sort(F.array_distinct(F.filter(labels, lambda label: label != "")))
    return df.withColumn("connect_plan_list", F.coalesce(F.array_join(distinct, ", "), F.lit("")))


def weekly_totals(df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Company metrics summed per week, with the week's sign-ups taken once.

    Every company row of a week carries the same sign-up numbers, so one of them is the
    maximum; no second pass and no join are needed.
    """
    metrics = company_metrics(df.columns) if metrics is None else list(metrics)
    signups = [m for m in SIGNUP_METRICS if m in df.columns]
    return df.groupBy(WEEK).agg(
        *[F.sum(m).alias(m) for m in metrics if m not in signups], *[F.max(m).alias(m) for m in signups]
    )


def monthly_companies(df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Company rows per month of the closing Sunday: sums, earliest name, all plans used."""
    metrics = company_metrics(df.columns) if metrics is None else list(metrics)
    extra = []
    if "companyName" in df.columns:
        first_name = F.min_by("companyName", F.when(F.col("companyName").isNotNull(), F.col(WEEK)))
        extra.append(F.coalesce(first_name, F.lit("Unknown")).alias("companyName"))
    if "connect_plan_list" in df.columns:
        extra.append(combine_plan_lists("connect_plan_list").alias("connect_plan_list"))
    return df.groupBy("companyId", month_start(WEEK).alias(MONTH)).agg(
        *[F.sum(m).alias(m) for m in metrics], *extra
    )


def monthly_totals(df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Portfolio sums per month. Goes through the weekly totals, where sign-ups count once."""
    weeks = weekly_totals(df, metrics)
    return weeks.groupBy(month_start(WEEK).alias(MONTH)).agg(
        *[F.sum(m).alias(m) for m in weeks.columns if m != WEEK]
    )


def company_periods(df: DataFrame, frequency: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """Company rows at the asked frequency, ``weekly`` or ``monthly``."""
    if frequency == "weekly":
        return weekly_companies(df)
    if frequency == "monthly":
        return monthly_companies(df, metrics)
    raise ValueError(f"Unknown frequency: {frequency}")


def period_totals(df: DataFrame, frequency: str, metrics: Sequence[str] | None = None) -> DataFrame:
    if frequency == "weekly":
        return weekly_totals(df, metrics)
    if frequency == "monthly":
        return monthly_totals(df, metrics)
    raise ValueError(f"Unknown frequency: {frequency}")


def period_change(df: DataFrame, metrics: Sequence[str], period: str, key: str = "companyId") -> DataFrame:
    """Add ``<metric>_wow``: percent change against the company's previous observed period.

    A company has at most one row per period, so no window grows with the raw data.
    """
    previous = Window.partitionBy(key).orderBy(period)
    return df.withColumns(
        {f"{m}_wow": pct_change(F.col(m), F.lag(m).over(previous)) for m in metrics if m in df.columns}
    )


def total_change(totals: DataFrame, metric: str, period: str) -> DataFrame:
    """Portfolio value of a metric and its percent change, one row per period.

    The totals have one row per calendar period, so a single window over them is small.
    """
    previous = Window.partitionBy(F.lit(0)).orderBy(period)
    return totals.select(
        period, metric, pct_change(F.col(metric), F.lag(metric).over(previous)).alias("wow_change")
    )


def available_periods(df: DataFrame, period: str) -> DataFrame:
    return df.select(period).where(F.col(period).isNotNull()).distinct()


def latest_period(df: DataFrame, period: str) -> date:
    """Newest period as a value; an empty table has none and fails."""
    newest = df.agg(F.max(period).alias("newest")).first()["newest"]
    if newest is None:
        raise ValidationError("No data available for any period.")
    return newest


def at_period(df: DataFrame, period: str, value: date | None) -> DataFrame:
    """Rows of one period; without a value, of the newest one, found inside the query."""
    if value is not None:
        return df.where(F.col(period) == F.lit(value))
    return df.where(F.col(period) == df.select(F.max(period)).scalar())
