"""The canonical company-by-week table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..functions.weeks import WEEK, last_closed_sunday
from ..sources.contracts import HIL_GOV_METRICS, KYC_STAGES, SIGNUP_METRICS
from .clean import to_numeric_fill0

KEYS = ["companyId", WEEK]

# --- Fixed values -----------------------------------------------------------
# Metrics that every merged table has, before the columns that depend on the data.
BASE_METRICS = (
    "execution_count",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "dau_count",
    "unique_users_count",
    "connect_licenses",
    "marketplace_install_total",
)
METRIC_PREFIXES = ("connect_plan_", "kyc_", "gov_", "hil_", "marketplace_app_")
TEXT_COLUMNS = ("companyName", "connect_plan_list")
# ----------------------------------------------------------------------------


def company_metrics(columns: Iterable[str]) -> list[str]:
    """Additive company metrics among the columns, in column order."""
    return [
        c
        for c in columns
        if (c in BASE_METRICS or c.startswith(METRIC_PREFIXES)) and c not in TEXT_COLUMNS and not c.endswith("_wow")
    ]


def merge_company_week(frames: Iterable[DataFrame]) -> DataFrame:
    """Full outer merge of prepared frames on company and week.

    Each frame must have one row per key; a second one fails when the result is computed. So stacking
    them and taking the single value of each column per key gives the rows of a chain of full outer
    joins. A chain would shuffle and sort the growing result once per join, because a full outer join
    loses the partitioning of its inputs. Here every frame is hashed on the key by its own
    aggregation and the union keeps that, so the merge adds no shuffle.

    Only numbers are stacked: a text in the grouping would make Spark sort all rows with all their
    columns. Texts are looked up in their own frame afterwards, by a hash join on the partitioning
    that both sides have.
    """
    frames = list(frames)
    seen: set[str] = set()
    for frame in frames:
        shared = sorted(seen & (set(frame.columns) - set(KEYS)))
        if shared:
            raise ValidationError(f"[merge] Columns in more than one frame: {', '.join(shared)}")
        seen |= set(frame.columns) - set(KEYS)
    kept = [f.where(_has_key()) for f in frames]
    texts = [[c for c, kind in f.dtypes if kind == "string" and c not in KEYS] for f in frames]
    marked = [_marked(frame, names, f"__rows_{i}") for i, (frame, names) in enumerate(zip(kept, texts))]
    # The first of the stacked frames gives the union its columns, which keeps Spark from seeing that its
    # shuffle is used twice; so one without texts goes first.
    first_plain = sorted(range(len(frames)), key=lambda i: bool(texts[i]))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [marked[i] for i in first_plain])
    marks = [f"__rows_{i}" for i in range(len(frames))]
    values = [c for c in stacked.columns if c not in (*KEYS, *marks)]
    merged = stacked.groupBy(*KEYS).agg(
        *[F.max(c).alias(c) for c in values], F.greatest(*[F.sum(m) for m in (*marks, marks[0])]).alias("__rows")
    )
    # A second row of a frame for one key would be lost in the maximum, so it ends the job.
    repeated = F.concat(F.lit("merge: a frame has several rows for company "), "companyId", F.lit(", week "), WEEK)
    week = F.when(F.col("__rows") > 1, F.raise_error(repeated).cast("date")).otherwise(F.col(WEEK))
    for frame, names in zip(kept, texts):
        if names:
            used = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in frame.columns if c not in KEYS))
            merged = merged.join(frame.where(used).select(*KEYS, *names).hint("shuffle_hash"), KEYS, "left")
    order = [c for frame in frames for c in frame.columns if c not in KEYS]
    return merged.withColumn(WEEK, week).select(*KEYS, *order)


def _marked(frame: DataFrame, texts: Sequence[str], mark: str) -> DataFrame:
    """Keys and numbers of a frame, and a 1 on every row.

    The 1 is written so that it reads the texts, and stands where they stood. Both uses of the frame
    thus need the same aggregates in the same order, and Spark shuffles it once for both.
    """
    if not texts:
        return frame.withColumn(mark, F.lit(1))
    one = F.when(F.length(F.concat_ws("", *texts)) >= 0, 1).otherwise(0).alias(mark)
    return frame.select([one if c == texts[0] else F.col(c) for c in frame.columns if c not in texts[1:]])


def _has_key():
    return F.col("companyId").isNotNull() & F.col(WEEK).isNotNull()


def attach_signups(df: DataFrame, signups: DataFrame) -> DataFrame:
    """Portfolio sign-ups of the week on every company row; other weeks' sign-ups are lost.

    Sign-ups are aggregated to one row per week, so the broadcast is bounded by the
    calendar and not by the data.
    """
    return df.join(F.broadcast(signups), WEEK, "left")


def closed_weeks(df: DataFrame, as_of: date, include_today: bool = True) -> DataFrame:
    """Weeks that are over on ``as_of``; ``include_today`` counts a Sunday as its own end."""
    return df.where(F.col(WEEK) <= F.lit(last_closed_sunday(as_of, include_today)))


def fill_merged(df: DataFrame) -> DataFrame:
    """Metrics 0, company name ``Unknown`` and plan list empty where nothing was merged."""
    metrics = [*company_metrics(df.columns), *[m for m in SIGNUP_METRICS if m in df.columns]]
    filled = to_numeric_fill0(df, metrics)
    name = F.col("companyName") if "companyName" in df.columns else F.lit(None).cast("string")
    filled = filled.withColumn("companyName", F.coalesce(name, F.lit("Unknown")))
    if "connect_plan_list" in df.columns:
        filled = filled.withColumn("connect_plan_list", F.coalesce("connect_plan_list", F.lit("")))
    return filled


def with_canonical_columns(df: DataFrame) -> DataFrame:
    """Add the columns every merged table has, and bring all columns into canonical order."""
    fixed = [*BASE_METRICS[:-1], "kyc_total", *[f"kyc_{s}_total" for s in KYC_STAGES], *HIL_GOV_METRICS]
    absent = {m: F.lit(0).cast(T.LongType()) for m in [*fixed, BASE_METRICS[-1]] if m not in df.columns}
    if "connect_plan_list" not in df.columns:
        absent["connect_plan_list"] = F.lit("")
    full = df.withColumns(absent) if absent else df
    dynamic = sorted(c for c in full.columns if c not in KEYS)

    def family(prefix: str) -> list[str]:
        return [c for c in dynamic if c.startswith(prefix) and c not in (*fixed, "connect_plan_list")]

    order = [
        "companyId",
        "companyName",
        WEEK,
        *BASE_METRICS[:-1],
        *family("connect_plan_"),
        "connect_plan_list",
        *family("kyc_"),
        *[f"kyc_{s}_total" for s in KYC_STAGES],
        "kyc_total",
        *HIL_GOV_METRICS,
        BASE_METRICS[-1],
        *family("marketplace_app_"),
        *[m for m in SIGNUP_METRICS if m in full.columns],
    ]
    return full.select(*order, *[c for c in full.columns if c not in order])


def merged_table(frames: Iterable[DataFrame], signups: DataFrame, as_of: date, include_today: bool = True) -> DataFrame:
    """Merge, cut off open weeks, attach sign-ups, fill. Unordered: sorting is the sink's."""
    merged = closed_weeks(merge_company_week(frames), as_of, include_today)
    return with_canonical_columns(fill_merged(attach_signups(merged, signups)))
