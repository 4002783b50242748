"""Analyses on company rows of a period: KPIs, series, rankings, distributions, changes.

``df`` holds company rows at weekly or monthly grain, ``period`` names its period column.
Rankings are a filter and a top-k, which Spark runs as a bounded heap per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import series_label
from ..functions.numbers import parsed_or_zero, pct_change, rate_pct
from ..functions.text import company_order
from ..sources.contracts import HIL_GOV_METRICS, HIL_STEPS, SIGNUP_METRICS, require_columns
from ..sources.staging import stage
from .period import at_period, metric_columns
from .quantiles import exact_quantiles

# --- Fixed values -----------------------------------------------------------
# Upper end of the histogram of each metric; companies above it are counted apart.
HISTOGRAM_THRESHOLDS = {
    "execution_count": 100000,
    "MARKETING": 100000,
    "UTILITY": 50000,
    "AUTHENTICATION": 50000,
    "dau_count": 10000,
    "unique_users_count": 5000,
    "connect_licenses": 200,
}
DEFAULT_THRESHOLD = 100000
OVERVIEW_METRICS = (
    "execution_count",
    "dau_count",
    "connect_licenses",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "signups",
    "other_plans",
)
TOP_COLUMNS = (
    "companyId",
    "companyName",
    "execution_count",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "dau_count",
    "connect_licenses",
    "marketplace_install_total",
    "connect_plan_list",
)
SNAPSHOT_METRICS = (
    "execution_count",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "dau_count",
    "unique_users_count",
    "connect_licenses",
    "marketplace_install_total",
)
HISTORY_METRICS = (
    "execution_count",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "dau_count",
    "unique_users_count",
    "connect_licenses",
)
HIL_LABELS = {"doccheck": "Document Check", "liveness": "Liveness", "facematch": "Facematch"}
# ----------------------------------------------------------------------------


def _one_type(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as whole numbers, or with fractions where one of them may have some."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    return [F.col(c).cast("bigint" if whole else "double").alias(c) for c in columns]


def threshold_of(metric: str) -> int:
    return HISTOGRAM_THRESHOLDS.get(metric, DEFAULT_THRESHOLD)


# --- Overview ---------------------------------------------------------------


def overview_row(totals: DataFrame, companies: DataFrame, period: str, value: date | None = None) -> DataFrame:
    """Portfolio KPIs of one period and the number of companies with a row in it."""
    metrics = [m for m in OVERVIEW_METRICS if m in totals.columns]
    active = (
        at_period(companies, period, value).groupBy(period).agg(F.count_distinct("companyId").alias("active_companies"))
    )
    return at_period(totals, period, value).select(period, *metrics).join(active, period)


def metric_series(
    df: DataFrame,
    family: str | Sequence[str],
    period: str,
    keys: Sequence[str] = (),
    metrics: Sequence[str] | None = None,
) -> DataFrame:
    """Long form of one metric family, or of several, for stacked charts, with display labels.

    On totals ``keys`` is empty; on company rows it names the company. Apps without any
    installation in the whole series are left out. The table is read once for all families, and a
    wide row's cells are taken from an array of them, so that long rows aren't shuffled by key.
    """
    families = [family] if isinstance(family, str) else list(family)
    cells = {c: f for f in families for c in (metrics if metrics is not None else metric_columns(df.columns, f))}
    rows = df.select(*keys, period, *_one_type(df, list(cells)))
    apps = [c for c, f in cells.items() if f == "app"]
    if apps and keys:
        # One row of flags per key tells the apps in use before anything is spread to long form.
        used = rows.groupBy(*keys).agg(F.array(*[F.coalesce(F.sum(c) > 0, F.lit(False)) for c in apps]).alias("__used"))
        rows = rows.join(used, [*keys])

    def cell(column: str, kind: str) -> Column:
        shown = F.col("__used")[apps.index(column)] if keys and kind == "app" else F.lit(True)
        plain = kind if kind not in ("message", "metric") else "plain"
        label = series_label(F.lit(column), plain)
        return F.struct(F.lit(column).alias("series"), F.col(column).alias("value"), label.alias("label"), shown.alias("shown"))

    entries = F.filter(F.array(*[cell(c, f) for c, f in cells.items()]), lambda x: x["shown"])
    long = rows.select(*keys, period, F.inline(entries)).drop("shown")
    if apps and not keys:
        # Without a key there is one row per calendar period, so the series are few and short.
        whole = Window.partitionBy("series")
        total = F.when(F.col("series").isin(apps), F.sum("value").over(whole)).otherwise(1)
        long = long.withColumn("__total", total).where("__total > 0").drop("__total")
    return long


def top_companies(df: DataFrame, period: str, value: date | None = None, n: int = 10) -> DataFrame:
    """Companies with most executions; ties go to the lower company id."""
    columns = [c for c in TOP_COLUMNS if c in df.columns]
    return _top(at_period(df, period, value), F.col("execution_count").desc_nulls_last(), n).select(*columns)


def _top(df: DataFrame, order: Column, n: int) -> DataFrame:
    return df.orderBy(order, *company_order()).limit(n)


# --- One company ------------------------------------------------------------


def company_directory(df: DataFrame, period: str) -> DataFrame:
    """Every company once, with its earliest name, in name order."""
    named = df.where(F.col("companyName").isNotNull())
    firsts = named.groupBy("companyId").agg(F.min_by("companyName", period).alias("companyName"))
    return firsts.orderBy("companyName", *company_order())


def company_history(changed: DataFrame, company_id: str, period: str) -> DataFrame:
    """All periods of one company, metrics with their changes, rounded to two digits."""
    metrics = [
        *HISTORY_METRICS,
        *[c for c in (*metric_columns(changed.columns, "stage"), "kyc_total") if c in changed.columns],
        *HIL_GOV_METRICS,
    ]
    columns = [c for m in metrics for c in (m, f"{m}_wow") if c in changed.columns]
    if "connect_plan_list" in changed.columns:
        columns.append("connect_plan_list")
    rounded = [F.bround(c, 2).alias(c) if c.endswith("_wow") else F.col(c) for c in columns]
    return changed.where(F.col("companyId") == company_id).select(period, *rounded).orderBy(period)


def company_snapshot(
    df: DataFrame,
    period: str,
    value: date | None = None,
    company_id: str | None = None,
    metrics: Sequence[str] = SNAPSHOT_METRICS,
) -> DataFrame:
    """Newest row of a company beside its row of a chosen period, or the newest again.

    Works for one company or for all of them. An aggregate of dates finds the two periods; their values
    then come by a lookup, with the newest value before each for its change. Both are hash aggregates
    of numbers: no row is sorted, and changes are taken for the two rows that are shown, not for the
    whole history. A table that has its changes already gives those.
    """
    rows = df if company_id is None else df.where(F.col("companyId") == company_id)
    metrics = [m for m in metrics if m in df.columns]
    given = [f"{m}_wow" for m in metrics if f"{m}_wow" in df.columns]
    day, latest, selected = F.col(period), F.col("__latest"), F.col("__selected")
    newest = F.max(day)
    chosen = newest if value is None else F.coalesce(F.max(F.when(day == F.lit(value), day)), newest)
    dates = rows.groupBy("companyId").agg(newest.alias("__latest"), chosen.alias("__selected"))
    sides = {"latest": latest, "selected": selected}
    shown = {f"{side}_{c}": F.max(F.when(day == at, F.col(c))) for side, at in sides.items() for c in (*metrics, *given)}
    before = {
        f"__{side}_{m}": F.max_by(m, F.when(day < at, day)) for side, at in sides.items() for m in metrics if f"{m}_wow" not in given
    }
    slim = rows.select("companyId", period, *metrics, *given)
    found = slim.join(dates, "companyId").groupBy("companyId", "__latest", "__selected").agg(
        *[c.alias(name) for name, c in {**shown, **before}.items()]
    )

    def column(side: str, name: str) -> Column:
        metric = name.removesuffix("_wow")
        if name in metrics or name in given:
            return F.col(f"{side}_{name}")
        return pct_change(F.col(f"{side}_{metric}"), F.col(f"__{side}_{metric}")).alias(f"{side}_{name}")

    return found.select(
        "companyId",
        *[
            c
            for side, at in sides.items()
            for c in (at.alias(f"{side}_period"), *[column(side, n) for m in metrics for n in (m, f"{m}_wow")])
        ],
    )


def _selected_rows(df: DataFrame, period: str, value: date | None) -> DataFrame:
    """Per company its row of the period, else its newest row.

    The period is found by an aggregate of dates alone; the row then comes by an equality join.
    """
    newest = F.max(period)
    chosen = newest if value is None else F.coalesce(F.max(F.when(F.col(period) == F.lit(value), F.col(period))), newest)
    picked = df.groupBy("companyId").agg(chosen.alias(period))
    return df.join(picked, ["companyId", period]).select(df.columns)


def active_items(
    df: DataFrame, period: str, family: str, value: date | None = None, company_id: str | None = None
) -> DataFrame:
    """Plans or apps in use: non-zero columns of the company's selected row, largest first."""
    rows = df if company_id is None else df.where(F.col("companyId") == company_id)
    columns = metric_columns(df.columns, family)
    slim = rows.select("companyId", period, *columns)
    items = (
        _selected_rows(slim, period, value)
        .select("companyId", period, *_one_type(slim, columns))
        .unpivot(["companyId", period], columns, "item", "value")
        .where("value > 0")
    )
    return items.withColumn("label", series_label(F.col("item"), family)).orderBy(
        *company_order(), F.desc("value"), "item"
    )


def kyc_status_detail(
    df: DataFrame, period: str, value: date | None = None, company_id: str | None = None
) -> DataFrame:
    """Non-zero counts per verification stage and status of the selected row."""
    return active_items(df, period, "status", value, company_id)


# --- Government and human review --------------------------------------------


def gov_hil_rates(df: DataFrame, period: str) -> DataFrame:
    """Government answers and human-review shares per company row; 0 over 0 is 0."""
    require_columns(df, HIL_GOV_METRICS, "gov_hil")
    base = df.withColumns({m: parsed_or_zero(df, m) for m in HIL_GOV_METRICS})
    reviewed = sum((F.col(f"hil_{s}_total") for s in HIL_STEPS), F.lit(0))
    with_totals = base.withColumns(
        {"gov_total_queries": F.col("gov_validated") + F.col("gov_not_validated"), "hil_total_steps": reviewed}
    )
    denominator = F.col("kyc_total") if "kyc_total" in df.columns else F.col("hil_total_steps")
    rates = {
        "gov_validation_rate_pct": rate_pct(F.col("gov_validated"), F.col("gov_total_queries")),
        "hil_derivation_pct": rate_pct(F.col("hil_total_steps"), denominator),
    }
    for step in HIL_STEPS:
        whole = F.col(f"hil_{step}_total")
        rates[f"hil_{step}_approval_rate_pct"] = rate_pct(F.col(f"hil_{step}_approved"), whole)
        rates[f"hil_{step}_disapproval_rate_pct"] = rate_pct(F.col(f"hil_{step}_disapproved"), whole)
    return with_totals.withColumns(rates).select(
        "companyId", period, *HIL_GOV_METRICS, "gov_total_queries", "hil_total_steps", *rates
    )


def gov_hil_delta(df: DataFrame, period: str) -> DataFrame:
    """Rates with their absolute difference to the company's previous row, NULL on the first."""
    previous = Window.partitionBy("companyId").orderBy(period)
    shown = ["gov_validation_rate_pct", "hil_derivation_pct", "hil_total_steps"]
    return gov_hil_rates(df, period).select(
        "companyId",
        period,
        *[c for m in shown for c in (m, (F.col(m) - F.lag(m).over(previous)).alias(f"{m}_delta"))],
    )


def hil_breakdown(
    df: DataFrame, period: str, value: date | None = None, company_id: str | None = None
) -> DataFrame:
    """Three rows per company: reviewed, approved and disapproved steps with their rates."""
    rows = df if company_id is None else df.where(F.col("companyId") == company_id)
    needed = [c for c in ("kyc_total",) if c in df.columns]
    slim = require_columns(rows, HIL_GOV_METRICS, "gov_hil").select("companyId", period, *HIL_GOV_METRICS, *needed)
    rates = gov_hil_rates(_selected_rows(slim, period, value), period)
    steps = F.array(
        *[
            F.struct(
                F.lit(label).alias("step"),
                F.col(f"hil_{s}_total").cast("bigint").alias("hil_total"),
                F.col(f"hil_{s}_approved").cast("bigint").alias("approved"),
                F.col(f"hil_{s}_disapproved").cast("bigint").alias("disapproved"),
                F.bround(f"hil_{s}_approval_rate_pct", 2).alias("approval_pct"),
                F.bround(f"hil_{s}_disapproval_rate_pct", 2).alias("disapproval_pct"),
            )
            for s, label in HIL_LABELS.items()
        ]
    )
    return rates.select("companyId", period, F.inline(steps))


# --- Distributions ----------------------------------------------------------


def distribution_histogram(
    df: DataFrame, period: str, metric: str, value: date | None = None, threshold: int | None = None, bins: int = 50
) -> DataFrame:
    """Companies per fixed-width bin of ``[0, threshold]``, and one open bin above it.

    The last bin includes the threshold. Values below zero get bin 0.
    """
    limit = threshold_of(metric) if threshold is None else threshold
    width = limit / bins
    rows = at_period(df, period, value).where(F.col(metric).isNotNull())
    v = F.col(metric).cast("double")
    number = F.when(v > limit, bins + 1).otherwise(
        F.least(F.lit(bins), F.width_bucket(v, F.lit(0.0), F.lit(float(limit)), F.lit(bins)))
    )
    counted = rows.groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("companies"))
    inside = F.col("bin").between(1, bins)
    return counted.select(
        "bin",
        F.when(inside, (F.col("bin") - 1) * width).when(F.col("bin") > bins, float(limit)).alias("bin_start"),
        F.when(inside, F.col("bin") * width).when(F.col("bin") < 1, 0.0).alias("bin_end"),
        "companies",
    )


def distribution_stats(df: DataFrame, period: str, metric: str, value: date | None = None) -> DataFrame:
    """Companies, mean, median, sample deviation, minimum and maximum of a metric.

    Mean and deviation are plain aggregates of the rows; the median is selected without sorting
    them all.
    """
    rows = at_period(df, period, value).where(F.col(metric).isNotNull())
    v = F.col(metric)
    sums = rows.agg(
        F.count(F.lit(1)).alias("companies"),
        F.avg(v.cast("double")).alias("mean"),
        F.stddev_samp(v.cast("double")).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    median = exact_quantiles(rows, metric, [0.5]).select(F.col("q")[0])
    return sums.withColumn("median", median.scalar()).select("companies", "mean", "median", "std", "min", "max")


def distribution_box(df: DataFrame, period: str, metric: str, value: date | None = None) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and the number of companies outside."""
    rows = at_period(df, period, value).where(F.col(metric).isNotNull()).select(F.col(metric).alias("v"))
    quartiles = exact_quantiles(rows, "v", [0.25, 0.5, 0.75]).select("q").scalar()
    fenced = rows.withColumn("q", quartiles)
    q1, q3 = F.col("q")[0], F.col("q")[2]
    inside = F.col("v").between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return fenced.groupBy(q1.alias("q1"), F.col("q")[1].alias("median"), q3.alias("q3")).agg(
        F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )


def power_users(
    df: DataFrame, period: str, metric: str, value: date | None = None, threshold: int | None = None, n: int = 10
) -> DataFrame:
    """Largest companies above the threshold of the metric."""
    limit = threshold_of(metric) if threshold is None else threshold
    rows = at_period(df, period, value).where(F.col(metric) > limit)
    return _top(rows, F.desc(metric), n).select("companyId", "companyName", metric)


def normal_top(
    df: DataFrame, period: str, metric: str, value: date | None = None, threshold: int | None = None, n: int = 15
) -> DataFrame:
    """Largest companies at or below the threshold of the metric."""
    limit = threshold_of(metric) if threshold is None else threshold
    rows = at_period(df, period, value).where(F.col(metric) <= limit)
    return _top(rows, F.desc(metric), n).select("companyId", "companyName", metric)


# --- Changes ----------------------------------------------------------------


def _reject_signups(metric: str) -> None:
    if metric in SIGNUP_METRICS:
        raise ValueError(f"{metric} is a portfolio metric; it has no change per company.")


def changes_at(df: DataFrame, period: str, metric: str, value: date | None = None) -> DataFrame:
    """Company rows of one period with the change of a metric against the company's row before.

    The newest earlier value is a hash aggregate of two numbers, and rows after the period are never
    read. A table that has its changes already gives those.
    """
    _reject_signups(metric)
    change = f"{metric}_wow"
    now = at_period(df, period, value)
    if change in df.columns:
        return now.select("companyId", "companyName", metric, change)
    limit = F.lit(value) if value is not None else df.select(F.max(period)).scalar()
    before = df.where(F.col(period) < limit).groupBy("companyId").agg(F.max_by(metric, period).alias("__before"))
    rows = now.select("companyId", "companyName", metric).join(before, "companyId", "left")
    return rows.withColumn(change, pct_change(F.col(metric), F.col("__before"))).drop("__before")


def change_scatter(df: DataFrame, period: str, metric: str, value: date | None = None) -> DataFrame:
    """Companies with a value and a change in the period, marked as declining or growing."""
    change = F.col(f"{metric}_wow")
    rows = changes_at(df, period, metric, value).where(F.col(metric).isNotNull() & change.isNotNull())
    return rows.withColumn("status", F.when(change < 0, "Declining").otherwise("Growing"))


def big_decliners(
    df: DataFrame, period: str, metric: str, value: date | None = None, n: int = 15
) -> DataFrame:
    """Companies above the median of the scatter that lost most, rounded to two digits."""
    # The period's rows are written once, with four columns, and read for the median and the ranking.
    scatter = stage(change_scatter(df, period, metric, value), "scatter")
    median = F.lit(exact_quantiles(scatter, metric, [0.5]).first()["q"][0]).cast("double")
    change = f"{metric}_wow"
    losing = scatter.where((F.col(metric) > median) & (F.col(change) < 0))
    return _rounded(_top(losing, F.asc(change), n), metric)


def top_gainers(df: DataFrame, period: str, metric: str, value: date | None = None, n: int = 10) -> DataFrame:
    """Largest changes; infinite ones first, companies without a change only fill up."""
    rows = changes_at(df, period, metric, value)
    return _rounded(_top(rows, F.desc_nulls_last(f"{metric}_wow"), n), metric)


def top_decliners(df: DataFrame, period: str, metric: str, value: date | None = None, n: int = 10) -> DataFrame:
    """Smallest changes; companies without a change only fill up."""
    rows = changes_at(df, period, metric, value)
    return _rounded(_top(rows, F.asc_nulls_last(f"{metric}_wow"), n), metric)


def _rounded(df: DataFrame, metric: str) -> DataFrame:
    change = f"{metric}_wow"
    return df.select("companyId", "companyName", metric, F.bround(change, 2).alias(change))
