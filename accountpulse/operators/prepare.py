"""Exports to one row per company and week (or per week, for sign-ups).

Plan, status and app labels stay long in ``connect_long``, ``kyc_long`` and ``marketplace_long``. A wide
frame of few labels is one aggregation with a sum per label. With more labels, rows are dealt by
company and week once, summed by name there, and the columns are taken from a map of the
sums, so that neither aggregation buffers nor code grow with the labels. Both give the same
columns, and their number has no limit.

``checked`` is set for exports whose cells were counted while they were written.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import REPORTED_TYPES, clean_token, fold_conversation_type, slug
from ..functions.weeks import WEEK
from ..sources.contracts import HIL_GOV_METRICS, KYC_STAGES, SIGNUP_METRICS, with_contract
from .clean import attach_company, connect_plan_label, drop_invalid_installs, to_numeric_fill0, typed_export
from .clean import with_company_key
from .weekly import UNKNOWN_PLAN

KEYS = ["companyId", WEEK]
#: Up to so many labels one aggregation has a sum for each; more go through a map. No label is left out.
FEW_LABELS = 200


def few(labels: Sequence[object]) -> bool:
    """Whether one aggregation with a sum per label is the shorter way; the result is the same."""
    return len(labels) <= FEW_LABELS


def labels_of(df: DataFrame, *labels: str) -> list[tuple]:
    """Distinct labels in order. They are the wide frame's columns, so the driver must know them."""
    return sorted(map(tuple, df.select(*labels).distinct().collect()))


def grouped_labels(pairs: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    """Labels per column name, in name order; labels with the same name share a column."""
    columns: dict[str, list[str]] = {}
    for name, label in sorted(pairs):
        columns.setdefault(name, []).append(label)
    return columns


def by_key(df: DataFrame) -> DataFrame:
    """Rows dealt by company and week once, so that groupings within a key need no further shuffle."""
    return df.repartition(*KEYS)


def columns_of(sums: DataFrame, *more: Column) -> DataFrame:
    """One row per key with a map of its ``name`` and ``value`` rows, of which a name has one."""
    cells = F.collect_list(F.struct("name", "value"))
    return sums.groupBy(*KEYS).agg(F.map_from_entries(cells).alias("columns"), *more)


def spread(sums: str, names: Iterable[str] | Mapping[str, str]) -> list[Column]:
    """One 0-filled column per name, from a map column; a mapping names each column's entry."""
    entries = names if isinstance(names, Mapping) else {name: name for name in names}
    return [F.coalesce(F.try_element_at(sums, F.lit(entry)), F.lit(0)).alias(name) for name, entry in entries.items()]


def conditional_sums(value: str, conditions: Mapping[str, Column]) -> list[Column]:
    """One 0-filled sum per column name, over the rows that meet its condition."""
    return [F.coalesce(F.sum(F.when(c, F.col(value))), F.lit(0)).alias(name) for name, c in conditions.items()]


def prepare_workflow(df: DataFrame, checked: bool = False) -> DataFrame:
    """Executions per company and week, with the first name in name order (missing first)."""
    named = df if "companyName" in df.columns else df.withColumn("companyName", F.lit(None).cast("string"))
    rows = with_company_key(typed_export(named, ["execution_count"], "workflow", checked=checked))
    # Few names share a company and week; a set of them is hashed, where a least text would sort all rows.
    unnamed = F.max(F.col("companyName").isNull())
    return rows.groupBy(*KEYS).agg(
        F.when(unnamed, "Unknown").otherwise(F.array_min(F.collect_set("companyName"))).alias("companyName"),
        F.sum("execution_count").alias("execution_count"),
    )


def prepare_dau(df: DataFrame, checked: bool = False) -> DataFrame:
    metrics = ["dau_count", "unique_users_count"]
    rows = with_company_key(typed_export(df, metrics, "dau", checked=checked))
    return rows.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in metrics])


def prepare_billing(df: DataFrame, checked: bool = False) -> DataFrame:
    """Billable events in one column per reported conversation type."""
    rows = with_company_key(typed_export(df, ["billable_count"], "billing", ["conversationType"], checked))
    typed = rows.withColumn("conversationType", fold_conversation_type(F.col("conversationType")))
    conditions = {t: F.col("conversationType") == t for t in REPORTED_TYPES}
    return (
        typed.where(F.col("conversationType").isNotNull())
        .groupBy(*KEYS)
        .agg(*conditional_sums("billable_count", conditions))
    )


def _labelled_licences(df: DataFrame, checked: bool = False) -> tuple[DataFrame, Column | None]:
    rows = with_company_key(typed_export(df, ["connect_licenses"], "connect", checked=checked))
    return rows, connect_plan_label(rows)


def _plan_column(plan: Column) -> Column:
    return F.concat(F.lit("connect_plan_"), slug(plan, "unknown_plan"))


def connect_long(df: DataFrame) -> DataFrame:
    """Licences per company, week and plan label, with the plan's column name."""
    rows, label = _labelled_licences(df)
    named = rows.withColumn("plan", F.lit(UNKNOWN_PLAN) if label is None else label)
    sums = named.groupBy(*KEYS, "plan").agg(F.sum("connect_licenses").alias("connect_licenses"))
    return sums.withColumn("connect_col", _plan_column(F.col("plan")))


def prepare_connect(df: DataFrame, checked: bool = False) -> DataFrame:
    """Licences in one column per plan, their total, and the list of plans in use.

    Labels that fall on the same column name are summed. Without any label column there
    is only the total.
    """
    rows, label = _labelled_licences(df, checked)
    if label is None:
        return rows.groupBy(*KEYS).agg(F.sum("connect_licenses").alias("connect_licenses"))

    named = rows.withColumn("plan", label)
    plans_by_column = grouped_labels(labels_of(named.select("plan").distinct().select(_plan_column(F.col("plan")).alias("name"), "plan"), "name", "plan"))
    names = list(plans_by_column)
    plans = sorted(plan for same in plans_by_column.values() for plan in same)
    if few(plans):
        held = {plan: F.col(f"__{i}") for i, plan in enumerate(plans)}
        sums = named.groupBy(*KEYS).agg(
            *conditional_sums("connect_licenses", {f"__{i}": F.col("plan") == x for i, x in enumerate(plans)})
        )
        return sums.select(
            *KEYS,
            *[reduce(add, (held[x] for x in same)).alias(name) for name, same in plans_by_column.items()],
            reduce(add, held.values(), F.lit(0).cast(sums.schema["__0"].dataType if plans else "bigint")).alias("connect_licenses"),
            F.concat_ws(", ", *[F.when(held[x] > 0, x) for x in plans]).alias("connect_plan_list"),
        )
    per_plan = by_key(named).groupBy(*KEYS, "plan").agg(F.sum("connect_licenses").alias("value"))
    per_column = per_plan.groupBy(*KEYS, _plan_column(F.col("plan")).alias("name")).agg(
        F.sum("value").alias("value"), F.collect_list(F.when(F.col("value") > 0, F.col("plan"))).alias("plans")
    )
    used = F.array_sort(F.flatten(F.collect_list("plans")))
    grouped = columns_of(per_column, F.sum("value").alias("connect_licenses"), used.alias("plans"))
    return grouped.select(
        *KEYS, *spread("columns", names), "connect_licenses", F.array_join("plans", ", ").alias("connect_plan_list")
    )


def _kyc_rows(df: DataFrame, checked: bool = False) -> DataFrame:
    """Rows with a clean stage and status and the names of their two columns."""
    rows = with_company_key(typed_export(df, ["kyc_steps_count"], "kyc", ["stepName", "status"], checked))
    tokens = rows.withColumns({c: clean_token(F.col(c)) for c in ("stepName", "status")})
    stage = F.concat(F.lit("kyc_"), slug(F.col("stepName"), "unknown"))
    return tokens.where(F.col("stepName").isNotNull() & F.col("status").isNotNull()).withColumns(
        {
            "status_column": F.concat(stage, F.lit("_"), slug(F.col("status"), "unknown")),
            "stage_column": F.concat(stage, F.lit("_total")),
        }
    )


def kyc_long(df: DataFrame) -> DataFrame:
    """Steps per company, week, stage and status, with the column name of the two as it is joined."""
    sums = _kyc_rows(df).groupBy(*KEYS, "stepName", "status", F.col("status_column").alias("kyc_col"))
    return sums.agg(F.sum("kyc_steps_count").alias("kyc_steps_count"))


def kyc_columns(labels: Iterable[tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """Wide columns in name order, each with the kind (``stage`` or ``status``) and name of its cells.

    ``labels`` are pairs of a status column's and a stage column's joined name. A stage's total keeps
    its name. A status column that would have the name of some stage's total is called the same with
    ``_status`` behind it. Pairs of stage and status with the same joined name share a column.
    """
    statuses, stages = ({names[i] for names in labels} for i in (0, 1))
    stages |= {f"kyc_{s}_total" for s in KYC_STAGES}
    columns = {name: ("stage", name) for name in stages}
    for name in sorted(statuses):
        free = name
        while free in columns or free != name and free in statuses:
            free += "_status"
        columns[free] = ("status", name)
    return dict(sorted(columns.items()))


def prepare_kyc(df: DataFrame, checked: bool = False) -> DataFrame:
    """Steps by stage and status, by stage, and in total, from one grouped pass.

    The three totals per stage and the grand total exist even when the data has none. ``kyc_columns``
    tells what happens to names that meet; every step is counted in one status column and one total.
    """
    rows = _kyc_rows(df, checked)
    columns = kyc_columns(set(labels_of(rows, "status_column", "stage_column")))
    if few(columns):
        conditions = {name: F.col(f"{kind}_column") == cell for name, (kind, cell) in columns.items()}
        total = F.sum("kyc_steps_count").alias("kyc_total")
        return rows.groupBy(*KEYS).agg(*conditional_sums("kyc_steps_count", conditions), total)
    both = F.array(*[F.concat(F.lit(f"{kind}:"), f"{kind}_column") for kind in ("stage", "status")])
    cells = by_key(rows.select(*KEYS, "kyc_steps_count", "status_column", "stage_column"))
    cells = cells.select(*KEYS, "kyc_steps_count", F.explode(both).alias("name"))
    sums = cells.groupBy(*KEYS, "name").agg(F.sum("kyc_steps_count").alias("value"))
    in_stage = F.startswith(F.col("name"), F.lit("stage:"))
    grouped = columns_of(sums, F.sum(F.when(in_stage, F.col("value"))).alias("kyc_total"))
    return grouped.select(*KEYS, *spread("columns", {n: ":".join(cell) for n, cell in columns.items()}), "kyc_total")


def prepare_hil_gov(df: DataFrame, checked: bool = False) -> DataFrame:
    """Government and human-review metrics; unreadable or absent numbers count as 0."""
    full = with_contract(df, HIL_GOV_METRICS)
    rows = with_company_key(typed_export(to_numeric_fill0(full, HIL_GOV_METRICS), [], "hil_gov", checked=checked))
    return rows.groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in HIL_GOV_METRICS])


def marketplace_long(installs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Installations per company, week and app, with the column name of the app.

    Events are counted per user, week and app before the join with the user mapping, so
    the join shuffles counts, and a user with very many installs stays small.
    """
    per_user = (
        drop_invalid_installs(installs)
        .groupBy("mapping_user_id", WEEK, "app_name")
        .agg(F.count("*").alias("marketplace_install_count"))
    )
    return (
        attach_company(per_user, mapping)
        .groupBy(*KEYS, "app_name")
        .agg(F.sum("marketplace_install_count").alias("marketplace_install_count"))
        .withColumn("marketplace_col", F.concat(F.lit("marketplace_app_"), slug(F.col("app_name"), "unknown_app")))
    )


def marketplace_wide(long: DataFrame, checked: bool = False) -> DataFrame:
    """One column per app and their total. Apps with the same column name are summed."""
    rows = with_company_key(typed_export(long, ["marketplace_install_count"], "marketplace", ["app_name"], checked))
    column = F.concat(F.lit("marketplace_app_"), slug(F.col("app_name"), "unknown_app"))
    apps = grouped_labels(labels_of(rows.select("app_name").distinct().select(column.alias("name"), "app_name"), "name", "app_name"))
    names = list(apps)
    if few(names):
        return rows.groupBy(*KEYS).agg(
            *conditional_sums("marketplace_install_count", {n: F.col("app_name").isin(same) for n, same in apps.items()}),
            F.sum("marketplace_install_count").alias("marketplace_install_total"),
        )
    sums = by_key(rows).groupBy(*KEYS, column.alias("name")).agg(F.sum("marketplace_install_count").alias("value"))
    grouped = columns_of(sums, F.sum("value").alias("marketplace_install_total"))
    return grouped.select(*KEYS, *spread("columns", names), "marketplace_install_total")


def prepare_signups(df: DataFrame, checked: bool = False) -> DataFrame:
    rows = typed_export(df, SIGNUP_METRICS, "signups", checked=checked)
    return rows.groupBy(WEEK).agg(*[F.sum(m).alias(m) for m in SIGNUP_METRICS])
