"""One entry per operator: ``(spark, folder) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountpulse.functions.labels import series_label
from accountpulse.functions.text import clean_token, fold_conversation_type, normalize_company_id, slug
from accountpulse.functions.weeks import MONTH, WEEK, week_end_sunday
from accountpulse.operators import clean, identity, merge, period, prepare, quality, views, weekly
from accountpulse.plans import pipeline
from accountpulse.plans.pipeline import merge_prepared, prepare_exports
from accountpulse.session import shared_folder
from accountpulse.sources.contracts import EXPORTS, struct_of
from accountpulse.sources.readers import read_optional, read_source, read_with_fallback
from accountpulse.sources.standins import standin, standins
from accountpulse.sources.writers import write_long, write_merged

from .workspace import SETTINGS, export, exports, merged, merged_by_week

START = SETTINGS.start
EVENTS_START = date(2024, 1, 3)
LICENCE_AS_OF = date(2001, 12, 16)
SOME_WEEK = date(1998, 6, 7)
SOME_MONTH = date(1998, 6, 1)
APP_WEEK = date(2024, 1, 14)
SOME_COMPANY = "7"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return list(standins(spark, folder, names).values())


def _temporary(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/out/{name}-{uuid.uuid4().hex}"


# --- Sources and sinks ------------------------------------------------------


@query
def optional_source(spark, folder):
    """The first candidate exists but lacks columns, so the second is read."""
    schema = struct_of("o_orderkey BIGINT, o_orderstatus STRING")
    df = read_optional(spark, folder, ["absent.parquet", "nation.parquet", "orders.parquet"], schema)
    return df.select("o_orderkey", "o_orderstatus")


@query
def licences_with_fallback(spark, folder):
    """The licence query fails while it runs; the earlier export takes its place."""
    earlier = export(spark, folder, "connect")
    failing = earlier.withColumn("connect_licenses", F.raise_error(F.lit("database gone")).cast("bigint"))
    used = read_with_fallback(
        lambda: failing, lambda: earlier, EXPORTS["connect"].required, "connect", allow_fallback=True
    )
    return used.groupBy("companyId", WEEK).agg(F.sum("connect_licenses").alias("connect_licenses"))


@query
def merged_csv_roundtrip(spark, folder):
    """Merged table written as CSV, read back as text and typed again."""
    path = _temporary(spark, "merged") + ".csv"
    write_merged(merged(spark, folder), path)
    loaded = period.load_merged(read_source(spark, "/", ["/absent/merged.csv", path]))
    return loaded.withColumn("connect_plan_list", F.coalesce("connect_plan_list", F.lit("")))


@query
def merged_parquet_by_week(spark, folder):
    """Merged table written as Parquet with a folder per week, and read back."""
    path = _temporary(spark, "merged")
    write_merged(merged(spark, folder), path, "parquet")
    return period.load_merged(read_source(spark, "/", ["/absent/merged", path]))


@query
def marketplace_long_roundtrip(spark, folder):
    path = _temporary(spark, "marketplace_weekly") + ".csv"
    write_long(export(spark, folder, "marketplace"), path)
    return read_source(spark, "/", [path], EXPORTS["marketplace"].struct)


# --- Weekly queries ---------------------------------------------------------


@query
def session_billing_weekly(spark, folder):
    return weekly.session_billing_weekly(*_raw(spark, folder, "billing_events"), START)


@query
def external_companies(spark, folder):
    companies, users = _raw(spark, folder, "companies", "company_users")
    external = weekly.exclude_internal(companies, ["name", "slug", "email"])
    return weekly.exclude_internal_root_users(external, users).select("id", "name", "plan")


@query
def signups_weekly(spark, folder):
    return weekly.signups_weekly(*_raw(spark, folder, "companies", "company_users"), START)


@query
def kyc_steps_weekly(spark, folder):
    return weekly.kyc_steps_weekly(*_raw(spark, folder, "biometric_steps", "biometrics"), START)


@query
def kyc_hil_government_weekly(spark, folder):
    raw = _raw(spark, folder, "biometric_steps", "biometrics", "document_check_steps")
    return weekly.kyc_hil_government_weekly(*raw, START)


@query
def week_calendar(spark, folder):
    """Calendar from the first subscription to the last one that starts."""
    (subscriptions,) = _raw(spark, folder, "subscriptions")
    bounds = subscriptions.agg(
        F.min("current_period_start").alias("start"), F.max("current_period_start").alias("as_of")
    )
    return weekly.week_calendar(bounds)


def _items(spark, folder, as_of):
    raw = _raw(spark, folder, "subscriptions", "subscription_items", "plan_tiers")
    return weekly.connect_items(*raw, SETTINGS.product_id, as_of)


@query
def connect_items(spark, folder):
    return _items(spark, folder, LICENCE_AS_OF)


@query
def connect_licenses_weekly(spark, folder):
    return weekly.connect_licenses_weekly(_items(spark, folder, LICENCE_AS_OF), START, LICENCE_AS_OF)


@query
def marketplace_installations(spark, folder):
    return weekly.marketplace_installations(*_raw(spark, folder, "user_app_installations", "apps"), EVENTS_START)


@query
def workflow_executions_weekly(spark, folder):
    return weekly.workflow_executions_weekly(*_raw(spark, folder, "workflow_logs"), START)


@query
def daily_active_users_weekly(spark, folder):
    return weekly.daily_active_users_weekly(*_raw(spark, folder, "ai_users"), EVENTS_START)


# --- Cleaning ---------------------------------------------------------------


@query
def company_id_forms(spark, folder):
    """Ids written in different ways come to one form."""
    key = F.col("c_custkey").cast("string")
    written = (
        F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(F.col("c_custkey") % 7 == 1, F.concat(key, F.lit(".0")))
        .when(F.col("c_custkey") % 7 == 2, F.concat(F.lit("00"), key))
        .when(F.col("c_custkey") % 7 == 3, F.lit("nan"))
        .when(F.col("c_custkey") % 7 == 4, F.concat(F.lit("ab"), key))
        .when(F.col("c_custkey") % 7 == 5, F.lit("  "))
        .otherwise(F.col("c_name"))
    )
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.select("c_custkey", normalize_company_id(written).alias("companyId"))


@query
def slug_forms(spark, folder):
    """Column names from whole page addresses."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", slug(F.col("url"), "unknown").alias("slug"))


@query
def token_forms(spark, folder):
    """Priorities and event types as clean tokens and reported conversation types."""
    (events,) = _raw(spark, folder, "billing_events")
    padded = F.concat(F.lit(" "), F.lower("conversationType"), F.lit(" "))
    return (
        events.select(
            clean_token(F.col("conversationType")).alias("token"), fold_conversation_type(padded).alias("folded")
        )
        .groupBy("token", "folded")
        .agg(F.count("*").alias("n"))
    )


@query
def lenient_numbers(spark, folder):
    """Free text read as numbers, 0 where it is none."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string")).when(
        F.col("event_id") % 3 == 1, F.col("event_type")
    )
    mixed = events.select("event_id", text.alias("amount"))
    return clean.to_numeric_fill0(mixed, ["amount"])


@query
def strict_export(spark, folder):
    """Dates and amounts written as text pass the strict checks and are typed."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    text = orders.select(
        "o_orderkey",
        F.date_format(week_end_sunday("o_orderdate"), "yyyy-MM-dd").alias(WEEK),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
    )
    return clean.typed_export(text, ["amount"], "orders")


def _installs(spark, folder):
    raw = _raw(spark, folder, "user_app_installations", "apps")
    return clean.drop_invalid_installs(weekly.marketplace_installations(*raw, START))


@query
def install_companies(spark, folder):
    (mapping,) = _raw(spark, folder, "user_company_map")
    attached = clean.attach_company(_installs(spark, folder), mapping)
    return attached.select("installation_id", "mapping_user_id", "companyId", "app_name", WEEK)


@query
def install_match_counts(spark, folder):
    (mapping,) = _raw(spark, folder, "user_company_map")
    return clean.match_counts(_installs(spark, folder), mapping)


# --- Prepare ----------------------------------------------------------------


@query
def workflow_prepared(spark, folder):
    return prepare.prepare_workflow(export(spark, folder, "workflow"))


@query
def dau_prepared(spark, folder):
    return prepare.prepare_dau(export(spark, folder, "dau"))


@query
def billing_pivot(spark, folder):
    return prepare.prepare_billing(export(spark, folder, "billing"))


@query
def connect_wide(spark, folder):
    return prepare.prepare_connect(export(spark, folder, "connect"))


@query
def connect_long(spark, folder):
    return prepare.connect_long(export(spark, folder, "connect"))


@query
def kyc_long(spark, folder):
    return prepare.kyc_long(export(spark, folder, "kyc"))


@query
def connect_total_only(spark, folder):
    """Without a label column there is only the total."""
    bare = export(spark, folder, "connect").drop("plan_tier_name", "plan_tier_display_name")
    return prepare.prepare_connect(bare)


@query
def kyc_wide(spark, folder):
    return prepare.prepare_kyc(export(spark, folder, "kyc"))


@query
def kyc_clashing_names(spark, folder):
    """Stages and statuses whose joined names meet each other and the stages' totals."""
    steps = export(spark, folder, "kyc")
    stage = F.when(F.col("stepName") == "liveness", "a b").otherwise("a")
    status = F.when(F.col("status") == "Approved", "b total").when(F.col("status") == "Fraud", "total").otherwise("x")
    return prepare.prepare_kyc(steps.withColumns({"stepName": stage, "status": status}))


@query
def hil_gov_prepared(spark, folder):
    return prepare.prepare_hil_gov(export(spark, folder, "hil_gov"))


@query
def marketplace_long(spark, folder):
    installs = weekly.marketplace_installations(*_raw(spark, folder, "user_app_installations", "apps"), START)
    return prepare.marketplace_long(installs, *_raw(spark, folder, "user_company_map"))


@query
def marketplace_wide(spark, folder):
    return prepare.marketplace_wide(export(spark, folder, "marketplace"))


@query
def signups_prepared(spark, folder):
    return prepare.prepare_signups(export(spark, folder, "signups"))


# --- Merge and checks -------------------------------------------------------


@query
def merged_weekly(spark, folder):
    """Flagship: all exports merged into the company-by-week table."""
    return merge_prepared(prepare_exports(exports(spark, folder)), SETTINGS)


@query
def merged_previous_sunday(spark, folder):
    """Cut-off that does not count a Sunday as closed on the day itself."""
    open_weeks = merge.closed_weeks(merged(spark, folder), SETTINGS.as_of, include_today=False)
    return open_weeks.select("companyId", WEEK, "connect_licenses", "dau_count")


@query
def grain_duplicates(spark, folder):
    return quality.grain_duplicates(export(spark, folder, "connect"), ["companyId", WEEK])


@query
def export_grain(spark, folder):
    return pipeline.export_grain(exports(spark, folder))


@query
def date_windows(spark, folder):
    return quality.date_windows(exports(spark, folder))


@query
def window_mismatch(spark, folder):
    return quality.window_mismatch(quality.date_windows(exports(spark, folder)))


@query
def merge_summary(spark, folder):
    return quality.merge_summary(merged(spark, folder))


# --- Periods ----------------------------------------------------------------


@query
def weekly_totals(spark, folder):
    return period.weekly_totals(merged(spark, folder))


@query
def weekly_companies(spark, folder):
    return period.weekly_companies(merged(spark, folder)).select("companyId", WEEK, "connect_plan_list")


@query
def monthly_companies(spark, folder):
    return period.monthly_companies(merged(spark, folder))


@query
def monthly_totals(spark, folder):
    return period.monthly_totals(merged(spark, folder))


@query
def plan_list_union(spark, folder):
    rows = merged(spark, folder).where("connect_plan_list <> ''")
    return rows.groupBy("companyId").agg(period.combine_plan_lists("connect_plan_list").alias("plans"))


CHANGE_METRICS = ["execution_count", "MARKETING", "dau_count", "connect_licenses"]


@query
def period_change(spark, folder):
    slim = merged(spark, folder).select("companyId", WEEK, *CHANGE_METRICS)
    return period.period_change(slim, CHANGE_METRICS, WEEK)


@query
def period_change_monthly(spark, folder):
    months = period.monthly_companies(merged(spark, folder), CHANGE_METRICS)
    changed = period.period_change(months, CHANGE_METRICS, MONTH)
    return changed.select("companyId", MONTH, *[c for m in CHANGE_METRICS for c in (m, f"{m}_wow")])


@query
def total_change(spark, folder):
    return period.total_change(period.weekly_totals(merged(spark, folder)), "signups", WEEK)


@query
def available_periods(spark, folder):
    return period.available_periods(period.monthly_totals(merged(spark, folder)), MONTH)


# --- Views ------------------------------------------------------------------


@query
def overview_row(spark, folder):
    table = merged_by_week(spark, folder)
    return views.overview_row(period.weekly_totals(table), table, WEEK, SOME_WEEK)


@query
def overview_latest(spark, folder):
    table = merged_by_week(spark, folder)
    return views.overview_row(period.weekly_totals(table), table, WEEK)


@query
def metric_series(spark, folder):
    totals = period.monthly_totals(merged(spark, folder))
    return views.metric_series(totals, ["message", "plan", "app", "stage"], MONTH)


@query
def company_series(spark, folder):
    return views.metric_series(merged(spark, folder), "app", WEEK, ["companyId"])


@query
def series_label_forms(spark, folder):
    """Display labels of every app."""
    apps = standin(spark, folder, "apps").select(F.col("name"))
    column = F.concat(F.lit("marketplace_app_"), slug(F.col("name"), "unknown_app"))
    return apps.select("name", series_label(column, "app").alias("label"))


@query
def top_companies(spark, folder):
    return views.top_companies(merged_by_week(spark, folder), WEEK, SOME_WEEK)


@query
def company_directory(spark, folder):
    return views.company_directory(merged(spark, folder), WEEK)


def _changed(spark, folder, metrics):
    return period.period_change(merged(spark, folder), metrics, WEEK)


@query
def company_history(spark, folder):
    metrics = merge.company_metrics(merged(spark, folder).columns)
    history = views.company_history(_changed(spark, folder, metrics), SOME_COMPANY, WEEK)
    shown = ["execution_count", "MARKETING", "kyc_total", "connect_licenses", "gov_validated"]
    return history.select(WEEK, *[c for m in shown for c in (m, f"{m}_wow")], "connect_plan_list")


@query
def company_snapshot(spark, folder):
    metrics = ["execution_count", "connect_licenses"]
    return views.company_snapshot(merged(spark, folder), WEEK, SOME_WEEK, metrics=metrics)


@query
def active_items(spark, folder):
    return views.active_items(merged(spark, folder), WEEK, "app", APP_WEEK)


@query
def active_plans(spark, folder):
    return views.active_items(merged(spark, folder), WEEK, "plan", SOME_WEEK)


@query
def kyc_status_detail(spark, folder):
    return views.kyc_status_detail(merged(spark, folder), WEEK, SOME_WEEK)


@query
def gov_hil_rates(spark, folder):
    return views.gov_hil_rates(merged(spark, folder), WEEK)


@query
def gov_hil_delta(spark, folder):
    return views.gov_hil_delta(merged(spark, folder), WEEK)


@query
def hil_breakdown(spark, folder):
    return views.hil_breakdown(merged(spark, folder), WEEK, SOME_WEEK)


@query
def distribution_histogram(spark, folder):
    return views.distribution_histogram(merged_by_week(spark, folder), WEEK, "execution_count", SOME_WEEK, threshold=300)


@query
def distribution_box(spark, folder):
    return views.distribution_box(merged_by_week(spark, folder), WEEK, "execution_count", SOME_WEEK)


@query
def distribution_stats(spark, folder):
    stats = views.distribution_stats(merged_by_week(spark, folder), WEEK, "execution_count", SOME_WEEK)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std")})


@query
def power_users(spark, folder):
    return views.power_users(merged_by_week(spark, folder), WEEK, "execution_count", SOME_WEEK, threshold=200)


@query
def normal_top(spark, folder):
    return views.normal_top(merged_by_week(spark, folder), WEEK, "execution_count", SOME_WEEK, threshold=200)


METRIC = "execution_count"


@query
def change_scatter(spark, folder):
    return views.change_scatter(merged(spark, folder), WEEK, METRIC, SOME_WEEK)


@query
def big_decliners(spark, folder):
    return views.big_decliners(merged(spark, folder), WEEK, METRIC, SOME_WEEK)


@query
def top_gainers(spark, folder):
    return views.top_gainers(merged(spark, folder), WEEK, "MARKETING", SOME_WEEK)


@query
def top_decliners(spark, folder):
    return views.top_decliners(merged(spark, folder), WEEK, "MARKETING", SOME_WEEK)


# --- Identity ---------------------------------------------------------------


@query
def kyc_sessions_monthly(spark, folder):
    return identity.kyc_sessions_monthly(*_raw(spark, folder, "biometrics"), START)


@query
def kyc_steps_monthly(spark, folder):
    return identity.kyc_steps_monthly(*_raw(spark, folder, "biometric_steps"), START)


@query
def gov_validation_monthly(spark, folder):
    return identity.gov_validation_monthly(*_raw(spark, folder, "biometric_steps", "document_check_steps"), START)


@query
def signatures_monthly(spark, folder):
    return identity.signatures_monthly(*_raw(spark, folder, "signatures"), START)


@query
def kyc_volume_by_company(spark, folder):
    return identity.kyc_volume_by_company(*_raw(spark, folder, "biometrics"))


@query
def kyc_approval_rate(spark, folder):
    return identity.kyc_approval_rate(*_raw(spark, folder, "biometrics"))


@query
def kyc_funnel(spark, folder):
    return identity.kyc_funnel(*_raw(spark, folder, "biometrics", "biometric_steps"))


@query
def liveness_fraud_rate(spark, folder):
    return identity.liveness_fraud_rate(*_raw(spark, folder, "biometric_steps"))


@query
def facematch_scores(spark, folder):
    return identity.facematch_scores(*_raw(spark, folder, "biometric_steps", "facematch_steps"))


@query
def identity_countries(spark, folder):
    return identity.identity_countries(*_raw(spark, folder, "document_identities"))


@query
def security_events_summary(spark, folder):
    return identity.security_events_summary(*_raw(spark, folder, "security_events"))


@query
def steps_enriched(spark, folder):
    enriched = identity.steps_enriched(
        *_raw(
            spark,
            folder,
            "biometric_steps",
            "biometrics",
            "document_check_steps",
            "document_identities",
            "liveness_steps",
            "facematch_steps",
        )
    )
    return enriched.select(
        "biometricId",
        "stepName",
        "status",
        "createdAt",
        "session_companyId",
        "session_status",
        "document_check_entityResponse",
        "identity_country",
        "liveness_otpCode",
        "facematch_similarity",
    )


@query
def kyc_workflow_context(spark, folder):
    return identity.kyc_workflow_context(*_raw(spark, folder, "biometrics", "executions"))
