"""Weekly source queries: raw event and account tables to company-by-week exports.

Every query filters and projects before it shuffles, and every group is pre-aggregated on
the map side, so one company with a third of all rows costs no more than its map tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import parsed_or_zero
from ..functions.text import BILLED_TYPES, contains_any, is_external
from ..functions.weeks import WEEK, calendar_bounds, since, week_end_sunday
from ..sources.contracts import HIL_STEPS, KYC_STAGES

# --- Fixed values -----------------------------------------------------------
# Words that mark internal and test accounts; callers add their own company name.
INTERNAL_PATTERNS = ("impersonate", "test", "prueba")
UNKNOWN_PLAN = "Unknown Plan"
# ----------------------------------------------------------------------------


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


# --- Messaging --------------------------------------------------------------


def session_billing_weekly(events: DataFrame, start: date | str) -> DataFrame:
    """Events and billable events per company, week and billed conversation type."""
    return (
        events.where(F.col("conversationType").isin(*BILLED_TYPES))
        .where(F.col("companyId").isNotNull() & since(events, "createdAt", start))
        .groupBy("companyId", week_end_sunday("createdAt").alias(WEEK), "conversationType")
        .agg(F.count("*").alias("event_count"), F.sum("isBillable").alias("billable_count"))
    )


# --- Sign-ups ---------------------------------------------------------------


def exclude_internal(df: DataFrame, columns: Sequence[str], patterns: Sequence[str] = INTERNAL_PATTERNS) -> DataFrame:
    """Drop rows where one of the columns holds a pattern; missing and empty text passes."""
    keep = F.lit(True)
    for column in columns:
        keep = keep & is_external(F.col(column), patterns)
    return df.where(keep)


def exclude_internal_root_users(
    companies: DataFrame, users: DataFrame, patterns: Sequence[str] = INTERNAL_PATTERNS
) -> DataFrame:
    """Drop companies that have a live root user with an internal mail address.

    The users are reduced to distinct company ids before the anti join, so a company with
    very many users is one row there.
    """
    flagged = (
        users.where(F.col("deletedAt").isNull() & (F.col("isRoot") == 1))
        .where(F.col("email").isNotNull() & (F.trim("email") != "") & contains_any(F.col("email"), patterns))
        .select(F.col("companyId").alias("id"))
        .distinct()
    )
    return companies.join(flagged, "id", "left_anti")


def signups_weekly(
    companies: DataFrame, users: DataFrame, start: date | str, patterns: Sequence[str] = INTERNAL_PATTERNS
) -> DataFrame:
    """New external companies per week, split by plan. A NULL plan counts in the total only."""
    recent = companies.where(since(companies, "createdAt", start))
    external = exclude_internal(recent, ["name", "slug", "email"], patterns)
    plan = F.col("plan")
    return (
        exclude_internal_root_users(external, users, patterns)
        .groupBy(week_end_sunday("createdAt").alias(WEEK))
        .agg(
            F.count("*").alias("signups"),
            _count_if(plan == "SELF_SERVICE").alias("self_service"),
            _count_if(plan == "ENTERPRISE").alias("enterprise"),
            _count_if(~plan.isin("SELF_SERVICE", "ENTERPRISE")).alias("other_plans"),
        )
    )


# --- Identity verification --------------------------------------------------


def _stage_steps(steps: DataFrame, start: date | str) -> DataFrame:
    return steps.where(F.col("stepName").isin(*KYC_STAGES) & since(steps, "createdAt", start))


def _owned_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("companyId").isNotNull()).select(F.col("id").alias("biometricId"), "companyId")


def _company_name() -> Column:
    return F.concat(F.lit("Company "), F.col("companyId").cast("string")).alias("companyName")


def kyc_steps_weekly(steps: DataFrame, sessions: DataFrame, start: date | str) -> DataFrame:
    """Steps per company, week, stage and status.

    The groups do not hold the session, so the join is followed by a shuffle anyway and
    the adaptive skew join is free to split a session with very many steps.
    """
    counts = (
        _stage_steps(steps, start)
        .select("biometricId", "stepName", "status", week_end_sunday("createdAt").alias(WEEK))
        .join(_owned_sessions(sessions), "biometricId")
        .groupBy("companyId", WEEK, "stepName", "status")
        .agg(F.count("*").alias("kyc_steps_count"))
    )
    return counts.select("companyId", _company_name(), WEEK, "stepName", "status", "kyc_steps_count")


def kyc_hil_government_weekly(
    steps: DataFrame, sessions: DataFrame, doc_checks: DataFrame, start: date | str
) -> DataFrame:
    """Sessions, government answers and human-review outcomes per company and week.

    Steps are counted by session, week, outcome and answer: one count per group on the map side and in
    the shuffle, where a sum per reported column would take eleven. Only document checks with an id can
    have an answer; those alone travel to the checks, counted per session, week and check, and the other
    steps don't wait for them. A check or a session with very many steps is thus a few rows in the joins.
    Sessions are counted by the first of their rows in a week.
    """
    step, status = F.col("stepName"), F.col("status")
    outcome = F.when(status == "Approved", 1).when(status == "Disapproved", 2).otherwise(0)
    reviewed = F.col("enableHumanInLoop") == 1
    hil = F.coalesce(*[F.when(reviewed & (step == stage), outcome + 3 * i) for i, stage in enumerate(HIL_STEPS.values())])
    check = F.when(step == "document_check", F.col("documentCheckId"))
    slim = _stage_steps(steps, start).select(
        "biometricId", week_end_sunday("createdAt").alias(WEEK), hil.alias("hil"), check.alias("checkId")
    )
    per_check = slim.where(F.col("checkId").isNotNull()).groupBy(*slim.columns).agg(F.count("*").alias("steps"))
    entity = F.col("entityResponse")
    answers = doc_checks.select(F.col("id").alias("checkId"), F.when(entity == 1, 1).when(entity == 0, 0).alias("answer"))
    answered = per_check.join(answers, "checkId", "left").drop("checkId")
    others = slim.where(F.col("checkId").isNull()).drop("checkId")
    others = others.withColumns({"steps": F.lit(1).cast("bigint"), "answer": F.lit(None).cast("int")})
    per_session = answered.unionByName(others).groupBy("biometricId", WEEK, "hil", "answer").agg(F.sum("steps").alias("steps"))

    # The window's order by session and week is the join's as well, so rows are sorted once for both.
    week_before = F.lag(WEEK).over(Window.partitionBy("biometricId").orderBy(WEEK))
    first = F.when(week_before == F.col(WEEK), 0).otherwise(1)
    counted = (
        per_session.withColumn("sessions", first)
        .join(_owned_sessions(sessions), "biometricId")
        .groupBy("companyId", WEEK, "hil", "answer")
        .agg(F.sum("steps").alias("steps"), F.sum("sessions").alias("sessions"))
    )

    def steps_of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("steps"))), F.lit(0))

    conditions = {"gov_validated": F.col("answer") == 1, "gov_not_validated": F.col("answer") == 0}
    for i, short in enumerate(HIL_STEPS):
        conditions[f"hil_{short}_total"] = F.col("hil").between(3 * i, 3 * i + 2)
        conditions[f"hil_{short}_approved"] = F.col("hil") == 3 * i + 1
        conditions[f"hil_{short}_disapproved"] = F.col("hil") == 3 * i + 2
    sums = counted.groupBy("companyId", WEEK).agg(
        F.sum("sessions").alias("kyc_sessions_total"), *[steps_of(c).alias(name) for name, c in conditions.items()]
    )
    return sums.select("companyId", _company_name(), WEEK, "kyc_sessions_total", *conditions)


# --- Licences ---------------------------------------------------------------


def week_calendar(bounds: DataFrame) -> DataFrame:
    """One row per closing Sunday for a one-row frame of dates ``start`` and ``as_of``.

    Begins with the first Sunday on or after ``start`` and ends with the first one at
    least two weeks after ``as_of``.
    """
    first = week_end_sunday("start")
    last = F.greatest(first, week_end_sunday(F.date_add(F.to_date("as_of"), 14)))
    return bounds.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))).alias(WEEK))


def connect_items(
    subscriptions: DataFrame, items: DataFrame, tiers: DataFrame, product_id: str, as_of: date
) -> DataFrame:
    """Active subscription items of one product with plan names, validity and quantity.

    No side is broadcast by hand: the plan table is small in practice, but only the
    optimizer sees its real size. The items are not sorted for their subscriptions: a task hashes
    its share of the active ones, whose ids are the table's key, and the items stream past.
    """
    active = subscriptions.where(F.col("company_id").isNotNull() & (F.upper("status") == "ACTIVE")).select(
        F.col("id").alias("subscription_id"),
        F.col("company_id").alias("companyId"),
        F.to_date("current_period_start").alias("period_start"),
        F.coalesce(
            F.to_date("canceled_at"), F.to_date("cancel_at"), F.to_date("current_period_end"), F.lit(as_of)
        ).alias("period_end"),
    )
    sold = items.where(F.col("platform_product_id") == product_id).select(
        "subscription_id",
        "plan_tier_id",
        F.coalesce(F.nullif("quantity", F.lit(0)), F.lit(1)).alias("license_qty"),
    )
    plans = tiers.select(
        F.col("id").alias("plan_tier_id"),
        F.col("name").alias("plan_tier_name"),
        F.coalesce(F.nullif("display_name", F.lit("")), F.col("name"), F.lit(UNKNOWN_PLAN)).alias(
            "plan_tier_display_name"
        ),
    )
    return (
        sold.join(active.hint("shuffle_hash"), "subscription_id")
        .join(plans, "plan_tier_id")
        .select(
            "companyId", "plan_tier_name", "plan_tier_display_name", "period_start", "period_end", "license_qty"
        )
    )


def connect_licenses_weekly(items: DataFrame, start: date, as_of: date) -> DataFrame:
    """Licences in force on each calendar Sunday, per company and plan.

    A range join of items with weeks, done as a sweep: an item adds its quantity on its
    first Sunday and takes it back on the Sunday after its last. The changes are summed
    per week, running sums give the level, and each level is written out for the weeks it
    lasts. The shuffles carry two small rows per item however long it runs, and a
    company-plan group holds at most one row per week.
    """
    first, last = (F.lit(d) for d in calendar_bounds(start, as_of))
    plan = ["companyId", "plan_tier_name", "plan_tier_display_name"]
    spans = items.where(F.col("period_start").isNotNull() & F.col("period_end").isNotNull()).select(
        *plan,
        "license_qty",
        week_end_sunday(F.greatest("period_start", first)).alias("opens"),
        week_end_sunday(F.date_add(F.least("period_end", last), 1)).alias("closes"),
    )
    changes = spans.where(F.col("opens") < F.col("closes")).select(
        *plan,
        F.inline(
            F.array(
                F.struct(F.col("opens").alias("week"), F.col("license_qty").alias("qty"), F.lit(1).alias("items")),
                F.struct(F.col("closes").alias("week"), (-F.col("license_qty")).alias("qty"), F.lit(-1).alias("items")),
            )
        ),
    )
    weekly = changes.groupBy(*plan, "week").agg(F.sum("qty").alias("qty"), F.sum("items").alias("items"))
    by_week = Window.partitionBy(*plan).orderBy("week")
    up_to_now = by_week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = weekly.select(
        *plan,
        "week",
        F.sum("qty").over(up_to_now).alias("connect_licenses"),
        F.sum("items").over(up_to_now).alias("in_force"),
        F.lead("week").over(by_week).alias("next_week"),
    )
    return levels.where("in_force > 0").select(
        F.explode(F.sequence("week", F.date_sub("next_week", 7), F.expr("INTERVAL 7 DAYS"))).alias(WEEK),
        *plan,
        "connect_licenses",
    )


# --- Marketplace ------------------------------------------------------------


def mapping_user_id(df: DataFrame) -> DataFrame:
    """Add the user whose company owns an installation, unless the column is there already.

    Organisation installs belong to the installing user, all others to the app user.
    """
    if "mapping_user_id" in df.columns:
        owner = F.col("mapping_user_id")
    else:
        organisation = F.upper("userType") == "ORGANIZATION"
        owner = F.when(organisation, F.col("installedByUserId")).otherwise(F.col("userId"))
    return df.withColumn("mapping_user_id", F.trim(owner.cast("string")))


def marketplace_installations(installs: DataFrame, apps: DataFrame, start: date | str) -> DataFrame:
    """Live installations with app name, owning user, date and week."""
    live = installs.where(F.col("deletedAt").isNull() & since(installs, "createdAt", start))
    named = live.join(apps.select(F.col("id").alias("appId"), F.col("name").alias("app_name")), "appId")
    return mapping_user_id(named).select(
        F.col("id").alias("installation_id"),
        "userId",
        "userType",
        "installedByUserId",
        "mapping_user_id",
        "appId",
        "app_name",
        F.col("createdAt").alias("installed_at"),
        F.to_date("createdAt").alias("installed_date"),
        week_end_sunday("createdAt").alias(WEEK),
        "updatedAt",
    )


# --- Documents --------------------------------------------------------------


def workflow_executions_weekly(logs: DataFrame, start: date | str) -> DataFrame:
    """Executions per company id, company name and week; totals that are no number count as 0.

    Whole totals stay whole numbers; totals with fractions keep them.
    """
    total = parsed_or_zero(logs, "total")
    if isinstance(logs.schema["total"].dataType, T.IntegralType):
        total = total.cast("bigint")
    return (
        logs.where(since(logs, "createdAt", start) & F.col("company.id").isNotNull())
        .groupBy(
            F.col("company.id").alias("companyId"),
            F.col("company.name").alias("companyName"),
            week_end_sunday("createdAt").alias(WEEK),
        )
        .agg(F.sum(total).alias("execution_count"))
    )


def daily_active_users_weekly(events: DataFrame, start: date | str) -> DataFrame:
    """Users per day summed over the week, and distinct users of the week.

    A user's active days in a week fit in seven bits. One row per user and week with those
    bits answers both questions after a single pre-aggregated shuffle; two distinct counts
    would double every input row first.
    """
    day_bit = F.expr("shiftleft(1, weekday(createdAt))")
    user_weeks = (
        events.where(since(events, "createdAt", start))
        .where(F.col("companyId").isNotNull() & F.col("referenceId").isNotNull())
        .groupBy("companyId", week_end_sunday("createdAt").alias(WEEK), "referenceId")
        .agg(F.bit_or(day_bit).alias("days"))
    )
    return user_weeks.groupBy("companyId", WEEK).agg(
        F.sum(F.bit_count("days")).alias("dau_count"), F.count("*").alias("unique_users_count")
    )
