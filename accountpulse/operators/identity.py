"""Monthly identity-verification analyses over the raw verification tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.weeks import since, year_month
from ..sources.contracts import KYC_STAGES
from .joins import left_lookup

# --- Fixed values -----------------------------------------------------------
UNFINISHED = ("Initiated", "Incomplete", "Abandoned")
FRAUD_WORD = "fraude"
# ----------------------------------------------------------------------------


def _recent(df: DataFrame, start: date | str | None) -> DataFrame:
    return df if start is None else df.where(since(df, "createdAt", start))


def _share(part: str, whole: str):
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def kyc_sessions_monthly(sessions: DataFrame, start: date | str | None = None) -> DataFrame:
    """Sessions per month and status."""
    return (
        _recent(sessions, start)
        .groupBy(year_month("createdAt").alias("month"), "status")
        .agg(F.count("*").alias("sessions"))
    )


def kyc_steps_monthly(steps: DataFrame, start: date | str | None = None) -> DataFrame:
    """Steps per month, stage and status."""
    return (
        _recent(steps, start)
        .groupBy(year_month("createdAt").alias("month"), "stepName", "status")
        .agg(F.count("*").alias("steps"))
    )


def gov_validation_monthly(steps: DataFrame, doc_checks: DataFrame, start: date | str | None = None) -> DataFrame:
    """Document checks per month and government answer.

    Steps are counted per check and month before the join, so a check that many steps
    point at is one row in it.
    """
    per_check = (
        _recent(steps, start)
        .where((F.col("stepName") == "document_check") & F.col("documentCheckId").isNotNull())
        .groupBy("documentCheckId", year_month("createdAt").alias("month"))
        .agg(F.count("*").alias("n"))
    )
    answers = doc_checks.select(F.col("id").alias("documentCheckId"), "entityResponse")
    return (
        per_check.join(answers, "documentCheckId")
        .groupBy("month", "entityResponse")
        .agg(F.sum("n").alias("checks"))
    )


def signatures_monthly(signatures: DataFrame, start: date | str | None = None) -> DataFrame:
    """Signature requests per month, provider and status."""
    return (
        _recent(signatures, start)
        .groupBy(year_month("createdAt").alias("month"), "provider", "status")
        .agg(F.count("*").alias("signatures"))
    )


def kyc_volume_by_company(sessions: DataFrame, start: date | str | None = None) -> DataFrame:
    """Sessions per company and month."""
    return (
        _recent(sessions, start)
        .where(F.col("companyId").isNotNull())
        .groupBy("companyId", year_month("createdAt").alias("month"))
        .agg(F.count("*").alias("sessions"))
    )


def kyc_approval_rate(sessions: DataFrame, start: date | str | None = None) -> DataFrame:
    """Approved share of all sessions, per month."""
    counts = (
        _recent(sessions, start)
        .groupBy(year_month("createdAt").alias("month"))
        .agg(F.count("*").alias("sessions"), F.count_if(F.col("status") == "Approved").alias("approved"))
    )
    return counts.withColumn("approval_rate", _share("approved", "sessions"))


def kyc_funnel(sessions: DataFrame, steps: DataFrame) -> DataFrame:
    """Sessions that reached each stage and passed it, and sessions left unfinished.

    Steps shrink to one row per session and stage before they meet the sessions, so the
    counts are plain and a session with very many steps is at most three rows.
    """
    reached = (
        steps.where(F.col("stepName").isin(*KYC_STAGES))
        .groupBy("biometricId", "stepName")
        .agg(F.max(F.when(F.col("status") == "Approved", 1).otherwise(0)).alias("passed"))
    )
    known = sessions.select(F.col("id").alias("biometricId"))
    per_stage = (
        reached.join(known, "biometricId", "left_semi")
        .groupBy(F.col("stepName").alias("stage"))
        .agg(F.count("*").alias("sessions"), F.sum("passed").alias("approved"))
    )
    overall = sessions.agg(
        F.count("*").alias("all"),
        F.count_if(F.col("status") == "Approved").alias("approved"),
        F.count_if(F.col("status").isin(*UNFINISHED)).alias("open"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("session").alias("stage"), F.col("all").alias("sessions"), "approved"),
                F.struct(
                    F.lit("not_completed").alias("stage"),
                    F.col("open").alias("sessions"),
                    F.lit(0).cast("bigint").alias("approved"),
                ),
            )
        )
    )
    return overall.unionByName(per_stage)


def liveness_fraud_rate(steps: DataFrame, start: date | str | None = None) -> DataFrame:
    """Liveness steps that were fraud by status or by description, per month."""
    text = F.col("description") if "description" in steps.columns else F.lit(None).cast(T.StringType())
    fraud = (F.col("status") == "Fraud") | F.contains(F.lower(text), F.lit(FRAUD_WORD))
    counts = (
        _recent(steps, start)
        .where(F.col("stepName") == "liveness")
        .groupBy(year_month("createdAt").alias("month"))
        .agg(F.count("*").alias("liveness_steps"), F.count_if(fraud).alias("fraud_steps"))
    )
    return counts.withColumn("fraud_rate", _share("fraud_steps", "liveness_steps"))


def facematch_scores(steps: DataFrame, facematch: DataFrame, start: date | str | None = None) -> DataFrame:
    """Similarity of face matches per month: count, mean and quartiles.

    A similarity is a whole number up to 100, so a month shrinks to about a hundred
    counted values before its quartiles are taken.
    """
    per_match = (
        _recent(steps, start)
        .where(F.col("facematchId").isNotNull())
        .groupBy("facematchId", year_month("createdAt").alias("month"))
        .agg(F.count("*").alias("n"))
    )
    scores = facematch.where(F.col("similarity").isNotNull()).select(F.col("id").alias("facematchId"), "similarity")
    counts = per_match.join(scores, "facematchId").groupBy("month", "similarity").agg(F.sum("n").alias("n"))
    quartiles = F.percentile("similarity", [0.25, 0.5, 0.75], F.col("n"))
    grouped = counts.groupBy("month").agg(
        F.sum("n").alias("matches"), F.sum(F.col("similarity") * F.col("n")).alias("total"), quartiles.alias("q")
    )
    return grouped.select(
        "month",
        "matches",
        _share("total", "matches").alias("mean_similarity"),
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )


def identity_countries(identities: DataFrame) -> DataFrame:
    """Documents and distinct clients per country and nationality."""
    per_client = identities.groupBy("country", "nationality", "clientId").agg(F.count("*").alias("n"))
    return per_client.groupBy("country", "nationality").agg(
        F.sum("n").alias("documents"), F.count("clientId").alias("clients")
    )


def security_events_summary(events: DataFrame) -> DataFrame:
    """Events and open events per type and severity."""
    return events.groupBy("type", "severity").agg(
        F.count("*").alias("events"), F.count_if(F.col("resolved") == 0).alias("unresolved")
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == "id" else f"{prefix}_{c}") for c in df.columns])


def _routed(steps: DataFrame, details: Mapping[str, DataFrame], spread: Column) -> DataFrame:
    """Steps with the one detail that each of them names, by one join with all details stacked."""
    kinds = [
        df.where(F.col("id").isNotNull()).withColumn(
            "id", F.struct(F.lit(key).alias("kind"), F.col("id").cast("string").alias("id"))
        )
        for key, df in details.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)

    def named(key: str) -> Column:
        text = F.col(key).cast(details[key].schema["id"].dataType).cast("string")
        return F.when(F.col(key).isNotNull(), F.struct(F.lit(key).alias("kind"), text.alias("id")))

    return left_lookup(steps.withColumn("__detail", F.coalesce(*map(named, details))), stacked, "__detail", spread).drop("__detail")


def steps_enriched(
    steps: DataFrame,
    sessions: DataFrame,
    doc_checks: DataFrame | None = None,
    identities: DataFrame | None = None,
    liveness: DataFrame | None = None,
    facematch: DataFrame | None = None,
    several: bool | None = None,
) -> DataFrame:
    """Steps with session, document check, identity, liveness and face match beside them.

    A step belongs to one session and, by its stage, has one detail at most. So its rows are shuffled
    twice: under the session's key, and under the key of the one detail they have, where all details
    stand stacked by kind and id. Keys are often NULL; see ``left_lookup``. Steps that name several
    details go through a join per detail instead. ``several`` tells whether there are such steps; if it
    isn't given, three columns are read to find out. Looked-up columns are prefixed by their table.
    """
    spread = F.struct("biometricId", "stepName", "createdAt")
    details = {}
    if doc_checks is not None:
        # Identities meet the checks, which are far fewer than the steps.
        details["documentCheckId"] = _prefixed(doc_checks, "document_check")
        if identities is not None:
            key = "document_check_documentIdentityId"
            details["documentCheckId"] = left_lookup(
                details["documentCheckId"], _prefixed(identities, "identity"), key, F.col("id")
            )
    if liveness is not None:
        details["livenessId"] = _prefixed(liveness, "liveness")
    if facematch is not None:
        details["facematchId"] = _prefixed(facematch, "facematch")
    joined = left_lookup(steps, _prefixed(sessions, "session"), "biometricId", spread)
    if not details:
        return joined
    columns = [*joined.columns, *[c for df in details.values() for c in df.columns if c != "id"]]
    named = sum((F.col(key).isNotNull().cast("int") for key in details), F.lit(0))
    if several is None:
        several = len(details) > 1 and not steps.where(named > 1).isEmpty()
    if not several:
        return _routed(joined, details, spread).select(columns)
    chained = joined.where(named > 1)
    for key, df in details.items():
        chained = left_lookup(chained, df, key, spread)
    return _routed(joined.where(named <= 1), details, spread).select(columns).unionByName(chained.select(columns))


def kyc_workflow_context(sessions: DataFrame, executions: DataFrame, execution_key: str = "executionId") -> DataFrame:
    """Sessions with the skill and execution named in their JSON details, and that execution."""
    named = sessions.withColumns(
        {
            "skill_id": F.get_json_object("details", "$.skill_id"),
            "execution_id": F.get_json_object("details", "$.execution_id"),
        }
    ).drop("details")
    return left_lookup(
        named,
        executions.withColumn(execution_key, F.col(execution_key).cast("string")),
        "execution_id",
        F.struct("id"),
        execution_key,
    )
