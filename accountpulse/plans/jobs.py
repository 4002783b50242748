"""Named weekly queries over a catalog of raw tables, and their groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from ..errors import MissingSourceError, ValidationError
from ..operators.prepare import marketplace_long
from ..operators.weekly import (
    INTERNAL_PATTERNS,
    connect_items,
    connect_licenses_weekly,
    daily_active_users_weekly,
    kyc_hil_government_weekly,
    kyc_steps_weekly,
    marketplace_installations,
    session_billing_weekly,
    signups_weekly,
    workflow_executions_weekly,
)

JOB_GROUPS = {
    "kyc_and_billing": ("billing", "connect", "kyc", "hil_gov"),
    "rest": ("signups", "workflow", "dau"),
    "marketplace": ("marketplace",),
}


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on besides its tables. No clock is read anywhere."""

    start: date
    as_of: date
    product_id: str
    internal_patterns: tuple[str, ...] = INTERNAL_PATTERNS
    include_today: bool = True
    strict_windows: bool = False


def weekly_jobs(
    catalog: Mapping[str, DataFrame], settings: Settings, without: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Lazy export per job. A raw table that is absent fails, unless its jobs are named in ``without``."""
    start, as_of = settings.start, settings.as_of

    def licences(subscriptions: DataFrame, items: DataFrame, tiers: DataFrame) -> DataFrame:
        sold = connect_items(subscriptions, items, tiers, settings.product_id, as_of)
        return connect_licenses_weekly(sold, start, as_of)

    def installs(events: DataFrame, apps: DataFrame, mapping: DataFrame) -> DataFrame:
        return marketplace_long(marketplace_installations(events, apps, start), mapping)

    queries: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
        "workflow": (("workflow_logs",), lambda logs: workflow_executions_weekly(logs, start)),
        "billing": (("billing_events",), lambda events: session_billing_weekly(events, start)),
        "dau": (("ai_users",), lambda events: daily_active_users_weekly(events, start)),
        "connect": (("subscriptions", "subscription_items", "plan_tiers"), licences),
        "kyc": (("biometric_steps", "biometrics"), lambda steps, sessions: kyc_steps_weekly(steps, sessions, start)),
        "hil_gov": (
            ("biometric_steps", "biometrics", "document_check_steps"),
            lambda steps, sessions, checks: kyc_hil_government_weekly(steps, sessions, checks, start),
        ),
        "marketplace": (("user_app_installations", "apps", "user_company_map"), installs),
        "signups": (
            ("companies", "company_users"),
            lambda companies, users: signups_weekly(companies, users, start, settings.internal_patterns),
        ),
    }
    wanted = {name: job for name, job in queries.items() if name not in set(without)}
    absent = {name: [t for t in tables if t not in catalog] for name, (tables, _) in wanted.items()}
    if any(absent.values()):
        listed = "; ".join(f"{name} needs {', '.join(tables)}" for name, tables in absent.items() if tables)
        raise MissingSourceError(f"Raw tables are absent: {listed}")
    return {name: query(*[catalog[t] for t in tables]) for name, (tables, query) in wanted.items()}


def job_group(group: str) -> tuple[str, ...]:
    """Job names of a group."""
    if group not in JOB_GROUPS:
        raise ValidationError(f"No group is called {group!r}")
    return JOB_GROUPS[group]


def select_jobs(jobs: Mapping[str, DataFrame], names: Iterable[str]) -> dict[str, DataFrame]:
    names = list(names)
    unknown = sorted(set(names) - set(jobs))
    if unknown:
        raise ValidationError(f"No query is called {', '.join(unknown)}")
    return {name: jobs[name] for name in names}
