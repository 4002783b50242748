"""Exports and the merged table of a test folder, written once per application.

The merged table is what the analyses read in practice, so the registered analyses read a
written one too. It is derived from the folder's tables by the library, under the shared
folder, and derived anew when any of their files changes.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from accountpulse.operators.quality import Profile
from accountpulse.plans.jobs import Settings, select_jobs, weekly_jobs
from accountpulse.plans.pipeline import PREPARE, Exports, merge_prepared, prepare_exports, stage_exports
from accountpulse.session import shared_folder
from accountpulse.sources.staging import fingerprint, stage
from accountpulse.sources.standins import standins, tables_of
from accountpulse.sources.writers import read_by_week, write_merged

SETTINGS = Settings(start=date(1996, 1, 1), as_of=date(2024, 2, 4), product_id="connect")

RUN_TABLES = (
    "billing_events",
    "ai_users",
    "workflow_logs",
    "biometrics",
    "biometric_steps",
    "document_check_steps",
    "subscriptions",
    "subscription_items",
    "plan_tiers",
    "companies",
    "company_users",
    "user_app_installations",
    "apps",
    "user_company_map",
)

_staged: dict[tuple, DataFrame] = {}
_profiles: dict[tuple, Profile] = {}


def catalog(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return standins(spark, folder, RUN_TABLES)


def _version(spark: SparkSession, folder: str) -> tuple:
    tables = sorted(reduce(set.union, (set(tables_of(n)) for n in RUN_TABLES)))
    digest = fingerprint(spark, [f"{folder}/{t}.parquet" for t in tables])
    return spark.sparkContext.applicationId, folder, digest


def exports(spark: SparkSession, folder: str, *names: str) -> Exports:
    """Written weekly exports of the folder; all of them unless named."""
    version = _version(spark, folder)
    wanted = names or tuple(PREPARE)
    missing = [n for n in wanted if (*version, n) not in _staged]
    if missing:
        jobs = select_jobs(weekly_jobs(catalog(spark, folder), SETTINGS), missing)
        written = stage_exports(jobs)
        for name, df in written.items():
            _staged[(*version, name)], _profiles[(*version, name)] = df, written.profiles[name]
    return Exports({n: _staged[(*version, n)] for n in wanted}, {n: _profiles[(*version, n)] for n in wanted})


def export(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return exports(spark, folder, name)[name]


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """Written merged table of the folder."""
    key = (*_version(spark, folder), "merged")
    if key not in _staged:
        table = merge_prepared(prepare_exports(exports(spark, folder)), SETTINGS)
        _staged[key] = stage(table, "merged")
    return _staged[key]


def merged_by_week(spark: SparkSession, folder: str) -> DataFrame:
    """The same table with a folder per week, for analyses of one period."""
    key = (*_version(spark, folder), "merged_by_week")
    if key not in _staged:
        table = merged(spark, folder)
        path = f"{shared_folder(spark).rstrip('/')}/stage/merged_by_week-{uuid.uuid4().hex}"
        write_merged(table, path, "parquet")
        _staged[key] = read_by_week(spark, path, table.schema)
    return _staged[key]
