"""The whole weekly run on the smallest test folder."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import MissingSourceError, ValidationError
from accountpulse.operators.merge import company_metrics
from accountpulse.plans.jobs import Settings, weekly_jobs
from accountpulse.plans.pipeline import run_group, run_weekly
from checks.workspace import catalog

SMALL = "/root/testdata/sf0.001"
SETTINGS = Settings(date(1999, 1, 1), date(2000, 1, 2), "connect")


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "merged")
    with pytest.warns(UserWarning, match="same first and last week"):
        table = run_weekly(weekly_jobs(catalog(spark, SMALL), SETTINGS), SETTINGS, path, "csv")
    return table, path


def test_written_files_hold_the_table(merged):
    table, path = merged
    lines = [ln for f in glob.glob(path + "/part-*.csv") for ln in open(f).read().splitlines()]
    assert len([ln for ln in lines if not ln.startswith("companyId")]) == table.count() > 0
    assert table.agg(F.max("week_end_sunday")).first()[0] <= date(2000, 1, 2)


def test_invariants(merged):
    table, _ = merged

    def total(*columns):
        return sum((F.col(c) for c in columns), F.lit(0))

    plans = [c for c in table.columns if c.startswith("connect_plan_") and c != "connect_plan_list"]
    stages = [f"kyc_{s}_total" for s in ("document_check", "liveness", "facematch")]
    statuses = [c for c in table.columns if c.startswith("kyc_") and c.split("_")[-1] in ("approved", "disapproved", "fraud")]
    apps = [c for c in table.columns if c.startswith("marketplace_app_")]
    broken = table.where(
        (F.col("connect_licenses") != total(*plans))
        | (F.col("kyc_total") != total(*stages))
        | (F.col("kyc_total") != total(*statuses))
        | (F.col("marketplace_install_total") != total(*apps))
        | (F.col("dau_count") < F.col("unique_users_count"))
        | (total("self_service", "enterprise", "other_plans") > F.col("signups"))
    )
    assert broken.count() == 0
    assert table.select([F.count_if(F.col(c).isNull()).alias(c) for c in table.columns]).first() == (0,) * len(
        table.columns
    )
    assert set(plans) <= set(company_metrics(table.columns))


def test_strict_windows_stop_the_run(spark, tmp_path):
    strict = Settings(date(1999, 1, 1), date(2000, 1, 2), "connect", strict_windows=True)
    with pytest.raises(ValidationError, match="same first and last week"):
        run_weekly(weekly_jobs(catalog(spark, SMALL), strict), strict, str(tmp_path / "never"))
    assert not (tmp_path / "never").exists()


def test_an_absent_raw_table_fails(spark):
    tables = catalog(spark, SMALL)
    tables.pop("ai_users")
    with pytest.raises(MissingSourceError, match="dau needs ai_users"):
        weekly_jobs(tables, SETTINGS)
    assert "dau" not in weekly_jobs(tables, SETTINGS, without=["dau"])


def test_group_saves_exports_and_falls_back(spark, tmp_path):
    jobs = weekly_jobs(catalog(spark, SMALL), SETTINGS)
    folder = str(tmp_path / "exports")
    saved = run_group(jobs, "kyc_and_billing", folder)
    assert set(saved) == {"billing", "connect", "kyc", "hil_gov"}
    broken = jobs | {"connect": jobs["connect"].withColumn("connect_licenses", F.raise_error(F.lit("gone")).cast("bigint"))}
    with pytest.raises(Exception, match="gone"):
        run_group(broken, "kyc_and_billing", str(tmp_path / "other"))
    again = run_group(broken, "kyc_and_billing", str(tmp_path / "other"), allow_fallback=True, earlier=folder)
    assert again["connect"].count() == saved["connect"].count()


def test_a_repeated_export_key_stops_the_run(spark, tmp_path):
    jobs = weekly_jobs(catalog(spark, SMALL), SETTINGS)
    twice = jobs | {"dau": jobs["dau"].union(jobs["dau"])}
    with pytest.raises(ValidationError, match="dau: "):
        run_weekly(twice, SETTINGS, str(tmp_path / "never"))
