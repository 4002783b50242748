import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import ValidationError
from accountpulse.functions.weeks import calendar_bounds
from accountpulse.operators import weekly
from accountpulse.plans.jobs import Settings, job_group, select_jobs, weekly_jobs

MON, SUN = datetime(2025, 1, 6), datetime(2025, 1, 12, 23, 59, 59)
WEEK = date(2025, 1, 12)


def test_billing(frame):
    events = frame(
        "companyId BIGINT, createdAt TIMESTAMP_NTZ, conversationType STRING, isBillable INT",
        [
            (1, MON, "MARKETING", 1),
            (1, SUN, "MARKETING", 0),
            (1, MON, "SERVICE", 1),
            (None, MON, "UTILITY", 1),
            (1, datetime(2024, 12, 31), "UTILITY", 1),
            (1, MON, "UTILITY", None),
        ],
    )
    got = sorted(weekly.session_billing_weekly(events, "2025-01-01").collect())
    assert got == [(1, WEEK, "MARKETING", 2, 1), (1, WEEK, "UTILITY", 1, None)]


def test_signups(frame):
    companies = frame(
        "id BIGINT, name STRING, slug STRING, email STRING, plan STRING, createdAt TIMESTAMP_NTZ",
        [
            (1, "Shop", None, "", "SELF_SERVICE", MON),
            (2, None, "shop", "a@b", "ENTERPRISE", MON),
            (3, "", "", None, None, MON),
            (4, "My Test", None, None, "PRO", MON),
            (5, "Other", None, None, "PRO", SUN),
            (6, "Flagged", None, None, "PRO", MON),
            (7, "Old", None, None, "PRO", datetime(2020, 1, 1)),
            (8, "Acme Labs", None, None, "PRO", MON),
        ],
    )
    users = frame(
        "companyId BIGINT, email STRING, isRoot INT, deletedAt DATE",
        [
            (6, "X@TEST.org", 1, None),
            (6, "y@test.org", 1, None),
            (5, "z@test.org", 0, None),
            (1, "z@test.org", 1, date(2025, 1, 1)),
            (2, "  ", 1, None),
            (3, None, 1, None),
        ],
    )
    got = weekly.signups_weekly(companies, users, "2025-01-01").collect()
    assert got == [(WEEK, 5, 1, 1, 2)]
    named = weekly.signups_weekly(companies, users, "2025-01-01", (*weekly.INTERNAL_PATTERNS, "acme")).collect()
    assert named == [(WEEK, 4, 1, 1, 1)]


STEPS = (
    "biometricId STRING, stepName STRING, status STRING, enableHumanInLoop INT, documentCheckId STRING, "
    "createdAt TIMESTAMP_NTZ"
)


def kyc_frames(frame):
    steps = frame(
        STEPS,
        [
            ("s1", "document_check", "Approved", 1, "d1", MON),
            ("s1", "document_check", "Disapproved", 1, "d2", MON),
            ("s1", "document_check", "Approved", 0, "d3", MON),
            ("s1", "document_check", "Approved", 0, None, MON),
            ("s1", "document_check", None, 1, "missing", MON),
            ("s1", "liveness", "Approved", 1, None, SUN),
            ("s2", "facematch", "Disapproved", 1, "d1", SUN),
            ("s2", "facematch", "Fraud", None, None, SUN),
            ("s2", "otp", "Approved", 1, "d1", SUN),
            ("s3", "liveness", "Approved", 1, None, MON),
            ("orphan", "liveness", "Approved", 1, None, MON),
            ("s1", "liveness", "Approved", 1, None, datetime(2024, 1, 1)),
        ],
    )
    sessions = frame("id STRING, companyId INT, status STRING", [("s1", 1, "x"), ("s2", 1, "x"), ("s3", None, "x")])
    checks = frame("id STRING, entityResponse INT", [("d1", 1), ("d2", 0), ("d3", None)])
    return steps, sessions, checks


def test_kyc_steps(frame):
    steps, sessions, _ = kyc_frames(frame)
    got = {(r.stepName, r.status): r.kyc_steps_count for r in weekly.kyc_steps_weekly(steps, sessions, "2025-01-01").collect()}
    assert got == {
        ("document_check", "Approved"): 3,
        ("document_check", "Disapproved"): 1,
        ("document_check", None): 1,
        ("liveness", "Approved"): 1,
        ("facematch", "Disapproved"): 1,
        ("facematch", "Fraud"): 1,
    }


def test_hil_government(frame):
    rows = weekly.kyc_hil_government_weekly(*kyc_frames(frame), "2025-01-01").collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert row.pop("companyId") == 1 and row.pop("companyName") == "Company 1"
    assert row.pop("week_end_sunday") == WEEK
    assert row == {
        "kyc_sessions_total": 2,
        "gov_validated": 1,
        "gov_not_validated": 1,
        "hil_doccheck_total": 3,
        "hil_doccheck_approved": 1,
        "hil_doccheck_disapproved": 1,
        "hil_liveness_total": 1,
        "hil_liveness_approved": 1,
        "hil_liveness_disapproved": 0,
        "hil_facematch_total": 1,
        "hil_facematch_approved": 0,
        "hil_facematch_disapproved": 1,
    }


def test_step_without_stage_name_is_ignored(frame):
    steps, sessions, checks = kyc_frames(frame)
    unnamed = frame(STEPS, [("s1", None, "Approved", 1, "d1", MON)])
    with_it = weekly.kyc_hil_government_weekly(steps.union(unnamed), sessions, checks, "2025-01-01")
    assert with_it.collect() == weekly.kyc_hil_government_weekly(steps, sessions, checks, "2025-01-01").collect()


def test_calendar(frame):
    bounds = frame("start DATE, as_of DATE", [(date(2025, 1, 1), date(2025, 1, 10))])
    assert [r[0] for r in weekly.week_calendar(bounds).collect()] == [
        date(2025, 1, 5) + timedelta(days=7 * i) for i in range(4)
    ]


def test_connect_items(frame):
    as_of = date(2025, 3, 1)
    start = date(2025, 1, 1)
    subs = frame(
        "id STRING, company_id BIGINT, status STRING, current_period_start DATE, current_period_end DATE, "
        "cancel_at DATE, canceled_at DATE",
        [
            ("a", 1, "Active", start, date(2025, 2, 1), None, None),
            ("b", 1, "active", start, None, None, None),
            ("c", 1, "active", start, date(2025, 2, 1), date(2025, 1, 20), date(2025, 1, 15)),
            ("d", 1, "canceled", start, None, None, None),
            ("e", None, "active", start, None, None, None),
        ],
    )
    items = frame(
        "subscription_id STRING, plan_tier_id STRING, platform_product_id STRING, quantity INT",
        [("a", "t1", "p", 0), ("b", "t2", "p", None), ("c", "t3", "p", 4), ("a", "t1", "q", 9), ("d", "t1", "p", 1),
         ("e", "t1", "p", 1), ("a", "gone", "p", 1)],
    )
    tiers = frame("id STRING, name STRING, display_name STRING", [("t1", "n1", ""), ("t2", None, None), ("t3", "n3", "Pro")])
    got = sorted(weekly.connect_items(subs, items, tiers, "p", as_of).collect(), key=lambda r: r.period_end)
    assert got == [
        (1, "n3", "Pro", start, date(2025, 1, 15), 4),
        (1, "n1", "n1", start, date(2025, 2, 1), 1),
        (1, None, "Unknown Plan", start, as_of, 1),
    ]


def brute_licences(items, start, as_of):
    first, last = calendar_bounds(start, as_of)
    totals = defaultdict(int)
    week = first
    while week <= last:
        for company, name, display, begin, end, qty in items:
            if begin is not None and end is not None and begin <= week <= end:
                totals[(week, company, name, display)] += qty
        week += timedelta(days=7)
    return sorted(((*k, v) for k, v in totals.items()), key=str)


def test_licence_sweep_equals_range_join(frame):
    rng = random.Random(7)
    base = date(2025, 1, 1)
    items = []
    for _ in range(300):
        begin = base + timedelta(days=rng.randint(-60, 120))
        end = begin + timedelta(days=rng.choice([-5, 0, 1, 3, 6, 7, 30, 4000]))
        name = rng.choice(["n1", "n2", None])
        items.append((rng.choice([1, 1, 1, 2]), name, rng.choice(["A", "B"]), begin, end, rng.choice([1, 2, -1, 5])))
    items += [(3, "n", "A", None, base, 1), (3, "n", "A", base, None, 1)]
    df = frame(
        "companyId BIGINT, plan_tier_name STRING, plan_tier_display_name STRING, period_start DATE, period_end DATE, "
        "license_qty INT",
        items,
    )
    start, as_of = date(2024, 12, 25), date(2025, 4, 1)
    got = weekly.connect_licenses_weekly(df, start, as_of).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_licences(items, start, as_of)


def test_marketplace(frame):
    installs = frame(
        "id STRING, userId STRING, userType STRING, installedByUserId STRING, appId STRING, createdAt TIMESTAMP_NTZ, "
        "updatedAt TIMESTAMP_NTZ, deletedAt TIMESTAMP_NTZ",
        [
            ("1", "u1", "organization", " u2 ", "a", MON, MON, None),
            ("2", "u1", "USER", "u2", "a", SUN, MON, None),
            ("3", "u1", None, "u2", "a", SUN, MON, None),
            ("4", "u1", "USER", "u2", "a", SUN, MON, SUN),
            ("5", "u1", "USER", "u2", "gone", SUN, MON, None),
        ],
    )
    apps = frame("id STRING, name STRING", [("a", "Slack")])
    got = weekly.marketplace_installations(installs, apps, "2025-01-01").collect()
    assert {(r.installation_id, r.mapping_user_id) for r in got} == {("1", "u2"), ("2", "u1"), ("3", "u1")}
    assert {r.week_end_sunday for r in got} == {WEEK} and {r.app_name for r in got} == {"Slack"}
    assert weekly.marketplace_installations(installs, apps, "2025-01-01").columns == [
        "installation_id",
        "userId",
        "userType",
        "installedByUserId",
        "mapping_user_id",
        "appId",
        "app_name",
        "installed_at",
        "installed_date",
        "week_end_sunday",
        "updatedAt",
    ]


def test_workflow_documents(frame):
    logs = frame(
        "company STRUCT<id: BIGINT, name: STRING>, createdAt TIMESTAMP, total BIGINT",
        [
            ((1, "A"), MON, 2),
            ((1, "A"), SUN, None),
            ((1, None), MON, None),
            ((None, "X"), MON, 5),
            (None, MON, 5),
            ((1, "A"), datetime(2024, 1, 1), 9),
        ],
    )
    got = weekly.workflow_executions_weekly(logs, "2025-01-01").collect()
    assert sorted((tuple(r) for r in got), key=str) == [(1, "A", WEEK, 2), (1, None, WEEK, 0)]


def test_daily_active_users(frame):
    day = timedelta(days=1)
    events = frame(
        "companyId BIGINT, referenceId STRING, createdAt TIMESTAMP_NTZ",
        [
            (1, "u", MON),
            (1, "u", MON + timedelta(hours=5)),
            (1, "u", MON + day),
            (1, "v", SUN),
            (1, "u", MON + 7 * day),
            (1, None, MON),
            (None, "u", MON),
        ],
    )
    got = sorted(weekly.daily_active_users_weekly(events, "2025-01-01").collect())
    assert got == [(1, WEEK, 3, 2), (1, WEEK + timedelta(days=7), 1, 1)]


def test_jobs_and_groups(frame):
    events = frame("companyId BIGINT, referenceId STRING, createdAt TIMESTAMP_NTZ", [(1, "u", MON)])
    others = ("workflow", "billing", "connect", "kyc", "hil_gov", "marketplace", "signups")
    jobs = weekly_jobs({"ai_users": events}, Settings(date(2025, 1, 1), date(2025, 2, 1), "p"), without=others)
    assert list(jobs) == ["dau"] and jobs["dau"].count() == 1
    assert job_group("rest") == ("signups", "workflow", "dau")
    assert job_group("kyc_and_billing") == ("billing", "connect", "kyc", "hil_gov")
    with pytest.raises(ValidationError, match="No group is called 'x'"):
        job_group("x")
    with pytest.raises(ValidationError, match="No query is called kyc"):
        select_jobs(jobs, ["dau", "kyc"])


def test_start_accepts_each_time_type(frame):
    for kind, value in (("TIMESTAMP", MON), ("TIMESTAMP_NTZ", MON), ("DATE", MON.date())):
        events = frame(f"companyId BIGINT, referenceId STRING, createdAt {kind}", [(1, "u", value)])
        assert weekly.daily_active_users_weekly(events, date(2025, 1, 6)).count() == 1
        assert weekly.daily_active_users_weekly(events, date(2025, 1, 7)).where(F.lit(True)).count() == 0


def test_totals_with_fractions_or_text(frame):
    schema = "company STRUCT<id: STRING, name: STRING>, createdAt TIMESTAMP_NTZ, total STRING"
    when = datetime(2025, 1, 7)
    rows = [(("1", "a"), when, t) for t in ("0.5", "0.4", "2.2", "none", None)]
    assert weekly.workflow_executions_weekly(frame(schema, rows), "2025-01-01").first()["execution_count"] == pytest.approx(3.1)
