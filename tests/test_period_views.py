import math
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import ValidationError
from accountpulse.operators import period, views

W = [date(2025, 1, 5) + timedelta(days=7 * i) for i in range(8)]
INF = float("inf")
WEEK = "week_end_sunday"
BASE = "companyId STRING, companyName STRING, week_end_sunday DATE"


def table(frame, rows, extra="execution_count BIGINT"):
    return frame(f"{BASE}, {extra}", [(r[0], f"N{r[0]}", *r[1:]) for r in rows])


# --- Periods ----------------------------------------------------------------


def test_metric_columns():
    columns = [
        "connect_plan_b", "connect_plan_a", "connect_plan_list", "connect_plan_a_wow", "kyc_total",
        "kyc_liveness_total", "kyc_liveness_approved", "kyc_sessions_total", "marketplace_app_x", "MARKETING",
    ]
    assert period.metric_columns(columns, "plan") == ["connect_plan_a", "connect_plan_b"]
    assert period.metric_columns(columns, "stage") == ["kyc_liveness_total"]
    assert period.metric_columns(columns, "status") == ["kyc_liveness_approved"]
    assert period.metric_columns(columns, "app") == ["marketplace_app_x"]
    assert period.metric_columns(columns, "message") == ["MARKETING"]
    assert period.metric_columns(["kyc_liveness_x_total"], "stage") == ["kyc_liveness_x_total"]


def test_load_merged_from_text(frame):
    df = frame(
        "companyId STRING, companyName STRING, week_end_sunday STRING, execution_count STRING, signups STRING",
        [("1", None, "2025-01-05", "x", "3"), ("1", "A", "2025-01-12", "2.0", None)],
    )
    got = period.load_merged(df).orderBy(WEEK).collect()
    assert got == [("1", "Unknown", W[0], 0.0, 3.0), ("1", "A", W[1], 2.0, 0.0)]


def test_totals_take_signups_once(frame):
    rows = [(str(c), w, 1, 5) for c in range(20) for w in W[:5]]
    df = table(frame, rows, "execution_count BIGINT, signups BIGINT")
    weeks = period.weekly_totals(df).orderBy(WEEK).collect()
    assert [tuple(r) for r in weeks] == [(w, 20, 5) for w in W[:5]]
    months = period.monthly_totals(df).orderBy("month_start").collect()
    assert [tuple(r) for r in months] == [(date(2025, 1, 1), 80, 20), (date(2025, 2, 1), 20, 5)]


def test_monthly_companies(frame):
    df = frame(
        f"{BASE}, execution_count BIGINT, connect_plan_list STRING",
        [("1", "Old", W[0], 1, "B, A"), ("1", "New", W[1], 2, " A ,C"), ("1", "Next", W[4], 4, "")],
    )
    got = sorted(tuple(r) for r in period.monthly_companies(df).collect())
    assert got == [("1", date(2025, 1, 1), 3, "Old", "A, B, C"), ("1", date(2025, 2, 1), 4, "Next", "")]


def test_weekly_plan_lists(frame):
    df = frame("connect_plan_list STRING", [("B, A,B",), ("",), (None,)])
    assert [r[0] for r in period.weekly_companies(df).collect()] == ["A, B", "", ""]


def test_period_change_follows_observed_rows(frame):
    df = table(frame, [("1", W[0], 0), ("1", W[1], 5), ("1", W[4], 10), ("2", W[4], 7), ("1", W[5], 0), ("1", W[6], 0)])
    changed = period.period_change(df, ["execution_count", "absent"], WEEK)
    got = [r[0] for r in changed.where("companyId = '1'").orderBy(WEEK).select("execution_count_wow").collect()]
    assert got == [None, INF, 100.0, -100.0, None]
    assert changed.where("companyId = '2'").first()["execution_count_wow"] is None


def test_total_change(frame):
    totals = frame("week_end_sunday DATE, signups BIGINT", [(W[1], 6), (W[0], 4), (W[2], 3)])
    got = period.total_change(totals, "signups", WEEK).orderBy(WEEK).collect()
    assert got == [(W[0], 4, None), (W[1], 6, 50.0), (W[2], 3, -50.0)]


def test_periods(frame):
    df = table(frame, [("1", W[0], 1), ("2", W[0], 1), ("1", W[1], 1)])
    assert sorted(r[0] for r in period.available_periods(df, WEEK).collect()) == W[:2]
    assert period.latest_period(df, WEEK) == W[1]
    assert period.at_period(df, WEEK, None).count() == 1
    with pytest.raises(ValidationError):
        period.latest_period(df.where("false"), WEEK)
    with pytest.raises(ValueError):
        period.company_periods(df, "daily")
    assert period.period_totals(df, "monthly").count() == 1


# --- Views ------------------------------------------------------------------


def test_overview(frame):
    df = table(frame, [("1", W[0], 1, 3), ("2", W[0], 2, 3), ("1", W[1], 5, 4)], "execution_count BIGINT, signups BIGINT")
    totals = period.weekly_totals(df)
    assert views.overview_row(totals, df, WEEK, W[0]).collect() == [(W[0], 3, 3, 2)]
    assert views.overview_row(totals, df, WEEK).collect() == [(W[1], 5, 4, 1)]
    assert views.overview_row(totals, df, WEEK, W[5]).collect() == []


def test_series_leaves_out_unused_apps(frame):
    totals = frame(
        "week_end_sunday DATE, marketplace_app_a BIGINT, marketplace_app_hubspot BIGINT",
        [(W[0], 0, 1), (W[1], 0, 0)],
    )
    got = views.metric_series(totals, "app", WEEK).orderBy(WEEK).collect()
    assert got == [(W[0], "marketplace_app_hubspot", 1, "HubSpot"), (W[1], "marketplace_app_hubspot", 0, "HubSpot")]


def test_top_companies_ties(frame):
    df = table(frame, [(str(i), W[0], 5) for i in range(1, 13)])
    got = [r.companyId for r in views.top_companies(df, WEEK).collect()]
    assert got == [str(i) for i in range(1, 11)]


def test_directory(frame):
    df = frame(BASE, [("2", "B", W[0]), ("2", "A", W[1]), ("10", "A", W[0]), ("9", "A", W[0]), ("3", None, W[0])])
    assert views.company_directory(df, WEEK).collect() == [("9", "A"), ("10", "A"), ("2", "B")]


def test_history_rounds_half_even(frame):
    df = table(frame, [("1", W[0], 80000), ("1", W[1], 80100), ("2", W[0], 1)])
    changed = period.period_change(df, ["execution_count"], WEEK)
    got = views.company_history(changed, "1", WEEK).collect()
    assert got == [(W[0], 80000, None), (W[1], 80100, 0.12)]


def test_snapshot_falls_back_to_latest(frame):
    df = table(frame, [("1", W[0], 1), ("1", W[2], 3), ("2", W[1], 5)])
    changed = period.period_change(df, ["execution_count"], WEEK)
    got = {r.companyId: r for r in views.company_snapshot(changed, WEEK, W[0]).collect()}
    assert (got["1"].latest_period, got["1"].latest_execution_count, got["1"].selected_execution_count) == (W[2], 3, 1)
    assert (got["2"].selected_period, got["2"].selected_execution_count) == (W[1], 5)
    assert got["1"].latest_execution_count_wow == 200.0 and got["1"].selected_execution_count_wow is None
    one = views.company_snapshot(changed, WEEK, company_id="2").collect()
    assert len(one) == 1 and one[0].selected_period == W[1]


def test_active_items(frame):
    df = table(
        frame,
        [("1", W[0], 1, 5, 0), ("1", W[1], 9, 9, 9), ("2", W[1], 0, 2, 0)],
        "connect_plan_a BIGINT, connect_plan_b BIGINT, connect_plan_c BIGINT",
    )
    got = [(r.companyId, r.item, r.value, r.label) for r in views.active_items(df, WEEK, "plan", W[0]).collect()]
    assert got == [
        ("1", "connect_plan_b", 5, "B"),
        ("1", "connect_plan_a", 1, "A"),
        ("2", "connect_plan_b", 2, "B"),
    ]


HIL = [
    "kyc_sessions_total", "gov_validated", "gov_not_validated",
    "hil_doccheck_total", "hil_doccheck_approved", "hil_doccheck_disapproved",
    "hil_liveness_total", "hil_liveness_approved", "hil_liveness_disapproved",
    "hil_facematch_total", "hil_facematch_approved", "hil_facematch_disapproved",
]


def hil(frame, with_total=True):
    ddl = ", ".join(f"{c} BIGINT" for c in HIL) + (", kyc_total BIGINT" if with_total else "")
    rows = [
        ("1", W[0], 4, 3, 1, 8, 1, 7, 0, 0, 0, 2, 2, 0, 40),
        ("1", W[1], 4, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    ]
    return table(frame, rows if with_total else [r[:-1] for r in rows], ddl)


def test_gov_hil_rates(frame):
    got = views.gov_hil_rates(hil(frame), WEEK).orderBy(WEEK).collect()
    first = got[0]
    assert (first.gov_total_queries, first.gov_validation_rate_pct) == (4, 75.0)
    assert (first.hil_total_steps, first.hil_derivation_pct) == (10, 25.0)
    assert (first.hil_doccheck_approval_rate_pct, first.hil_liveness_approval_rate_pct) == (12.5, 0.0)
    assert got[1].gov_validation_rate_pct == 0.0 and got[1].hil_derivation_pct == 0.0
    without = views.gov_hil_rates(hil(frame, with_total=False), WEEK).orderBy(WEEK).first()
    assert without.hil_derivation_pct == 100.0
    with pytest.raises(ValidationError, match="hil_facematch_total"):
        views.gov_hil_rates(hil(frame).drop("hil_facematch_total"), WEEK)


def test_gov_hil_delta_and_breakdown(frame):
    got = views.gov_hil_delta(hil(frame), WEEK).orderBy(WEEK).collect()
    assert got[0].gov_validation_rate_pct_delta is None
    assert (got[1].gov_validation_rate_pct_delta, got[1].hil_total_steps_delta) == (-75.0, -10)
    rows = views.hil_breakdown(hil(frame), WEEK, W[0]).collect()
    assert [(r.step, r.hil_total, r.approved, r.disapproved, r.approval_pct) for r in rows] == [
        ("Document Check", 8, 1, 7, 12.5),
        ("Liveness", 0, 0, 0, 0.0),
        ("Facematch", 2, 2, 0, 100.0),
    ]
    assert {r.week_end_sunday for r in views.hil_breakdown(hil(frame), WEEK, W[5]).collect()} == {W[1]}


def values(frame, numbers):
    return table(frame, [(str(i), W[0], v) for i, v in enumerate(numbers)])


def test_histogram_edges(frame):
    df = values(frame, [0, 1, 2, 99, 100, 101, 5000, -1, None])
    got = {r.bin: (r.bin_start, r.bin_end, r.companies) for r in
           views.distribution_histogram(df, WEEK, "execution_count", W[0], threshold=100).collect()}
    assert got == {0: (None, 0.0, 1), 1: (0.0, 2.0, 2), 2: (2.0, 4.0, 1), 50: (98.0, 100.0, 2), 51: (100.0, None, 2)}


def test_distribution_against_python(frame):
    rng = random.Random(3)
    numbers = [0] * 30 + [int(rng.paretovariate(0.7)) for _ in range(90)] + [10**9]
    df = values(frame, numbers)
    row = views.distribution_stats(df, WEEK, "execution_count").first()
    assert row.companies == len(numbers) and (row.min, row.max) == (min(numbers), max(numbers))
    assert math.isclose(row.mean, statistics.mean(numbers), rel_tol=1e-12)
    assert row["median"] == statistics.median(numbers)
    assert math.isclose(row["std"], statistics.stdev(numbers), rel_tol=1e-9)
    q1, q2, q3 = statistics.quantiles(numbers, n=4, method="inclusive")
    box = views.distribution_box(df, WEEK, "execution_count").first()
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in numbers if low <= v <= high]
    assert (box.q1, box["median"], box.q3) == (q1, q2, q3)
    assert (box.lower_whisker, box.upper_whisker) == (min(inside), max(inside))
    assert box.outliers == len(numbers) - len(inside)


def test_single_company_has_no_deviation(frame):
    assert views.distribution_stats(values(frame, [5]), WEEK, "execution_count").first()["std"] is None


def test_power_users_and_normal(frame):
    df = values(frame, range(95, 115))
    high = views.power_users(df, WEEK, "execution_count", threshold=100).collect()
    assert [r.execution_count for r in high] == list(range(114, 104, -1))
    low = views.normal_top(df, WEEK, "execution_count", threshold=100).collect()
    assert [r.execution_count for r in low] == [100, 99, 98, 97, 96, 95]
    assert views.threshold_of("connect_licenses") == 200 and views.threshold_of("other") == 100000


def changes(frame):
    rows = []
    for i, (before, now) in enumerate([(100, 50), (100, 10), (1, 2), (0, 5), (0, 0), (10, 9), (1000, 900)]):
        rows += [(str(i), W[0], before), (str(i), W[1], now)]
    rows.append(("7", W[1], 70))
    return period.period_change(table(frame, rows), ["execution_count"], WEEK)


def test_scatter(frame):
    got = {r.companyId: (r.execution_count_wow, r.status) for r in
           views.change_scatter(changes(frame), WEEK, "execution_count").collect()}
    assert set(got) == {"0", "1", "2", "3", "5", "6"}
    assert got["3"] == (INF, "Growing") and got["0"] == (-50.0, "Declining")
    with pytest.raises(ValueError):
        views.change_scatter(changes(frame), WEEK, "signups")


def test_big_decliners_use_median_of_scatter(frame):
    got = views.big_decliners(changes(frame), WEEK, "execution_count").collect()
    assert [r.companyId for r in got] == ["1", "0", "6"]  # the scatter's median is 9.5


def test_gainers_and_decliners_fill_up_with_missing(frame):
    gainers = [r.companyId for r in views.top_gainers(changes(frame), WEEK, "execution_count").collect()]
    assert gainers[:2] == ["3", "2"] and gainers[-2:] == ["4", "7"] and len(gainers) == 8
    decliners = views.top_decliners(changes(frame), WEEK, "execution_count", n=7).collect()
    assert [r.companyId for r in decliners] == ["1", "0", "5", "6", "2", "3", "4"]
    assert views.top_gainers(changes(frame), WEEK, "execution_count", n=1).first().execution_count_wow == INF


def test_invariants_on_rollups(frame):
    rng = random.Random(1)
    rows = [(str(c), w, rng.randint(0, 9)) for c in range(5) for w in W]
    df = table(frame, rows)
    weekly = period.weekly_totals(df).agg(F.sum("execution_count")).first()[0]
    monthly = period.monthly_totals(df).agg(F.sum("execution_count")).first()[0]
    companies = period.monthly_companies(df).agg(F.sum("execution_count")).first()[0]
    assert weekly == monthly == companies == sum(r[2] for r in rows)


def test_fractions_are_kept(frame):
    schema = "companyId STRING, companyName STRING, week_end_sunday DATE, execution_count DOUBLE, marketplace_app_a DOUBLE"
    rows = frame(schema, [("1", "a", date(2025, 1, 5), 0.4, 0.5), ("2", "b", date(2025, 1, 5), 0.4, 0.0), ("3", "c", date(2025, 1, 5), 2.6, 3.9)])
    stats = views.distribution_stats(rows, "week_end_sunday", "execution_count").first()
    assert round(stats["mean"], 3) == 1.133 and round(stats["std"], 2) == 1.27 and stats["median"] == 0.4
    items = {r.companyId: r.value for r in views.active_items(rows, "week_end_sunday", "app").collect()}
    assert items == {"1": 0.5, "3": 3.9}
    series = views.metric_series(rows, "app", "week_end_sunday", ["companyId"])
    assert {r.companyId: r.value for r in series.collect()} == {"1": 0.5, "3": 3.9}
