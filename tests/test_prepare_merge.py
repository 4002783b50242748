from datetime import date
from functools import reduce

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import ValidationError
from accountpulse.operators import clean, merge, prepare, quality
from accountpulse.plans.jobs import Settings
from accountpulse.plans.pipeline import merge_exports, read_exports, write_exports
from accountpulse.sources.contracts import EXPORTS, HIL_GOV_METRICS

W1, W2 = date(2025, 1, 5), date(2025, 1, 12)


def dicts(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


# --- Cleaning ---------------------------------------------------------------


def test_bad_weeks_reject_the_source(frame):
    df = frame("week_end_sunday STRING, n INT", [("2025-01-05", 1), ("not a date", 1), (None, 1)])
    with pytest.raises(ValidationError, match="dau: 2 cells of week_end_sunday hold no date"):
        clean.normalize_week(df, "dau")
    good = clean.normalize_week(frame("week_end_sunday STRING", [("2025-01-05 10:00:00",)]), "dau")
    assert good.collect() == [(W1,)]


def test_bad_numbers_reject_the_source(frame):
    df = frame("a STRING, b INT", [("1", 1), ("x", 2), ("", None)])
    with pytest.raises(ValidationError, match="2 cells of a hold no number"):
        clean.to_numeric_strict(df, ["a", "b", "absent"], "s")
    with pytest.raises(ValidationError, match="1 cells of b hold no number"):
        clean.to_numeric_strict(df, ["b"], "s")
    assert clean.to_numeric_strict(frame("a STRING", [("2.5",)]), ["a"], "s").collect() == [(2.5,)]
    assert clean.to_numeric_fill0(df, ["a", "b"]).collect() == [(1.0, 1), (0.0, 2), (0.0, 0)]


def test_plan_label_uses_first_existing_column(frame):
    both = frame("plan_tier_display_name STRING, plan_tier_name STRING", [("  ", "n"), (" Pro ", "n"), (None, "n")])
    got = [r[0] for r in both.select(clean.connect_plan_label(both)).collect()]
    assert got == ["Unknown Plan", "Pro", "Unknown Plan"]
    only = both.select("plan_tier_name")
    assert only.select(clean.connect_plan_label(only)).first()[0] == "n"
    assert clean.connect_plan_label(frame("x INT", [(1,)])) is None


INSTALLS = "userId STRING, userType STRING, installedByUserId STRING, app_name STRING, installed_at STRING"


def installs(frame):
    return frame(
        INSTALLS,
        [
            ("u1", "USER", None, "Slack", "2025-01-06 10:00:00"),
            ("u1", "organization", "u2", " Slack ", "2025-01-12"),
            ("u1", "ORGANIZATION", "  ", "Slack", "2025-01-12"),
            ("u1", "USER", None, " ", "2025-01-12"),
            ("u1", "USER", None, "Slack", "never"),
            ("u9", "USER", None, "SLACK", "2025-01-12"),
            ("u3", "USER", None, "slack", "2025-01-12"),
        ],
    )


def mapping(frame):
    return frame("userId STRING, companyId STRING", [(" u1 ", "7.0"), ("u2", "7"), ("u3", "n/a")])


def test_install_cleaning_and_matching(frame):
    cleaned = clean.drop_invalid_installs(installs(frame))
    assert sorted(r.mapping_user_id for r in cleaned.collect()) == ["u1", "u2", "u3", "u9"]
    attached = clean.attach_company(cleaned, mapping(frame))
    assert [(r.mapping_user_id, r.companyId) for r in attached.orderBy("mapping_user_id").collect()] == [
        ("u1", "7"),
        ("u2", "7"),
    ]
    assert clean.match_counts(cleaned, mapping(frame)).collect() == [(2, 2)]


def test_given_owner_column_is_kept(frame):
    df = frame("mapping_user_id STRING, " + INSTALLS, [(" m ", "u1", "USER", None, "Slack", "2025-01-12")])
    assert clean.drop_invalid_installs(df).first()["mapping_user_id"] == "m"


# --- Prepare ----------------------------------------------------------------


def test_workflow_names(frame):
    df = frame(
        "companyId STRING, companyName STRING, week_end_sunday DATE, execution_count BIGINT",
        [("1", "B", W1, 1), ("1.0", "A", W1, 2), ("2", None, W1, 3), ("2", "A", W1, 4), (None, "X", W1, 9)],
    )
    assert sorted(prepare.prepare_workflow(df).collect()) == [("1", W1, "A", 3), ("2", W1, "Unknown", 7)]
    unnamed = prepare.prepare_workflow(df.drop("companyName")).collect()
    assert {r.companyName for r in unnamed} == {"Unknown"}


def test_billing_pivot(frame):
    df = frame(
        "companyId BIGINT, week_end_sunday STRING, conversationType STRING, billable_count BIGINT",
        [
            (1, "2025-01-05", " marketing ", 1),
            (1, "2025-01-05", "MARKETING_LITE", 2),
            (1, "2025-01-12", "SERVICE", 5),
            (2, "2025-01-05", "UTILITY", 4),
        ],
    )
    got = prepare.prepare_billing(df)
    assert got.columns == ["companyId", "week_end_sunday", "MARKETING", "UTILITY", "AUTHENTICATION"]
    assert sorted(got.collect()) == [("1", W1, 3, 0, 0), ("2", W1, 0, 4, 0)]


def test_connect_pivot_sums_colliding_names(frame):
    df = frame(
        "companyId STRING, week_end_sunday DATE, plan_tier_display_name STRING, connect_licenses BIGINT",
        [("1", W1, "Pro+", 1), ("1", W1, "pro", 2), ("1", W1, "Basic", 0), ("1", W2, None, 5), ("1", W2, "Pro+", 1)],
    )
    got = {r.week_end_sunday: r.asDict() for r in prepare.prepare_connect(df).collect()}
    assert got[W1] == {
        "companyId": "1",
        "week_end_sunday": W1,
        "connect_plan_basic": 0,
        "connect_plan_pro": 3,
        "connect_plan_unknown_plan": 0,
        "connect_licenses": 3,
        "connect_plan_list": "Pro+, pro",
    }
    assert (got[W2]["connect_plan_unknown_plan"], got[W2]["connect_licenses"]) == (5, 6)
    assert got[W2]["connect_plan_list"] == "Pro+, Unknown Plan"


def test_connect_without_labels(frame):
    df = frame("companyId STRING, week_end_sunday DATE, connect_licenses BIGINT", [("1", W1, 2), ("1", W1, 3)])
    assert prepare.prepare_connect(df).collect() == [("1", W1, 5)]


KYC = "companyId STRING, week_end_sunday DATE, stepName STRING, status STRING, kyc_steps_count BIGINT"


def test_kyc_rollups(frame):
    df = frame(
        KYC,
        [
            ("1", W1, "Liveness", "Approved", 1),
            ("1", W1, "liveness ", "approved", 2),
            ("1", W1, "facematch", "In Review", 4),
            ("1", W1, "nan", "Approved", 8),
            ("1", W1, "facematch", None, 16),
            ("2", W1, "selfie", "---", 3),
        ],
    )
    got = {r.companyId: r.asDict() for r in prepare.prepare_kyc(df).collect()}
    assert {k: v for k, v in got["1"].items() if k.startswith("kyc_")} == {
        "kyc_facematch_in_review": 4,
        "kyc_liveness_approved": 3,
        "kyc_selfie_unknown": 0,
        "kyc_document_check_total": 0,
        "kyc_facematch_total": 4,
        "kyc_liveness_total": 3,
        "kyc_selfie_total": 0,
        "kyc_total": 7,
    }
    assert got["2"]["kyc_total"] == got["2"]["kyc_selfie_total"] == 3


@pytest.mark.parametrize("limit", [200, 0])
def test_names_that_meet(frame, monkeypatch, limit):
    """Every step is in one status column and one total, on both sides of the number of labels."""
    monkeypatch.setattr(prepare, "FEW_LABELS", limit)
    df = frame(
        KYC,
        [
            ("1", W1, "a", "b_total", 3),
            ("1", W1, "a_b", "x", 5),
            ("1", W1, "a", "total", 7),
            ("1", W1, "a_b", "total", 11),
            ("1", W1, "a", "b total status", 13),
            ("1", W1, "a b", "c", 17),
            ("1", W1, "a", "b_c", 19),
        ],
    )
    (row,) = prepare.prepare_kyc(df).collect()
    got = {k: v for k, v in row.asDict().items() if k.startswith("kyc_") and v}
    assert got == {
        "kyc_a_total": 42,
        "kyc_a_b_total": 33,
        "kyc_a_b_x": 5,
        "kyc_a_total_status": 7,
        "kyc_a_b_total_status_status": 14,
        "kyc_a_b_total_status": 13,
        "kyc_a_b_c": 36,
        "kyc_total": 75,
    }


def test_empty_kyc_is_typed(frame):
    empty = prepare.prepare_kyc(frame(KYC, []))
    assert empty.isEmpty()
    assert set(empty.columns) == {
        "companyId",
        "week_end_sunday",
        "kyc_document_check_total",
        "kyc_liveness_total",
        "kyc_facematch_total",
        "kyc_total",
    }


def test_hil_is_lenient(frame):
    df = frame(
        "companyId STRING, week_end_sunday DATE, gov_validated STRING, hil_liveness_total BIGINT",
        [("1", W1, "2", None), ("1", W1, "bad", 3)],
    )
    row = prepare.prepare_hil_gov(df).first().asDict()
    assert (row["gov_validated"], row["hil_liveness_total"], row["kyc_sessions_total"]) == (2, 3, 0)
    assert [c for c in row if c in HIL_GOV_METRICS] == list(HIL_GOV_METRICS)


def test_marketplace_forms(frame):
    long = prepare.marketplace_long(installs(frame), mapping(frame))
    assert long.collect() == [("7", W2, "Slack", 2, "marketplace_app_slack")]
    both = long.union(long.withColumn("app_name", F.lit("SLACK")))
    assert prepare.marketplace_wide(both).collect() == [("7", W2, 4, 4)]


def test_thousands_of_labels(spark):
    rows = spark.range(5000).selectExpr(
        "string(id % 7) AS companyId", "date'2025-01-05' AS week_end_sunday",
        "concat('plan ', id) AS plan_tier_display_name", "id AS connect_licenses",
    )
    wide = prepare.prepare_connect(rows)
    assert len(wide.columns) == 5004
    assert prepare.connect_long(rows).count() == 5000
    assert sorted(r.connect_licenses for r in wide.select("connect_licenses").collect()) == sorted(
        sum(range(k, 5000, 7)) for k in range(7)
    )
    one = wide.where("companyId = '3'").select("connect_plan_plan_3", "connect_plan_plan_4").first()
    assert tuple(one) == (3, 0)


def test_many_and_few_labels_agree(frame, monkeypatch):
    licences = frame(
        "companyId STRING, week_end_sunday DATE, plan_tier_display_name STRING, connect_licenses BIGINT",
        [("1", W1, "A b", 1), ("1", W1, "a-B", 2), ("1", W1, "c", 0), ("2", W1, "c", 4), ("2", W1, "A b", 5), ("2", W2, None, 1)],
    )
    steps = frame(
        "companyId STRING, week_end_sunday DATE, stepName STRING, status STRING, kyc_steps_count BIGINT",
        [("1", W1, "liveness", "Total", 3), ("1", W1, "Liveness", "ok", 4), ("2", W1, "other", "ok", 1), ("2", W1, None, "ok", 9)],
    )
    apps = frame(
        "companyId STRING, week_end_sunday DATE, app_name STRING, marketplace_install_count BIGINT",
        [("1", W1, "Slack", 2), ("1", W1, "SLACK", 3), ("2", W2, "x y", 1)],
    )

    def all_three():
        frames = [prepare.prepare_connect(licences), prepare.prepare_kyc(steps), prepare.marketplace_wide(apps)]
        return [sorted(map(str, (r.asDict() for r in f.select(sorted(f.columns)).collect()))) for f in frames]

    few = all_three()
    monkeypatch.setattr(prepare, "FEW_LABELS", 0)
    assert all_three() == few


# --- Merge ------------------------------------------------------------------


def frames(frame):
    a = frame("companyId STRING, week_end_sunday DATE, companyName STRING, execution_count BIGINT",
              [("1", W1, "A", 1), ("2", W1, "B", 2)])
    b = frame("companyId STRING, week_end_sunday DATE, MARKETING BIGINT", [("1", W1, 5), ("3", W2, 6)])
    c = frame("companyId STRING, week_end_sunday DATE, kyc_total BIGINT, connect_plan_list STRING",
              [("3", W2, 7, "Pro"), (None, W1, 9, "x")])
    return [a, b, c]


def test_merge_equals_outer_joins(frame):
    parts = frames(frame)
    keys = ["companyId", "week_end_sunday"]
    joined = reduce(lambda x, y: x.join(y, keys, "full_outer"), [p.where("companyId IS NOT NULL") for p in parts])
    merged = merge.merge_company_week(parts)
    assert dicts(merged.select(*joined.columns)) == dicts(joined)


def test_merge_refuses_shared_columns(frame):
    a, *_ = frames(frame)
    with pytest.raises(ValidationError, match="companyName, execution_count"):
        merge.merge_company_week([a, a])


def test_merged_table(frame):
    signups = frame(
        "week_end_sunday DATE, signups BIGINT, self_service BIGINT, enterprise BIGINT, other_plans BIGINT",
        [(W1, 4, 1, 1, 2), (date(2025, 1, 19), 9, 9, 0, 0)],
    )
    table = merge.merged_table(frames(frame), signups, W2)
    got = {r.companyId: r.asDict() for r in table.collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert (got["1"]["signups"], got["2"]["signups"], got["3"]["signups"]) == (4, 4, 0)
    assert got["3"]["companyName"] == "Unknown" and got["1"]["connect_plan_list"] == ""
    assert got["2"]["MARKETING"] == 0 and got["2"]["hil_liveness_total"] == 0 and got["2"]["kyc_liveness_total"] == 0
    assert table.columns[:4] == ["companyId", "companyName", "week_end_sunday", "execution_count"]
    assert not any(v is None for row in got.values() for v in row.values())
    assert merge.merged_table(frames(frame), signups, W2, include_today=False).count() == 2


# --- Quality ----------------------------------------------------------------


def test_grain(frame):
    df = frame("a STRING, b INT", [("x", 1), ("x", 1), ("x", 1), (None, 1), (None, 1), ("y", 1)])
    assert quality.grain_duplicates(df, ["a"]).first()[0] == 3
    with pytest.raises(ValidationError, match=r"s: 3 rows repeat the key \(a, b\)"):
        quality.check_grain(df, ["a", "b"], "s")
    assert quality.check_grain(df.distinct(), ["a", "b"], "s").count() == 3


def test_windows(frame):
    one = frame("week_end_sunday DATE", [(W1,), (W2,)])
    other = frame("week_end_sunday DATE", [(W1,)])
    empty = frame("week_end_sunday DATE", [])
    windows = quality.date_windows({"a": one, "b": one, "c": empty})
    assert sorted(windows.collect()) == [("a", W1, W2), ("b", W1, W2)]
    assert quality.check_windows(windows)
    with pytest.warns(UserWarning):
        assert not quality.check_windows(quality.date_windows({"a": one, "b": other}))
    with pytest.raises(ValidationError):
        quality.check_windows(quality.date_windows({"a": one, "b": other}), strict=True)


def test_summary(frame):
    df = frame("companyId STRING, week_end_sunday DATE", [("1", W1), ("1", W2), ("2", W1)])
    assert quality.merge_summary(df).collect() == [(3, 2, 2, 2, W2)]


def test_merge_only_run_from_files(spark, frame, tmp_path):
    """Exports written, read back by contract and merged, with optional ones absent."""
    exports = {
        "workflow": frame("companyId BIGINT, companyName STRING, week_end_sunday DATE, execution_count BIGINT",
                          [(1, "A", W1, 5)]),
        "dau": frame("companyId BIGINT, week_end_sunday DATE, dau_count BIGINT, unique_users_count BIGINT",
                     [(1, W1, 3, 2)]),
        "billing": frame("companyId BIGINT, week_end_sunday DATE, conversationType STRING, billable_count BIGINT",
                         [(2, W1, "UTILITY", 3)]),
        "connect": frame("companyId BIGINT, week_end_sunday DATE, plan_tier_name STRING, "
                         "plan_tier_display_name STRING, connect_licenses BIGINT", [(1, W1, "n", "Pro", 3)]),
        "signups": frame(EXPORTS["signups"].schema, [(W1, 1, 1, 0, 0)]),
    }
    write_exports(exports, str(tmp_path))
    table = merge_exports(read_exports(spark, str(tmp_path)), Settings(W1, W2, "p"))
    got = {r.companyId: r for r in table.collect()}
    assert (got["1"].execution_count, got["1"].connect_plan_pro, got["1"].kyc_total) == (5, 3, 0)
    assert (got["2"].UTILITY, got["2"].marketplace_install_total, got["2"].signups) == (3, 0, 1)


def test_a_second_row_for_a_key_ends_the_merge(frame):
    twice = frame("companyId STRING, week_end_sunday DATE, dau_count BIGINT", [("1", W1, 3), ("1", W1, 9)])
    other = frame("companyId STRING, week_end_sunday DATE, execution_count BIGINT", [("1", W1, 5)])
    with pytest.raises(Exception, match="several rows for company 1"):
        merge.merge_company_week([other, twice]).collect()
