"""Plans and skew: what must hold for the queries to run on very large, uneven tables."""

import re
from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accountpulse.operators import identity, merge, weekly
from accountpulse.operators.joins import left_lookup
from checks.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
MON = datetime(2025, 1, 6)


@contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_shuffles_each_frame_once_and_no_more(spark):
    week = F.expr("date_add(date'2025-01-05', cast(7 * (id % 3) as int))")
    base = spark.range(1000).select(
        (F.col("id") % 50).cast("string").alias("companyId"), week.alias("week_end_sunday"), "id"
    )
    frames = [base.groupBy("companyId", "week_end_sunday").agg(F.sum("id").alias(f"m{i}")) for i in range(4)]
    assert plan(merge.merge_company_week(frames)).count("Exchange hashpartitioning") == 4
    assert merge.merge_company_week(frames).count() == 150


def test_merge_hashes_numbers_and_shuffles_texts_with_them(spark):
    """No sorting, and frames with a text are shuffled once although they are used twice."""
    table = QUERIES["merged_weekly"](spark, SMALL)
    assert "SortAggregate" not in plan(table) and " Sort [" not in plan(table)
    rows = table.collect()
    final = plan(table)
    final = final[: final.index("Initial Plan")]
    # Seven frames and the sign-ups; the two frames with a text are read again, without a shuffle.
    assert final.count("ReusedExchange") == 2
    assert final.count("Exchange hashpartitioning") == 8 + 2, "a reused one is printed with what it reuses"
    assert len(rows) == len({(r.companyId, r.week_end_sunday) for r in rows})


def test_active_users_do_not_expand_rows(spark, frame):
    events = frame("companyId BIGINT, referenceId STRING, createdAt TIMESTAMP_NTZ", [(1, "u", MON)])
    text = plan(weekly.daily_active_users_weekly(events, "2025-01-01"))
    assert "Expand" not in text and text.count("Exchange") == 2


def test_scan_reads_needed_columns_and_filters(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(10).selectExpr(
        "id AS companyId", "timestamp_ntz'2025-01-06' AS createdAt", "'UTILITY' AS conversationType",
        "1 AS isBillable", "'x' AS payload",
    ).write.parquet(path)
    with conf(spark, spark__sql__maxMetadataStringLength="2000"):
        text = plan(weekly.session_billing_weekly(spark.read.parquet(path), "2025-01-01"))
    assert "GreaterThanOrEqual(createdAt" in text and "In(conversationType" in text
    assert "payload" not in text


def test_null_keys_are_spread_over_tasks(spark):
    rows = spark.range(20000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 100).alias("key"))
    lookup = spark.range(100).select("id", (F.col("id") * 2).alias("value"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):

        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

        spread = left_lookup(rows, lookup, "key", F.struct("id"))
        assert spread.count() == 20000 and spread.where("value IS NOT NULL").count() == 2000
        assert largest(spread) < 8000
        plain = rows.join(lookup.withColumnRenamed("id", "key"), "key", "left")
        assert largest(plain) > 16000
        assert sorted(spread.select("id", "value").collect(), key=str) == sorted(
            plain.select("id", "value").collect(), key=str
        )


def skewed_steps(spark, n=40000):
    """One session holds a third of all steps."""
    session = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 5000))
    return spark.range(0, n, 1, 8).select(
        session.alias("biometricId"),
        F.lit("liveness").alias("stepName"),
        F.when(F.col("id") % 2 == 0, "Approved").otherwise("Disapproved").alias("status"),
        F.lit(1).alias("enableHumanInLoop"),
        F.lit(None).cast("string").alias("documentCheckId"),
        F.lit(MON).cast("timestamp_ntz").alias("createdAt"),
    )


def test_hot_session_is_split_and_complete(spark):
    steps = skewed_steps(spark)
    ids = spark.range(5000).select(F.concat(F.lit("s"), F.col("id")).alias("id"))
    sessions = ids.union(spark.range(1).select(F.lit("hot"))).withColumn("companyId", F.lit(1))
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    ):
        got = weekly.kyc_steps_weekly(steps, sessions, "2025-01-01")
        assert {r.status: r.kyc_steps_count for r in got.collect()} == {"Approved": 20000, "Disapproved": 20000}
        assert "SortMergeJoin(skew=true)" in plan(got)


def test_hot_session_shrinks_before_the_join(spark):
    steps = skewed_steps(spark)
    sessions = spark.range(5000).select(F.concat(F.lit("s"), F.col("id")).alias("id"))
    sessions = sessions.union(spark.range(1).select(F.lit("hot"))).withColumn("companyId", F.lit(1))
    checks = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("entityResponse"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        got = weekly.kyc_hil_government_weekly(steps, sessions, checks, "2025-01-01")
        text = plan(got)
        row = got.first()
    assert (row.kyc_sessions_total, row.hil_liveness_total, row.hil_liveness_approved) == (5001, 40000, 20000)
    join = text.index("SortMergeJoin [biometricId")
    assert "partial_sum" in text[join:], "steps are aggregated below the join"


def test_hot_company_results_are_whole(spark):
    company = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("bigint")
    events = spark.range(30000).select(
        company.alias("companyId"),
        (F.col("id") % 70).cast("string").alias("referenceId"),
        (F.lit(MON) + F.make_interval(hours=(F.col("id") % 100).cast("int"))).cast("timestamp_ntz").alias("createdAt"),
    )
    expected, users = Counter(), {}
    for i in range(30000):
        c = 0 if i % 3 == 0 else i % 1000
        day = (MON + timedelta(hours=i % 100)).date()
        users.setdefault(c, set()).add((day, i % 70))
    for c, pairs in users.items():
        expected[c] = (len(pairs), len({u for _, u in pairs}))
    got = {
        r.companyId: (r.dau_count, r.unique_users_count)
        for r in weekly.daily_active_users_weekly(events, "2025-01-01").collect()
    }
    assert got == dict(expected)


FORBIDDEN = re.compile("BroadcastNestedLoopJoin|CartesianProduct|EvalPython|InPandas|MapInArrow")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    assert not FORBIDDEN.findall(plan(QUERIES[name](spark, SMALL)))


@pytest.mark.parametrize("name", ["change_scatter", "big_decliners", "top_gainers", "top_decliners"])
def test_changes_of_one_period_need_no_window(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Window" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["active_items", "active_plans", "kyc_status_detail", "hil_breakdown"])
def test_selected_rows_are_not_found_by_sorting(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, SMALL))


def enrichment(spark, hot=None, several=False):
    """Steps of four stages with the details that they name; ``hot`` is a check that a third of them share."""
    n = F.col("id")
    check = F.when(n % 4 == 0, n % 700) if hot is None else F.when(n % 3 == 0, F.lit(hot)).when(n % 4 == 0, n % 700)
    taken = F.lit(False) if several or hot is None else n % 3 == 0
    steps = spark.range(0, 30000, 1, 6).select(
        F.when(n % 17 != 0, n % 900).alias("biometricId"),
        F.concat(F.lit("stage"), n % 4).alias("stepName"),
        F.col("id").alias("createdAt"),
        check.alias("documentCheckId"),
        F.when((n % 4 == 1) & ~taken, n % 500).alias("livenessId"),
        F.when((n % 4 == 2) & ~taken, n % 300).alias("facematchId"),
    )
    sessions = spark.range(800).select("id", (F.col("id") * 3).alias("companyId"))
    checks = spark.range(600).select("id", (F.col("id") % 250).alias("documentIdentityId"), (F.col("id") % 2).alias("entityResponse"))
    identities = spark.range(200).select("id", F.concat(F.lit("land "), "id").alias("country"))
    liveness = spark.range(400).union(spark.range(5)).select("id", (F.col("id") + 7).alias("otpCode"))
    faces = spark.range(250).select("id", (F.col("id") % 101).alias("similarity"))
    return steps, sessions, checks, identities, liveness, faces


def chained(steps, sessions, checks, identities, liveness, faces):
    """A plain left join per table."""

    def named(df, prefix, key):
        return df.select(F.col("id").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != "id"])

    checks = named(checks, "document_check", "documentCheckId")
    checks = checks.join(named(identities, "identity", "document_check_documentIdentityId"), "document_check_documentIdentityId", "left")
    out = steps.join(named(sessions, "session", "biometricId"), "biometricId", "left")
    out = out.join(checks, "documentCheckId", "left").join(named(liveness, "liveness", "livenessId"), "livenessId", "left")
    return out.join(named(faces, "facematch", "facematchId"), "facematchId", "left")


@pytest.mark.parametrize("several", [False, True])
def test_steps_travel_under_the_one_detail_they_have(spark, several):
    tables = enrichment(spark, hot=5, several=several)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        got = identity.steps_enriched(*tables)
        text = plan(got)
    if not several:
        # Steps twice; sessions, checks, identities and all details stacked once each.
        assert text.count("Exchange hashpartitioning") == 6 and text.count("SortMergeJoin") == 3
    want = chained(*tables).select(got.columns)
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_hot_check_is_split_and_complete(spark):
    tables = enrichment(spark, hot=5)
    with conf(
        spark,
        spark__sql__shuffle__partitions="40",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    ):
        got = identity.steps_enriched(*tables, several=False)
        assert got.where("document_check_entityResponse IS NOT NULL").count() > 10000
        rows = got.agg(F.count("*"), F.count("identity_country")).first()
        got.collect()
        assert "SortMergeJoin(skew=true)" in plan(got)
    assert rows[0] == chained(*tables).count()


def test_steps_without_some_details(spark):
    steps, sessions, checks, identities, liveness, faces = enrichment(spark)
    assert identity.steps_enriched(steps, sessions).columns == [*steps.columns, "session_companyId"]
    got = identity.steps_enriched(steps, sessions, liveness=liveness)
    assert got.where("liveness_otpCode IS NOT NULL").count() == chained(*enrichment(spark)).where("liveness_otpCode IS NOT NULL").count()


def outcomes(spark):
    """Steps of sessions over several weeks; some checks have two answers and some sessions two companies."""
    n = F.col("id")
    steps = spark.range(0, 6000, 1, 5).select(
        F.when(n % 13 != 0, F.concat(F.lit("s"), n % 70)).alias("biometricId"),
        F.element_at(F.array(*map(F.lit, ["document_check", "liveness", "facematch", "otp"])), (n % 4 + 1).cast("int")).alias("stepName"),
        F.when(n % 3 == 0, "Approved").when(n % 3 == 1, "Disapproved").when(n % 7 != 0, "Fraud").alias("status"),
        F.when(n % 5 != 0, (n % 2).cast("int")).alias("enableHumanInLoop"),
        F.when(n % 11 != 0, n % 40).alias("documentCheckId"),
        (F.lit(MON) + F.make_interval(days=(n % 23).cast("int"))).cast("timestamp_ntz").alias("createdAt"),
    )
    sessions = spark.range(80).where("id % 9 <> 0").union(spark.range(3)).select(
        F.concat(F.lit("s"), "id").alias("id"), F.when(F.col("id") % 8 != 0, F.col("id") % 6).alias("companyId")
    )
    checks = spark.range(30).select("id", F.when(F.col("id") % 4 != 0, F.col("id") % 3).cast("int").alias("entityResponse"))
    return steps, sessions, checks.union(spark.range(5).selectExpr("id", "1")).union(spark.range(1).selectExpr("CAST(NULL AS BIGINT)", "1"))


def test_steps_are_counted_by_outcome_before_the_session_join(spark):
    """One count per group below the join, not a sum for each reported column."""
    tables = outcomes(spark)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        got = weekly.kyc_hil_government_weekly(*tables, "2025-01-01")
        text = plan(got)
    below = text[text.index("SortMergeJoin [biometricId"):]
    functions = re.findall(r"HashAggregate\(keys=\[biometricId.*?functions=\[(.*?)\](?:, output|\))", below)
    assert functions and all(len(re.findall(r"(?:sum|count)\(", f)) == 1 for f in functions)

    steps, sessions, checks = ([r.asDict() for r in df.collect()] for df in tables)
    want, seen = {}, set()
    for s in steps:
        if s["stepName"] == "otp":
            continue
        week = (s["createdAt"] + timedelta(days=6 - s["createdAt"].weekday())).date()
        check = s["documentCheckId"] if s["stepName"] == "document_check" else None
        answers = [c["entityResponse"] for c in checks if check is not None and c["id"] == check] or [None]
        for owner in (o["companyId"] for o in sessions if o["id"] == s["biometricId"] and o["companyId"] is not None):
            row = want.setdefault((owner, week), Counter())
            row["kyc_sessions_total"] += (s["biometricId"], week) not in seen
            for answer in answers:
                row["gov_validated"] += answer == 1
                row["gov_not_validated"] += answer == 0
                if s["enableHumanInLoop"] == 1:
                    short = s["stepName"].replace("document_check", "doccheck")
                    row[f"hil_{short}_total"] += 1
                    row[f"hil_{short}_approved"] += s["status"] == "Approved"
                    row[f"hil_{short}_disapproved"] += s["status"] == "Disapproved"
        seen.add((s["biometricId"], week))
    rows = {(r.companyId, r.week_end_sunday): r.asDict() for r in got.collect()}
    assert rows.keys() == want.keys() and len(rows) > 10
    for key, row in rows.items():
        assert row["companyName"] == f"Company {key[0]}"
        for name, value in row.items():
            if name not in ("companyId", "companyName", "week_end_sunday"):
                assert value == want[key][name], (key, name)


def test_items_are_not_sorted_for_their_subscriptions(spark):
    """A hot subscription, repeated ids on either side and items without a subscription; all links are kept."""
    as_of = MON.date()
    subscriptions = spark.range(300).union(spark.range(4)).select(
        F.when(F.col("id") != 299, F.col("id")).alias("id"), (F.col("id") % 9).alias("company_id"),
        F.when(F.col("id") % 5 != 0, "active").otherwise("canceled").alias("status"),
        *[F.lit(as_of).alias(c) for c in ("current_period_start", "current_period_end", "cancel_at", "canceled_at")],
    )
    n = F.col("id")
    items = spark.range(0, 9000, 1, 5).select(
        F.when(n % 3 == 0, 1).when(n % 10 != 0, n % 400).alias("subscription_id"), (n % 3).alias("plan_tier_id"),
        F.lit("p").alias("platform_product_id"), F.lit(2).alias("quantity"),
    )
    tiers = spark.range(3).select("id", F.lit("basic").alias("name"), F.lit("").alias("display_name"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        got = weekly.connect_items(subscriptions, items, tiers, "p", as_of)
        text = plan(got)
        rows = Counter(r.companyId for r in got.collect())
    assert "ShuffledHashJoin [subscription_id" in text and "SortMergeJoin [subscription_id" not in text
    held = Counter(r.subscription_id for r in items.collect() if r.subscription_id is not None)
    want = Counter()
    for r in subscriptions.collect():
        if r.status == "active" and held[r.id]:
            want[r.company_id] += held[r.id]
    assert rows == want and max(want.values()) > 3000
