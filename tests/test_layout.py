"""Checks that come from writing jobs, and reads of one period that open one folder."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import ValidationError
from accountpulse.operators import period, prepare, quality, views
from accountpulse.plans.jobs import Settings, select_jobs, weekly_jobs
from accountpulse.plans.pipeline import prepare_exports, run_weekly, stage_exports
from accountpulse.sources.staging import stage
from accountpulse.sources.writers import read_by_week, write_merged
from checks.registry import QUERIES
from checks.workspace import SETTINGS, catalog

SMALL = "/root/testdata/sf0.001"
WEEK = "week_end_sunday"


def jobs_of(spark, action):
    """Number of Spark jobs that an action runs, whatever threads it uses."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    result = action()
    return len(set(tracker.getJobIdsForGroup(None)) - before), result


def rows(spark, n=100):
    week = F.expr("date_add(date'2025-01-05', cast(7 * (id % 4) as int))")
    base = spark.range(0, n, 1, 3)
    return base.select((F.col("id") % 9).cast("string").alias("companyId"), week.alias(WEEK), F.col("id").alias("execution_count"))


def test_checks_come_from_the_write(spark):
    """As many jobs as a plain write, and none before the merge reads the export."""
    df = rows(spark)
    plain, _ = jobs_of(spark, lambda: stage(df, "plain"))
    seen, (written, profile) = jobs_of(spark, lambda: quality.stage_strict(df, ["execution_count"], "workflow"))
    assert seen == plain
    assert profile == quality.Profile(100, date(2025, 1, 5), date(2025, 1, 26))
    none, _ = jobs_of(spark, lambda: prepare.prepare_workflow(written, checked=True))
    some, _ = jobs_of(spark, lambda: prepare.prepare_workflow(written))
    assert none == 0 and some > 0


def test_run_reads_no_export_for_checks(spark):
    """Of all exports only those with columns by label are read before the merge, for the labels."""
    jobs = weekly_jobs(catalog(spark, SMALL), SETTINGS)
    names = ("workflow", "dau", "billing", "hil_gov", "signups")
    exports = stage_exports(select_jobs(jobs, names))
    count, prepared = jobs_of(spark, lambda: prepare_exports(exports))
    assert count == 0 and set(prepared) == set(names)
    count, agree = jobs_of(spark, lambda: quality.check_profiles({n: exports.profiles["dau"] for n in names}))
    assert count == 0 and agree
    unchecked, _ = jobs_of(spark, lambda: prepare_exports(dict(exports)))
    assert unchecked >= len(names)


@pytest.mark.parametrize(
    "column, value, message",
    [
        ("execution_count", "'x'", "workflow: 7 cells of execution_count hold no number"),
        ("execution_count", "null", "workflow: 7 cells of execution_count hold no number"),
        (WEEK, "'soon'", "workflow: 7 cells of week_end_sunday hold no date"),
    ],
)
def test_bad_cells_reject_the_export(spark, column, value, message):
    bad = rows(spark).withColumns({c: F.col(c).cast("string") for c in (WEEK, "execution_count")})
    bad = bad.withColumn(column, F.expr(f"if(execution_count in (1, 2, 3, 50, 51, 52, 53), {value}, {column})"))
    with pytest.raises(ValidationError, match=re.escape(message)):
        quality.stage_strict(bad, ["execution_count"], "workflow")
    with pytest.raises(ValidationError, match=re.escape(message)):
        prepare.prepare_workflow(bad)


def test_text_exports_are_written_typed(spark):
    text = rows(spark).select([F.col(c).cast("string").alias(c) for c in rows(spark).columns])
    written, profile = quality.stage_strict(text, ["execution_count"], "workflow")
    assert profile.rows == 100 and profile.last_week == date(2025, 1, 26)
    assert dict(written.dtypes)[WEEK] == "date"
    same = prepare.prepare_workflow(written, checked=True).collect()
    assert sorted(same, key=str) == sorted(prepare.prepare_workflow(text).collect(), key=str)


def test_empty_export(spark):
    written, profile = quality.stage_strict(rows(spark).where("false"), ["execution_count"], "workflow")
    assert profile == quality.Profile(0, None, None) and written.count() == 0
    assert quality.check_profiles({"workflow": profile, "dau": quality.Profile(3, date(2025, 1, 5), date(2025, 1, 5))})


def test_windows_of_profiles():
    a = quality.Profile(1, date(2025, 1, 5), date(2025, 1, 26))
    b = quality.Profile(1, date(2025, 1, 12), date(2025, 1, 26))
    with pytest.warns(UserWarning, match="same first and last week"):
        assert not quality.check_profiles({"a": a, "b": b})
    with pytest.raises(ValidationError):
        quality.check_profiles({"a": a, "b": b}, strict=True)


ONE_PERIOD = [
    "overview_row",
    "overview_latest",
    "top_companies",
    "distribution_histogram",
    "distribution_box",
    "distribution_stats",
    "power_users",
    "normal_top",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONE_PERIOD)
def test_one_period_prunes_folders(spark, name):
    """Every scan that reads a column of the table has a filter on the folders."""
    text = plan(QUERIES[name](spark, SMALL))
    filters = re.findall(r"FileScan parquet \[(.*?)\].*?PartitionFilters: \[(.*?)\]", text)
    assert filters
    assert all(WEEK in found for columns, found in filters if columns.count("#") > 1)


def by_week(spark, tmp_path, df):
    path = str(tmp_path / "by_week")
    write_merged(df, path, "parquet")
    return read_by_week(spark, path, df.schema)


def test_newest_week_reads_one_folder(spark, tmp_path):
    """The newest week is found by a scalar subquery, which prunes while the query runs."""
    table = by_week(spark, tmp_path, rows(spark, 400).withColumn("metric", F.col("execution_count")))
    newest = period.at_period(table, WEEK, None)
    assert newest.count() == 100
    assert re.search(r"PartitionFilters: \[[^\]]*Subquery", plan(newest))
    read = [n for n in _scans(newest) if n]
    assert min(read) == 1


def _scans(df):
    """Partitions read by each scan of a finished plan."""
    df.collect()
    found = []

    def walk(node):
        metrics = node.metrics()
        if metrics.contains("numPartitions") and node.nodeName().startswith("Scan parquet"):
            found.append(metrics.apply("numPartitions").value())
        children = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            children.append(node.plan())
        for i in range(node.children().size()):
            children.append(node.children().apply(i))
        for child in children:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_writing_by_week_keeps_columns_and_rows(spark, tmp_path):
    df = rows(spark).withColumn(WEEK, F.expr(f"if(execution_count = 5, null, {WEEK})"))
    written = by_week(spark, tmp_path, df)
    assert written.dtypes == df.dtypes
    assert sorted(written.collect(), key=str) == sorted(df.collect(), key=str)
    # No more files than weeks and tasks together.
    assert len(written.inputFiles()) <= 5 + 4


def test_a_large_week_is_written_by_several_tasks(spark, tmp_path):
    df = rows(spark, 20000).withColumn(WEEK, F.lit(date(2025, 1, 5))).withColumn("companyId", F.col("execution_count").cast("string"))
    assert len(by_week(spark, tmp_path, df).inputFiles()) == 4


def test_views_agree_on_both_layouts(spark, tmp_path):
    df = rows(spark).withColumn("companyName", F.lit("x"))
    flat, layered = stage(df, "flat"), by_week(spark, tmp_path, df)
    for value in (None, date(2025, 1, 12)):
        a = views.top_companies(flat, WEEK, value).collect()
        assert a == views.top_companies(layered, WEEK, value).collect()


def test_run_returns_the_table_by_week(spark, tmp_path):
    settings = Settings(date(1999, 1, 1), date(1999, 6, 6), "connect")
    path = str(tmp_path / "merged")
    with pytest.warns(UserWarning, match="same first and last week"):
        table = run_weekly(weekly_jobs(catalog(spark, SMALL), settings), settings, path)
    week = table.where(F.col(WEEK) == date(1999, 5, 30))
    assert f"PartitionFilters: [isnotnull({WEEK}" in re.sub(r"#\d+", "", plan(week)) and week.count() > 0
    assert table.columns[:3] == ["companyId", "companyName", WEEK]


def test_series_read_the_table_once(spark):
    text = plan(QUERIES["metric_series"](spark, SMALL))
    assert text.count("FileScan") == 1


def test_company_series_shuffle_no_long_rows(spark):
    """The table's rows are spread to long form above every shuffle."""
    text = plan(QUERIES["company_series"](spark, SMALL))
    assert text.count("Generate") == 1 and "Exchange" not in text[: text.index("Generate inline")]


def test_snapshot_sorts_nothing(spark):
    text = plan(QUERIES["company_snapshot"](spark, SMALL))
    assert "Window" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("value", [None, date(2025, 1, 12), date(2030, 1, 6)])
def test_snapshot_with_and_without_given_changes(spark, value):
    df = rows(spark, 60).withColumn("execution_count", F.expr("if(execution_count % 7 = 0, null, execution_count % 5)"))
    df = df.dropDuplicates(["companyId", WEEK])
    metrics = ["execution_count"]
    changed = period.period_change(df, metrics, WEEK)
    assert set(changed.columns) > set(df.columns)
    ours = views.company_snapshot(df, WEEK, value, metrics=metrics)
    theirs = views.company_snapshot(changed, WEEK, value, metrics=metrics)
    assert ours.columns == theirs.columns
    written = stage(changed, "changed")
    assert sorted(views.company_snapshot(written, WEEK, value, metrics=metrics).collect(), key=str) == sorted(
        views.company_snapshot(written.drop("execution_count_wow"), WEEK, value, metrics=metrics).collect(), key=str
    )
