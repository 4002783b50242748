import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from accountpulse.errors import MissingSourceError, ValidationError
from accountpulse.plans import pipeline
from accountpulse.sources import readers, writers
from accountpulse.sources.contracts import EXPORTS, require_columns, struct_of, with_contract
from accountpulse.sources.staging import fingerprint, stage


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_first_candidate_wins_and_missing_lists_all(spark, tmp_path):
    write(tmp_path / "b.csv", "a,b\n1,x\n")
    write(tmp_path / "c.csv", "a,b\n2,y\n")
    df = readers.read_source(spark, str(tmp_path), ["a.csv", "b.csv", "c.csv"])
    assert df.collect() == [("1", "x")]
    with pytest.raises(MissingSourceError, match=r"no1.csv.*no2"):
        readers.read_source(spark, str(tmp_path), ["no1.csv", "no2"])


def test_csv_is_typed_by_name(spark, tmp_path):
    write(tmp_path / "dau_weekly.csv", "dau_count,companyId,week_end_sunday,unique_users_count\n5.0,12.0,2025-01-05,x\n")
    row = readers.read_export(spark, str(tmp_path), EXPORTS["dau"]).first()
    assert (row.companyId, row.week_end_sunday, row.dau_count, row.unique_users_count) == (
        "12.0",
        date(2025, 1, 5),
        5,
        None,
    )


def test_export_without_required_column_fails(spark, tmp_path):
    write(tmp_path / "dau_weekly.csv", "companyId,week_end_sunday\n1,2025-01-05\n")
    with pytest.raises(ValidationError, match="dau_count, unique_users_count"):
        readers.read_export(spark, str(tmp_path), EXPORTS["dau"])


def test_optional_source_is_typed_and_empty(spark, tmp_path):
    write(tmp_path / "m.csv", "userId\n1\n")
    schema = struct_of("userId STRING, companyId STRING")
    df = readers.read_optional(spark, str(tmp_path), ["none.csv", "m.csv"], schema)
    assert df.schema == schema and df.isEmpty()
    write(tmp_path / "n.csv", "userId,companyId\n1,2\n")
    assert readers.read_optional(spark, str(tmp_path), ["m.csv", "n.csv"], schema).collect() == [("1", "2")]


def test_contract_helpers(frame):
    df = frame("_id STRING, a INT", [("x", 1)])
    full = with_contract(df, struct_of("a BIGINT, b DATE"))
    assert full.columns == ["a", "b"] and full.schema["b"].dataType.simpleString() == "date"
    with pytest.raises(ValidationError, match="s lacks b, c"):
        require_columns(df, ["c", "a", "b"], "s")


def test_fallback(spark, frame):
    good = frame("a INT", [(1,)])
    broken = good.withColumn("a", F.raise_error(F.lit("gone")).cast("int"))
    assert readers.read_with_fallback(lambda: good, None, ["a"], "s").collect() == [(1,)]
    with pytest.raises(Exception, match="gone"):
        readers.read_with_fallback(lambda: broken, lambda: good, ["a"], "s")
    used = readers.read_with_fallback(lambda: broken, lambda: good, ["a"], "s", allow_fallback=True)
    assert used.collect() == [(1,)]
    with pytest.raises(ValidationError, match="s_fallback"):
        readers.read_with_fallback(lambda: broken, lambda: good.drop("a"), ["a"], "s", allow_fallback=True)

    def absent():
        raise MissingSourceError("none")

    with pytest.raises(Exception, match="gone"):
        readers.read_with_fallback(lambda: broken, absent, ["a"], "s", allow_fallback=True)


def test_fallback_of_the_licence_job_only(spark, frame, tmp_path):
    good = frame("week_end_sunday DATE, companyId STRING, plan_tier_name STRING, plan_tier_display_name STRING, "
                 "connect_licenses BIGINT", [(date(2025, 1, 5), "1", "n", "d", 3)])
    pipeline.write_exports({"connect": good}, str(tmp_path))
    broken = good.withColumn("connect_licenses", F.raise_error(F.lit("gone")).cast("bigint"))
    staged = pipeline.stage_with_fallback(spark, {"connect": broken}, str(tmp_path), allow_fallback=True)
    assert staged["connect"].first()["connect_licenses"] == 3
    with pytest.raises(Exception, match="gone"):
        pipeline.stage_with_fallback(spark, {"billing": broken}, str(tmp_path), allow_fallback=True)


def test_stage_and_fingerprint(spark, frame, tmp_path):
    df = stage(frame("a INT, b STRING", [(1, "x"), (2, "y")]), "t")
    assert sorted(df.collect()) == [(1, "x"), (2, "y")]
    path = str(tmp_path / "t")
    df.write.parquet(path)
    before = fingerprint(spark, [path])
    assert before == fingerprint(spark, [path])
    df.write.mode("append").parquet(path)
    assert before != fingerprint(spark, [path])


def merged(frame):
    rows = [("10", date(2025, 1, 12), 1), ("9", date(2025, 1, 12), 2), ("9", date(2025, 1, 5), 3)]
    return frame("companyId STRING, week_end_sunday DATE, execution_count BIGINT", rows)


def test_merged_csv_is_ordered_text(spark, frame, tmp_path):
    path = str(tmp_path / "merged")
    writers.write_merged(merged(frame).repartition(3), path)
    lines = [ln for f in sorted(glob.glob(path + "/part-*.csv")) for ln in open(f).read().splitlines()]
    assert [ln for ln in lines if not ln.startswith("companyId")] == [
        "9,2025-01-05,3",
        "9,2025-01-12,2",
        "10,2025-01-12,1",
    ]
    assert "companyId,week_end_sunday,execution_count" in lines


def test_merged_parquet_is_partitioned_by_week(spark, frame, tmp_path):
    path = str(tmp_path / "merged")
    writers.write_merged(merged(frame), path, "parquet")
    one = spark.read.parquet(path).where(F.col("week_end_sunday") == F.lit(date(2025, 1, 5)))
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(week_end_sunday" in one._jdf.queryExecution().toString()


def test_empty_long_table_is_not_written(spark, frame, tmp_path):
    long = frame("companyId STRING, week_end_sunday DATE, app_name STRING", [])
    assert writers.write_long(long, str(tmp_path / "long")) is False
    assert not (tmp_path / "long").exists()


def test_files_that_pandas_writes(spark, tmp_path):
    import pandas as pd

    names = ['Plan "A", x', "two\nlines", "NA", None, " plain "]
    table = pd.DataFrame({"companyId": ["1", "NULL", "3", "N/A", "\t5\u00a0"], "name": names, "n": [1, 2.5, 3, None, 5], "m": [1.0, 2, 3, 4, 5]})
    path = str(tmp_path / "t.csv")
    table.to_csv(path, index=False)
    schema = struct_of("companyId STRING, name STRING, n BIGINT, m BIGINT")
    rows = readers.read_source(spark, "/", [path], schema)
    assert dict(rows.dtypes) == {"companyId": "string", "name": "string", "n": "double", "m": "bigint"}
    found = [tuple(r) for r in rows.collect()]
    assert [r[1] for r in found] == ['Plan "A", x', "two\nlines", None, None, " plain "]
    assert [r[0] for r in found] == ["1", None, "3", None, "\t5\u00a0"]
    assert [r[2] for r in found] == [1.0, 2.5, 3.0, None, 5.0] and [r[3] for r in found] == [1, 2, 3, 4, 5]


def test_pandas_reads_what_is_written(spark, tmp_path):
    import glob
    from datetime import date

    import pandas as pd

    rows = [("1", date(2025, 1, 5), 'Plan "A", x'), ("2", date(2025, 1, 5), "two\nlines")]
    path = str(tmp_path / "merged")
    writers.write_merged(spark.createDataFrame(rows, "companyId STRING, week_end_sunday DATE, companyName STRING"), path)
    parts = [pd.read_csv(f) for f in glob.glob(path + "/part-*.csv")]
    assert sorted(pd.concat(parts)["companyName"]) == ['Plan "A", x', "two\nlines"]
