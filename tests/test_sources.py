"""Sinks, JDBC options and the jobs."""

import glob

import pytest
from pyspark.sql import functions as F

from frames import OPEN, departments, employees, rows, table
from tidemark import plans
from tidemark.model import SPECS
from tidemark.sources import as_views, jdbc_options, read_tables, write_csv, write_parquet, write_report
from tidemark.sources.readers import split_column


def parts(path, kind="csv"):
    return sorted(glob.glob(f"{path}/part-*.{kind}"))


def test_csv_single_file_in_order(spark, tmp_path):
    out = str(tmp_path / "r")
    df = spark.range(1000).repartition(7).withColumn("v", F.col("id") % 3)
    assert write_csv(df, out, single_file=True, sort_by=("v", F.desc("id"))) == out
    assert len(parts(out)) == 1
    lines = open(parts(out)[0]).read().splitlines()
    assert lines[:3] == ["id,v", "999,0", "996,0"] and len(lines) == 1001


def test_csv_many_files_keep_all_rows(spark, tmp_path):
    out = str(tmp_path / "r")
    write_csv(spark.range(1000).repartition(7), out)
    assert len(parts(out)) == 7
    assert spark.read.option("header", True).csv(out).count() == 1000


@pytest.mark.parametrize("single", [True, False])
def test_empty_report_replaces_the_old_one(spark, tmp_path, single):
    out = str(tmp_path / "r")
    write_csv(spark.range(5), out)
    empty = spark.range(5).filter("id < 0")
    write_csv(empty, out, single_file=single)
    assert [open(p).read() for p in parts(out)] == ["id\n"]


def test_empty_report_can_be_skipped(spark, tmp_path):
    out = str(tmp_path / "r")
    write_csv(spark.range(5), out)
    assert write_csv(spark.range(0), out, on_empty="skip") is None
    assert spark.read.option("header", True).csv(out).count() == 5
    with pytest.raises(ValueError):
        write_csv(spark.range(5), out, on_empty="fail")


def test_report_in_two_formats(spark, tmp_path):
    parquet, csv = write_report(spark.range(50), str(tmp_path / "r"))
    assert rows(spark.read.parquet(parquet)) == [(i,) for i in sorted(range(50), key=lambda i: repr((i,)))]
    assert spark.read.option("header", True).csv(csv).count() == 50


def test_parquet_rows_are_sorted_in_each_file(spark, tmp_path):
    out = write_parquet(spark.range(100).repartition(1), str(tmp_path / "p"), sort_by=("id",))
    assert [r.id for r in spark.read.parquet(out).collect()] == list(range(100))


def test_jdbc_options_split_on_an_integer_key():
    login = {"user": "u", "password": "p", "driver": "d"}
    split = jdbc_options("jdbc:x", "salaries", login, "emp_no", (10001, 499999), 8)
    assert split == {
        "user": "u",
        "password": "p",
        "driver": "d",
        "url": "jdbc:x",
        "dbtable": "salaries",
        "fetchsize": "10000",
        "partitionColumn": "emp_no",
        "lowerBound": "10001",
        "upperBound": "499999",
        "numPartitions": "8",
    }
    for key, bounds, n in ((None, (1, 2), 8), ("emp_no", None, 8), ("emp_no", (1, 2), 1)):
        assert "partitionColumn" not in jdbc_options("jdbc:x", "t", login, key, bounds, n)
    assert jdbc_options("jdbc:x", "t", {"fetchsize": "5"})["fetchsize"] == "5"


def test_split_columns():
    assert {t: split_column(t) for t in SPECS} == {
        "employees": "emp_no",
        "departments": None,
        "dept_emp": "emp_no",
        "dept_manager": "emp_no",
        "titles": "emp_no",
        "salaries": "emp_no",
    }


def small_tables(spark):
    return {
        "employees": employees(spark, 1, 2),
        "departments": departments(spark, "d1", "d2"),
        "dept_emp": table(
            spark,
            "dept_emp",
            (1, "d1", "1990-01-01", "2000-02-01"),
            (1, "d2", "2000-02-01", OPEN),
            (1, "d2", "2000-02-01", OPEN),  # duplicate, removed by the run
            (2, "d1", "1990-01-01", OPEN),
        ),
        "dept_manager": table(spark, "dept_manager", (2, "d1", "1990-01-01", OPEN)),
        "titles": table(spark, "titles", *[(n, "t", "1990-01-01", OPEN) for n in (1, 2)]),
        "salaries": table(spark, "salaries", *[(n, 36500, "2000-01-01", OPEN) for n in (1, 2)]),
    }


def test_whole_run(spark, tmp_path):
    paths = plans.reports_job(spark, small_tables(spark), str(tmp_path))
    found = spark.read.parquet(paths["quality"])
    assert found.filter("check = 'duplicate_keys' and value > 0").count() == 1
    assert {n: df.count() for n, df in read_tables(spark, paths["tables"]).items()} == {
        "employees": 2,
        "departments": 2,
        "dept_emp": 3,
        "dept_manager": 1,
        "titles": 2,
        "salaries": 2,
    }
    annual = parts(paths["annual_salary_by_department"])
    assert open(annual[0]).read().splitlines() == [
        "year,dept_name,total_salary,employee_count",
        "2000,Dept d1,112600,2",
        "2000,Dept d2,106400,1",
    ]
    hoppers = parts(paths["job_hoppers"])
    assert [open(p).read() for p in hoppers] == ["emp_no,first_name,last_name,dept_change_count\n"]
    assert spark.read.parquet(paths["employee_master"]).count() == 2
    assert len(parts(paths["employee_master_csv"])) >= 1
    changes = [line for p in parts(paths["employee_changes"]) for line in open(p)]
    assert changes[1:] == ["1,F1 L1,2000-02-01,Department Change,d1,d2\n"]


def test_changes_job_period(spark, tmp_path):
    tables = small_tables(spark)
    for day, count in (("2000-03-31", 1), ("2000-02-28", 0)):
        uri = plans.changes_job(spark, tables, str(tmp_path), month_before=day)
        assert spark.read.option("header", True).csv(uri).count() == count
    with pytest.raises(ValueError):
        plans.changes_job(spark, tables, str(tmp_path), start="2000-01-01")


def test_tables_as_views(spark):
    as_views(small_tables(spark))
    current = spark.sql("select emp_no from titles where to_date = '9999-01-01'")
    assert rows(current) == [(1,), (2,)]
