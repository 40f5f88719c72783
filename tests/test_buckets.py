"""Tables in buckets: no exchange below the joins of the reports, and the same rows."""

import pytest
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators import clean
from tidemark.sources import buckets, clean_in_buckets, staffing, write_bucketed

FOLDER = "/root/testdata/sf0.01"
HISTORIES = ("dept_emp", "titles", "salaries")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("buckets"))
    given = staffing.stored(spark, FOLDER)
    return given, clean_in_buckets(given, root), root


@pytest.fixture
def large(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_same_rows_and_plain_files(spark, tables):
    given, stored, root = tables
    for name, df in clean(given).items():
        assert rows(stored[name]) == rows(df)
        assert rows(spark.read.parquet(f"{root}/{name}.parquet")) == rows(df)
        assert stored[name].schema == df.schema
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_annual_salary_moves_no_history(tables, large):
    text = plan(plans.annual_salary_by_department(*[tables[1][n] for n in ("dept_emp", "departments", "salaries")]))
    assert "Exchange hashpartitioning(emp_no" not in text
    assert text.count("SortMergeJoin") == 1 and text.count("Bucketed: true") == 2


def test_point_joins_move_no_history(tables, large):
    names = ("salaries", "employees", "dept_emp", "departments", "titles")
    text = plan(plans.salary_trends(*[tables[1][n] for n in names]))
    assert "Exchange hashpartitioning(emp_no" not in text


def test_sums_and_changes_move_no_history(tables, large):
    t = tables[1]
    for df in (
        plans.job_hoppers(t["dept_emp"], t["employees"]),
        plans.career_progression(t["employees"], t["titles"]),
        plans.employee_master(*[t[n] for n in ("employees", "dept_emp", "titles", "salaries", "departments")]),
    ):
        assert "Exchange hashpartitioning(emp_no" not in plan(df)


def test_rows_move_once_to_be_unique_and_stored(spark, tables):
    cast = tables[0]["salaries"]
    text = plan(buckets.dedup(cast.repartition(6, "emp_no"), ("emp_no", "from_date")).repartition(6, "emp_no"))
    assert text.count("Exchange") == 1


def test_heavy_employee_is_spread(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "HEAVY_WINDOW_ROWS", 10)
    stored = clean_in_buckets(tables[0], str(tmp_path))
    assert "Bucketed: true" not in plan(stored["salaries"].groupBy("emp_no").count())
    assert all(rows(stored[n]) == rows(tables[1][n]) for n in HISTORIES)


def test_overwrites_and_keeps_empty_tables(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    write_bucketed(df, f"{tmp_path}/t", "k", 3)
    again = write_bucketed(df.filter("id < 5"), f"{tmp_path}/t", "k", 4)
    assert again.count() == 5 and spark.read.parquet(f"{tmp_path}/t").count() == 5
    assert write_bucketed(df.filter("false"), f"{tmp_path}/e", "k", 4).count() == 0
