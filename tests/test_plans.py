"""What the plans must look like, whatever the data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark import plans
from tidemark.operators import latest_by_key, overlap_join
from tidemark.sources import staffing

FOLDER = "/root/testdata/sf0.01"
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.EXTRA}
EAGER = {"sink_parquet_roundtrip", "sink_csv_roundtrip", "sink_tables_roundtrip"}
LAZY = sorted(n for n in QUERIES if n not in EAGER and "_run_" not in n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return staffing.stored(spark, FOLDER)


@pytest.fixture
def large(spark):
    """Only departments and managers are small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_current_filter_reaches_the_scan(tables):
    text = plan(plans.employee_master(*[tables[n] for n in entry.MASTER]))
    assert text.count("EqualTo(to_date,9999-01-01)") == 3
    assert "birth_date" not in text


def test_end_of_period_reaches_the_scan_and_history_stays(spark):
    text = plan(QUERIES["value_changes"](spark, FOLDER))
    assert "LessThanOrEqual(from_date,2000-06-30)" in text
    assert "GreaterThanOrEqual(from_date" not in text
    assert text.count("Exchange") == 1


def test_latest_row_is_cut_before_the_shuffle(tables):
    text = plan(latest_by_key(tables["salaries"], "emp_no"))
    assert text.count("WindowGroupLimit") == 2
    assert "row_number(), 1, Partial" in text


def test_overlap_and_first_sum_share_one_shuffle(tables, large):
    text = plan(
        plans.annual_salary_by_department(
            tables["dept_emp"], tables["departments"], tables["salaries"]
        )
    )
    # Two for the join, one for the totals, one for the sort.
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("Exchange rangepartitioning") == 1
    assert text.count("SortMergeJoin") == 1


def test_point_joins_share_the_partitioning_of_salaries(tables, large):
    names = ("salaries", "employees", "dept_emp", "departments", "titles")
    text = plan(plans.salary_trends(*[tables[n] for n in names]))
    assert text.count("Exchange hashpartitioning(emp_no") == 4


def test_managers_are_broadcast_and_assignments_stay(tables, large):
    text = plan(entry.OF_TABLES["interval_overlap_inclusive"](None, tables))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_top_k_is_no_full_sort(tables):
    names = ("employees", "dept_emp", "departments", "titles")
    text = plan(plans.senior_employees(*[tables[n] for n in names]))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_skewed_partition_is_split_under_the_first_sum(spark, large, tmp_path):
    """A key with many rows on the left only is left to adaptive execution."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    ids = spark.range(0, 60_000, 1, 16)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k")
    start = F.date_add(F.lit("1990-01-01").cast("date"), (F.hash("id") % 1000).cast("int"))
    bounds = [start.alias("from_date"), F.date_add(start, 5).alias("to_date")]
    ids.select(hot, *bounds).write.parquet(f"{tmp_path}/l")
    spark.range(30_000).select(F.col("id").cast("int").alias("k"), *bounds).write.parquet(
        f"{tmp_path}/r"
    )
    l, r = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        sums = overlap_join(l, r, "k").groupBy("k").agg(F.sum("overlap_days").alias("d"))
        sums.collect()
        assert "SortMergeJoin(skew=true)" in plan(sums)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_pairs_do_not_move_by_department(spark, tables):
    """With nothing broadcast, departments are looked up on sums, not on overlap pairs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = [tables[n] for n in ("dept_emp", "departments", "salaries")]
        text = plan(plans.annual_salary_by_department(*t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    below = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning(dept_no" in x]
    assert len(below) == 2
    assert sum("HashAggregate" in x for x in below) == 1 and sum("Join" in x for x in below) == 0
