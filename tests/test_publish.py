"""Reports replaced as a whole, and changes step by step from a stored state."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from frames import day, rows
from tidemark import plans
from tidemark.operators import history as own
from tidemark.operators import last_values, value_changes
from tidemark.plans import reports
from tidemark.sources import current_version, publish, publish_report, staffing

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_lost_run_leaves_the_old_report(spark, tmp_path, kind):
    uri = f"file://{tmp_path}/r"
    assert current_version(spark, uri) is None
    df = spark.range(0, 100, 1, 4).withColumn("v", F.lit("x"))

    def read():
        reader = spark.read.option("header", True)
        return getattr(reader, kind)(current_version(spark, uri)).count()

    publish_report(df, uri, kind)
    assert read() == 100
    bad = df.withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("y"))
    with pytest.raises(Exception, match="lost"):
        publish_report(bad, uri, kind)
    assert read() == 100
    for n in (50, 20, 10):
        publish_report(df.limit(n), uri, kind)
        assert read() == n
    left = [p.name for p in (tmp_path / "r").iterdir() if p.name.startswith("version-")]
    assert len(left) == 2  # nothing of the lost run, and the one before for its readers
    publish_report(df.filter("false"), uri, kind)
    assert read() == 0


def test_nothing_is_current_before_the_first_is_complete(spark, tmp_path):
    def lost(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, str(tmp_path), lost)
    assert current_version(spark, str(tmp_path)) is None


def months(first, n):
    found = []
    for _ in range(n):
        following = (first.replace(day=1) + timedelta(days=32)).replace(day=1)
        found.append((first, following - timedelta(days=1)))
        first = following
    return found


@pytest.mark.parametrize("heavy", [False, True])
def test_steps_equal_one_run(spark, monkeypatch, heavy):
    if heavy:
        monkeypatch.setattr(own, "HEAVY_WINDOW_ROWS", 5)
    pick = random.Random(4)
    made = [
        (
            0 if pick.random() < 0.3 else pick.randrange(30),
            None if pick.random() < 0.05 else pick.choice("abc"),
            None if pick.random() < 0.03 else date(1999, 7, 1) + timedelta(days=pick.randrange(700)),
        )
        for _ in range(700)
    ]
    df = spark.createDataFrame(made, "k int, v string, from_date date")
    steps = months(day("2000-01-01"), 4)
    before, found = last_values(df, "k", "v", "1999-12-31"), []
    for start, end in steps:
        found += rows(value_changes(df, "k", "v", start, end, "x", before=before))
        eve = start - timedelta(days=1)
        before = spark.createDataFrame(
            last_values(df, "k", "v", end, after=eve, before=before).collect(), before.schema
        )
    whole = rows(value_changes(df, "k", "v", steps[0][0], steps[-1][1], "x"))
    assert sorted(found, key=repr) == whole and whole


def test_state_saves_reading_what_was_before(spark):
    t = staffing.stored(spark, FOLDER)
    before = {
        name: last_values(t[name], key, value, "1999-12-31")
        for name, (key, value) in reports.CHANGING.items()
    }
    stored = {n: spark.createDataFrame(df.limit(5).collect(), df.schema) for n, df in before.items()}
    names = ("employees", "dept_emp", "titles", "salaries", "dept_manager", "departments")
    text = plan(plans.employee_changes(*[t[n] for n in names], "2000-01-01", "2000-01-31", stored))
    assert text.count("GreaterThanOrEqual(from_date,2000-01-01)") == 4
    step = last_values(t["titles"], "emp_no", "title", "2000-01-31", after="1999-12-31", before=stored["titles"])
    assert "GreaterThan(from_date,1999-12-31)" in plan(step)


def test_step_after_a_gap_reads_everything(spark, tmp_path):
    t = staffing.stored(spark, FOLDER)
    names = ("employees", "dept_emp", "titles", "salaries", "dept_manager", "departments")
    for start, end in (("2000-01-01", "2000-01-31"), ("2000-03-01", "2000-03-31"), ("2000-03-01", "2000-03-31")):
        uri = plans.changes_step(spark, t, str(tmp_path), start, end)
        wanted = plans.employee_changes(*[t[n] for n in names], start, end)
        found = spark.read.schema(wanted.schema).option("header", True).csv(uri)
        assert rows(found) == rows(wanted)
        assert f"{end}-" in current_version(spark, f"{tmp_path}/state")


def test_hot_day_is_spread_and_equals_the_window(spark):
    """Many values of one key on one day: several ranges, the pairs of one window."""
    values = F.pmod(F.hash("id"), F.lit(40_000))
    df = spark.range(0, 60_000, 1, 8).select(F.lit(1).alias("k"), F.lit(day("2000-01-05")).alias("at"), values.alias("value"))
    first = F.lit(day("2000-01-01"))
    by_window = own._ordered_pairs(df, "k", first).filter("old_value <> new_value")
    by_range = own._heavy_pairs(df, "k", first).filter("old_value <> new_value")
    assert by_range.exceptAll(by_window).count() == by_window.exceptAll(by_range).count() == 0
    # So few rows would be merged into one range again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = own.in_ranges(df.distinct(), ("k", "at", "value"))
        counts = [r["count"] for r in ranges.groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(counts) >= 4 and max(counts) < 0.5 * sum(counts)


def test_registered(spark):
    assert {"monthly_steps_changes", "sink_published_roundtrip"} <= set(entry.queries())
