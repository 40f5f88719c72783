"""

Every query works on the six personnel tables that ``staffing`` derives from
the whole ``orders`` and ``customer`` tables of the folder given.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from tidemark import operators as op  # noqa: E402
from tidemark import plans  # noqa: E402
from tidemark.functions import previous_month  # noqa: E402
from tidemark.model import OPEN_END, SPECS  # noqa: E402
from tidemark.session import configure, new_scratch_path  # noqa: E402
from tidemark.sources import (
    current_version,
    publish_report,
    staffing,
    write_csv,
    write_report,
    write_tables,
)  # noqa: E402

# The operators for training data are an optional part: only its absence is passed over.
EXTRA: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXTRA_SQL: dict[str, str] = {}


def _is_there(module: str) -> bool:
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None


if _is_there("tidemark.llm"):
    from tidemark.llm import queries as llm_queries

    EXTRA.update(llm_queries.QUERIES)
    EXTRA_SQL.update(llm_queries.ORACLE_SQL)
    if _is_there("corpus_pipeline"):
        import corpus_pipeline

        EXTRA["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            EXTRA_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

Tables = dict[str, DataFrame]
PERIOD = oracle.DEFAULT_PERIOD
MONTH_AFTER = "2000-05-01"


def entry(spark: SparkSession) -> DataFrame:
    """Annual salary cost by department on the smallest folder."""
    return queries()["annual_salary_by_department"](spark, "/root/testdata/sf0.001")


def _report(report: Callable[..., DataFrame], *names: str, **options):
    return lambda spark, t: report(*[t[n] for n in names], **options)


CHANGED = ("employees", "dept_emp", "titles", "salaries", "dept_manager", "departments")
MASTER = ("employees", "dept_emp", "titles", "salaries", "departments")
IMPACT = ("dept_manager", "employees", "departments", "dept_emp")


def _previous_month_changes(spark: SparkSession, t: Tables) -> DataFrame:
    start, end = previous_month(MONTH_AFTER)
    return plans.employee_changes(*[t[n] for n in CHANGED], start, end)


def _overlap_strict(spark: SparkSession, t: Tables) -> DataFrame:
    return op.overlap_join(
        op.close_open_intervals(t["salaries"]), op.close_open_intervals(t["dept_emp"]), "emp_no"
    )


def _overlap_inclusive(spark: SparkSession, t: Tables) -> DataFrame:
    terms = op.close_open_intervals(t["dept_manager"]).withColumnRenamed("emp_no", "manager_no")
    return op.overlap_join(
        op.close_open_intervals(t["dept_emp"]), terms, "dept_no", strict=False
    )


def _point_in_interval(spark: SparkSession, t: Tables) -> DataFrame:
    paid = t["salaries"].select("emp_no", "salary", F.col("from_date").alias("paid_from"))
    return op.point_in_interval_join(paid, t["dept_emp"], "emp_no", "paid_from")


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _salaries_with_unit(t: Tables) -> DataFrame:
    unit = F.when(F.col("salary") >= 300_000, " USD").otherwise("")
    return _as_text(t["salaries"].withColumn("salary", F.concat(F.col("salary"), unit)))


def _dq_null_counts(spark: SparkSession, t: Tables) -> DataFrame:
    return op.null_counts(
        t["dept_emp"].withColumn("to_date", F.nullif(F.col("to_date"), F.lit(OPEN_END)))
    )


def _dq_inverted(spark: SparkSession, t: Tables) -> DataFrame:
    return op.inverted_intervals(
        t["dept_emp"].withColumn("to_date", F.date_add("to_date", -400))
    )


def _dq_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = staffing.assignments(spark, folder).drop("o_orderkey")
    ended = raw.withColumn("to_date", F.lit(OPEN_END))
    return op.clean({"dept_emp": _as_text(ended)})["dept_emp"]


def _dq_profile_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Text numbers, repeated keys, missing ends and ends before the start."""
    shift = F.nullif(F.col("o_orderkey") % 100, F.lit(0)) - 50
    raw = staffing.assignments(spark, folder).select(
        F.col("emp_no").cast("string"),
        "dept_no",
        "from_date",
        F.date_add("from_date", shift.cast("int")).alias("to_date"),
    )
    return op.profile({"dept_emp": raw})


def _assignments_as_text(spark: SparkSession, folder: str, emp_no) -> DataFrame:
    return staffing.assignments(spark, folder).select(
        emp_no.alias("emp_no"),
        "dept_no",
        F.col("from_date").cast("timestamp").alias("from_date"),
        F.lit(OPEN_END).alias("to_date"),
    )


def _dq_removed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that are equal only after the cast: rows in, rows kept, and what the profile counts."""
    zero = F.when(F.col("o_orderkey") % 2 == 0, "0").otherwise("")
    raw = {"dept_emp": _assignments_as_text(spark, folder, F.concat(zero, F.col("emp_no")))}
    counted = op.profile(raw).filter("check in ('rows', 'surplus_rows')").select("check", "value")
    kept = op.clean(raw)["dept_emp"].agg(F.lit("kept"), F.count(F.lit(1)))
    return counted.union(kept).agg(
        *[
            F.max(F.when(F.col("check") == check, F.col("value"))).alias(name)
            for check, name in (("rows", "rows_in"), ("kept", "rows_kept"), ("surplus_rows",) * 2)
        ]
    )


def _dq_type_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Full types of the columns that differ, and how many values no cast can save."""
    bad = F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise("")
    raw = {"dept_emp": _assignments_as_text(spark, folder, F.concat(F.col("emp_no"), bad))}
    return op.profile(raw).filter("check in ('type_mismatch', 'cast_failures')")


def _master_keep_equal(spark: SparkSession, t: Tables) -> DataFrame:
    """All titles taken as open: some employees have several, equal and unequal ones."""
    open_titles = t["titles"].withColumn("to_date", F.lit(OPEN_END))
    return plans.employee_master(*[(t | {"titles": open_titles})[n] for n in MASTER], keep_equal=True)


def _master(t: Tables) -> DataFrame:
    return plans.employee_master(*[t[n] for n in MASTER])


def _sink_parquet(spark: SparkSession, t: Tables) -> DataFrame:
    uri, _ = write_report(_master(t), new_scratch_path(spark, "master"))
    return spark.read.parquet(uri)


def _read_csv(like: DataFrame, uri: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).option("header", True).csv(uri)


def _sink_csv(spark: SparkSession, t: Tables) -> DataFrame:
    report = _master(t)
    return _read_csv(report, write_csv(report, new_scratch_path(spark, "master")))


def _as_lines(name: str, df: DataFrame) -> DataFrame:
    """Rows of any table as (result, line), so that several can be compared at once."""
    return df.select(F.lit(name).alias("result"), F.concat_ws("|", *df.columns).alias("line"))


def _sink_tables(spark: SparkSession, t: Tables) -> DataFrame:
    root = write_tables(t, new_scratch_path(spark, "tables"))
    parts = [_as_lines(n, spark.read.parquet(f"{root}/{n}.parquet")) for n in t]
    return reduce(DataFrame.union, parts)


def _full_run(spark: SparkSession, t: Tables) -> DataFrame:
    paths = plans.reports_job(spark, t, new_scratch_path(spark, "run"))
    like = plans.annual_salary_by_department(t["dept_emp"], t["departments"], t["salaries"])
    return _read_csv(like, paths["annual_salary_by_department"])


def _full_run_results(spark: SparkSession, t: Tables) -> DataFrame:
    """All that a run writes beside the annual report, read back."""
    paths = plans.reports_job(spark, t, new_scratch_path(spark, "run"))
    changes = plans.employee_changes(*[t[n] for n in CHANGED], *PERIOD)
    hoppers = plans.job_hoppers(t["dept_emp"], t["employees"])
    found = {
        "employee_master": spark.read.parquet(paths["employee_master"]),
        "employee_master_csv": _read_csv(_master(t), paths["employee_master_csv"]),
        "job_hoppers": _read_csv(hoppers, paths["job_hoppers"]),
        "employee_changes": _read_csv(changes, paths["employee_changes"]),
        "quality": spark.read.parquet(paths["quality"]),
    }
    return reduce(DataFrame.union, [_as_lines(*item) for item in found.items()])


def _monthly_run(spark: SparkSession, t: Tables) -> DataFrame:
    uri = plans.changes_job(spark, t, new_scratch_path(spark, "run"), month_before=MONTH_AFTER)
    return _read_csv(plans.employee_changes(*[t[n] for n in CHANGED]), uri)


def _monthly_steps(spark: SparkSession, t: Tables) -> DataFrame:
    """Three months, each from the state that the one before has left."""
    root, like = new_scratch_path(spark, "steps"), plans.employee_changes(*[t[n] for n in CHANGED])
    months = (("2000-01-01", "2000-01-31"), ("2000-02-01", "2000-02-29"), ("2000-03-01", "2000-03-31"))
    found = []
    for start, end in months:
        found.append(_read_csv(like, plans.changes_step(spark, t, root, start, end)))
    return reduce(DataFrame.union, found)


def _sink_published(spark: SparkSession, t: Tables) -> DataFrame:
    """An older report, the whole one, and a run that fails half-way: the whole one stays."""
    report, uri = _master(t), new_scratch_path(spark, "published")
    publish_report(report.filter("emp_no % 2 = 0"), uri)
    publish_report(report, uri)
    broken = F.when(F.col("emp_no") % 3 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("emp_no"))
    try:
        publish_report(report.withColumn("emp_no", broken.cast("int")), uri)
    except Exception as error:  # noqa: BLE001
        if "lost" not in str(error):
            raise
    return spark.read.parquet(current_version(spark, uri))


OF_TABLES: dict[str, Callable[[SparkSession, Tables], DataFrame]] = {
    "career_progression": _report(plans.career_progression, "employees", "titles"),
    "department_turnover": _report(plans.department_turnover, "departments", "dept_emp"),
    "salary_trends": _report(
        plans.salary_trends, "salaries", "employees", "dept_emp", "departments", "titles"
    ),
    "senior_employees": _report(
        plans.senior_employees, "employees", "dept_emp", "departments", "titles"
    ),
    "manager_impact": _report(plans.manager_impact, *IMPACT),
    "manager_impact_clipped": _report(plans.manager_impact, *IMPACT, clip_to_manager=True),
    "gender_ratio": _report(plans.gender_ratio, "employees", "dept_emp", "departments"),
    "annual_salary_by_department": _report(
        plans.annual_salary_by_department, "dept_emp", "departments", "salaries"
    ),
    "job_hoppers": _report(plans.job_hoppers, "dept_emp", "employees"),
    "employee_master": _report(plans.employee_master, *MASTER),
    "employee_master_keep_equal": _master_keep_equal,
    "employee_changes": _report(plans.employee_changes, *CHANGED),
    "previous_month_changes": _previous_month_changes,
    "interval_overlap_strict": _overlap_strict,
    "interval_overlap_inclusive": _overlap_inclusive,
    "point_in_interval_join": _point_in_interval,
    "current_rows": _report(op.current_rows, "dept_emp"),
    "closed_rows": _report(op.closed_rows, "dept_emp"),
    "close_open_intervals": _report(op.close_open_intervals, "dept_emp"),
    "latest_by_key": _report(op.latest_by_key, "salaries", key="emp_no", tie=("salary",)),
    "value_changes": lambda spark, t: op.value_changes(
        t["titles"], "emp_no", "title", *PERIOD, "Title Change"
    ),
    "manager_changes": lambda spark, t: op.value_changes(
        t["dept_manager"], "dept_no", "emp_no", *PERIOD, "Manager Change"
    ),
    "dq_null_counts": _dq_null_counts,
    "dq_inverted_intervals": _dq_inverted,
    "dq_cast": lambda spark, t: op.cast_to(_as_text(t["salaries"]), SPECS["salaries"].schema),
    "dq_try_cast": lambda spark, t: op.cast_to(
        _salaries_with_unit(t), SPECS["salaries"].schema, strict=False
    ),
    "dq_cast_failures": lambda spark, t: op.cast_failures(
        _salaries_with_unit(t), SPECS["salaries"].schema
    ),
    "dq_profile": lambda spark, t: op.profile(t),
    "sink_parquet_roundtrip": _sink_parquet,
    "sink_csv_roundtrip": _sink_csv,
    "sink_tables_roundtrip": _sink_tables,
    "full_run_annual_salary": _full_run,
    "full_run_results": _full_run_results,
    "monthly_run_changes": _monthly_run,
    "monthly_steps_changes": _monthly_steps,
    "sink_published_roundtrip": _sink_published,
}

OF_ORDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dq_duplicate_keys": lambda spark, folder: op.duplicate_keys(
        staffing.assignments(spark, folder), ["emp_no", "from_date"]
    ),
    "dq_dedup": lambda spark, folder: op.dedup(
        staffing.assignments(spark, folder), ["emp_no", "from_date"], ["o_orderkey"]
    ),
    "dq_clean": _dq_clean,
    "dq_profile_raw": _dq_profile_raw,
    "dq_removed_rows": _dq_removed_rows,
    "dq_type_mismatch": _dq_type_mismatch,
}


def _on_tables(query: Callable[[SparkSession, Tables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark, *staffing.sources(spark, sf_dir))
        tables = staffing.stored(spark, sf_dir)
        configure(spark, *tables.values())
        return query(spark, tables)

    return run


def _on_orders(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark, *staffing.sources(spark, sf_dir)), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries by name."""
    return {
        **{name: _on_tables(query) for name, query in OF_TABLES.items()},
        **{name: _on_orders(query) for name, query in OF_ORDERS.items()},
        **EXTRA,
    }


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL."""
    return {**oracle.sql(), **EXTRA_SQL}
