"""Batch jobs: the whole run from raw tables to reports, and the change report."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import as_day, previous_month
from tidemark.model import AS_OF, PERIOD_END, PERIOD_START
from tidemark.operators import profile
from tidemark.plans import reports
from tidemark.session import configure
from tidemark.sources.buckets import clean_in_buckets
from tidemark.sources.publish import VERSION, current_version, publish, publish_report
from tidemark.sources.writers import write_csv, write_parquet, write_report


def reports_job(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    start: date | str = PERIOD_START,
    end: date | str = PERIOD_END,
    as_of: date = AS_OF,
) -> dict[str, str]:
    """Check, clean and store the tables, then write the four reports.

    The reports read the stored tables, so the source is read for the checks
    and for the copy. These are in buckets of the employee, so that no report
    moves them again. Returns the paths written by name.
    """
    paths = {"quality": write_parquet(profile(tables), f"{out}/quality")}
    paths["tables"] = f"{out}/tables"
    t = clean_in_buckets(tables, paths["tables"])
    configure(spark, *t.values())

    by_department = reports.annual_salary_by_department(
        t["dept_emp"], t["departments"], t["salaries"], as_of
    )
    # Years times departments: the only report of a size that stays small.
    paths["annual_salary_by_department"] = write_csv(
        by_department,
        f"{out}/reports/annual_salary_by_department",
        single_file=True,
        sort_by=("year", "dept_name"),
    )
    paths["job_hoppers"] = write_csv(
        reports.job_hoppers(t["dept_emp"], t["employees"]), f"{out}/reports/job_hoppers"
    )
    master = reports.employee_master(
        t["employees"], t["dept_emp"], t["titles"], t["salaries"], t["departments"], as_of
    )
    paths["employee_master"], paths["employee_master_csv"] = write_report(
        master, f"{out}/reports/employee_master"
    )
    paths["employee_changes"] = changes_job(spark, t, f"{out}/reports", start, end)
    return paths


def changes_job(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    start: date | str | None = None,
    end: date | str | None = None,
    month_before: date | str | None = None,
) -> str:
    """Write the change report of a period and return its path.

    The period is ``start`` to ``end`` if both are given, else the calendar
    month before ``month_before``; neither is an error.
    """
    if start and end:
        period = as_day(start), as_day(end)
    elif month_before:
        period = previous_month(month_before)
    else:
        raise ValueError("give start and end, or month_before")
    names = ("employees", "dept_emp", "titles", "salaries", "dept_manager", "departments")
    changes = reports.employee_changes(*[tables[n] for n in names], *period)
    uri = f"{out}/employee_changes"
    write_csv(changes, uri)
    return uri


def changes_step(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, start: date | str, end: date | str
) -> str:
    """Publish the change report of a period that follows the one before; its path.

    Each period has a report of its own, below ``out/employee_changes``.
    ``out/state`` keeps the last value of each key of the four histories up to
    the end of the last step. If that is the day before ``start``, only rows of
    the period are read; otherwise, on the first step or after a gap, the whole
    history before it once. Report and state are published one after the other,
    so a step that was lost can run again.

    A row that arrives after the step of its day is in no report, and no later
    change refers to it, until a step that reads the whole history.
    """
    first, last = (date.fromisoformat(str(d)) for d in (start, end))
    eve = first - timedelta(days=1)
    state = current_version(spark, f"{out}/state")
    known = state is not None and f"/{VERSION}{eve.isoformat()}-" in state
    before = {}
    for name, (key, value) in reports.CHANGING.items():
        if known:
            before[name] = spark.read.parquet(f"{state}/{name}.parquet")
        else:
            before[name] = reports.last_values(tables[name], key, value, eve)
    names = ("employees", "dept_emp", "titles", "salaries", "dept_manager", "departments")
    changes = reports.employee_changes(*[tables[n] for n in names], first, last, before)
    uri = f"{out}/employee_changes/{first.isoformat()}_{last.isoformat()}"
    path = publish_report(changes, uri, "csv")

    def write(folder: str) -> None:
        for name, (key, value) in reports.CHANGING.items():
            options = {"after": eve, "before": before[name]}
            newest = reports.last_values(tables[name], key, value, last, **options)
            write_parquet(newest, f"{folder}/{name}.parquet")

    publish(spark, f"{out}/state", write, label=last.isoformat())
    return path
