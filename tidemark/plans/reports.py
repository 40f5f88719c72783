"""The ten reports. Each takes tables as DataFrames and returns a DataFrame.

The result is lazy. Those with an interval join or with changes first look for
heavy keys when they are called: one pass over the key column of the histories.

Every order ends in columns that make it total. That fixes the result where
the leading columns tie, and it spreads rows with equal leading columns over
the partitions of the sort.

``departments`` is joined without a hint: Catalyst broadcasts it if its size is
known to be small. Where the result allows it the join comes after the
aggregation, so that nothing large moves by department.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    as_day,
    days_between,
    earlier_of,
    full_name,
    is_open,
    later_of,
    rounded_ratio,
    row_count,
)
from tidemark.model import (
    AS_OF,
    DAYS_PER_TENURE_YEAR,
    DAYS_PER_YEAR,
    DEPARTMENT_CHANGE,
    HIGHEST_RETENTION,
    LOWEST_RETENTION,
    MANAGER_CHANGE,
    PERIOD_END,
    PERIOD_START,
    SALARY_CHANGE,
    TITLE_CHANGE,
)
from tidemark.operators import (
    close_open_intervals,
    current_rows,
    heavy_keys,
    heavy_slots,
    last_values,
    latest_by_key,
    overlap_join,
    point_in_interval_join,
    value_changes,
)
from tidemark.operators.skew import HEAVY_WINDOW_ROWS

# The histories of the change report: their keys, their values and what a change is called.
CHANGING = {
    "dept_emp": ("emp_no", "dept_no"),
    "titles": ("emp_no", "title"),
    "salaries": ("emp_no", "salary"),
    "dept_manager": ("dept_no", "emp_no"),
}
CHANGE_LABELS = (DEPARTMENT_CHANGE, TITLE_CHANGE, SALARY_CHANGE, MANAGER_CHANGE)


def career_progression(employees: DataFrame, titles: DataFrame, as_of: date = AS_OF) -> DataFrame:
    """Distinct titles and mean years per title of each employee."""
    held = close_open_intervals(titles, as_of=as_of).withColumn(
        "days", days_between(F.col("from_date"), F.col("to_date"))
    )
    # Two steps, so that the distinct count combines on the map side as well.
    per_title = held.groupBy("emp_no", "title").agg(
        F.sum("days").alias("days"), F.count("days").alias("periods")
    )
    per_employee = per_title.groupBy("emp_no").agg(
        F.count("title").alias("different_titles"),
        rounded_ratio(F.sum("days"), F.sum("periods") * DAYS_PER_YEAR, 2).alias(
            "avg_years_per_title"
        ),
    )
    return (
        employees.select("emp_no", full_name().alias("full_name"))
        .join(per_employee, "emp_no")
        .orderBy(F.desc("different_titles"), F.desc("avg_years_per_title"), "emp_no")
    )


def department_turnover(departments: DataFrame, dept_emp: DataFrame) -> DataFrame:
    """Ended assignments per hundred distinct employees of each department."""
    counts = dept_emp.groupBy("dept_no").agg(
        F.count_distinct("emp_no").alias("total_employees"),
        F.count_if(~is_open("to_date")).alias("left_employees"),
    )
    rate = rounded_ratio(F.col("left_employees") * 100, F.col("total_employees"), 2)
    return (
        departments.join(counts, "dept_no")
        .select(
            "dept_no",
            "dept_name",
            "total_employees",
            "left_employees",
            rate.alias("turnover_rate"),
        )
        .orderBy(F.desc("turnover_rate"), "dept_no")
    )


def salary_trends(
    salaries: DataFrame,
    employees: DataFrame,
    dept_emp: DataFrame,
    departments: DataFrame,
    titles: DataFrame,
    as_of: date = AS_OF,
) -> DataFrame:
    """Mean salary by year in which it started, department and title.

    The joins on emp_no follow each other, so each table moves once; the
    department name is looked up on the sums, which can be added further.
    """
    heavy = heavy_slots([dept_emp, titles], ["emp_no"], against=salaries)
    options = {"heavy": False if heavy is None else heavy, "keep_slot": True}
    paid = salaries.select("emp_no", "salary", F.col("from_date").alias("paid_from")).join(
        employees.select("emp_no"), "emp_no", "left_semi"
    )
    placed = point_in_interval_join(paid, dept_emp, "emp_no", "paid_from", **options)
    titled = point_in_interval_join(placed, titles, "emp_no", "paid_from", **options)
    sums = titled.groupBy(F.year("paid_from").alias("year"), "dept_no", "title").agg(
        F.sum("salary").alias("total"), F.count("salary").alias("n")
    )
    return (
        sums.join(departments, "dept_no")
        .groupBy("year", "dept_name", "title")
        .agg(rounded_ratio(F.sum("total"), F.sum("n"), 2).alias("avg_salary"))
        .orderBy("year", "dept_name", "title")
    )


def senior_employees(
    employees: DataFrame,
    dept_emp: DataFrame,
    departments: DataFrame,
    titles: DataFrame,
    as_of: date = AS_OF,
    n: int = 10,
) -> DataFrame:
    """The ``n`` current employees hired first, with department and title."""
    service = days_between(F.col("hire_date"), F.lit(as_of)) / DAYS_PER_YEAR
    return (
        employees.select("emp_no", full_name().alias("full_name"), "hire_date")
        .join(current_rows(dept_emp).select("emp_no", "dept_no"), "emp_no")
        .join(current_rows(titles).select("emp_no", "title"), "emp_no")
        .join(departments, "dept_no")
        .select(
            "emp_no",
            "full_name",
            "hire_date",
            service.alias("years_of_service"),
            F.col("dept_name").alias("current_department"),
            F.col("title").alias("current_title"),
        )
        .orderBy("hire_date", "emp_no", "current_department", "current_title")
        .limit(n)
    )


def _extremes(df: DataFrame, measure: str) -> tuple[Column, Column]:
    """Conditions for rank one from below and from above, ties included.

    Equal to the ranks of a window over the whole frame, but computed as a
    combined minimum and maximum instead of in one task.
    """
    lowest = df.agg(F.min(measure)).scalar()
    highest = df.agg(F.max(measure)).scalar()
    return F.col(measure) == lowest, F.col(measure) == highest


def manager_impact(
    dept_manager: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    dept_emp: DataFrame,
    as_of: date = AS_OF,
    clip_to_manager: bool = False,
) -> DataFrame:
    """Managers with the shortest and longest mean time of people under them.

    Somebody still in the department counts up to ``as_of`` even if the
    manager's term ended before; ``clip_to_manager`` ends it with the term.
    """
    terms = dept_manager.select(
        F.col("emp_no").alias("manager_id"),
        "dept_no",
        "from_date",
        "to_date",
        F.col("to_date").alias("term_end"),
    )
    # With few managers this is a broadcast join: assignments do not move, and
    # what does move is one partial sum per manager and task.
    pairs = overlap_join(
        dept_emp,
        close_open_intervals(terms, as_of=as_of),
        "dept_no",
        strict=False,
        suffixes=("", "_term"),
    )
    # Open assignments count to the as-of date, ended ones to the earlier end.
    closed_term = F.col("to_date_term")
    until = F.when(is_open("to_date"), F.lit(as_of)).otherwise(
        earlier_of(F.col("to_date"), closed_term)
    )
    if clip_to_manager:
        until = earlier_of(until, closed_term)
    days = days_between(later_of(F.col("from_date"), F.col("from_date_term")), until)
    sums = pairs.groupBy("manager_id", "dept_no").agg(
        F.sum(days).alias("days"), F.count(days).alias("people")
    )
    names = employees.join(dept_manager.select("emp_no"), "emp_no", "left_semi").select(
        F.col("emp_no").alias("manager_id"), full_name().alias("manager_name")
    )
    means = (
        sums.join(departments, "dept_no")
        .join(names, "manager_id")
        .groupBy("manager_id", "manager_name", "dept_name")
        .agg(F.sum("days").alias("days"), F.sum("people").alias("people"))
        .withColumn("mean_days", F.col("days") / F.col("people"))
    )
    lowest, highest = _extremes(means, "mean_days")
    return (
        means.filter(lowest | highest)
        .withColumn(
            "retention_type",
            F.when(lowest, LOWEST_RETENTION).otherwise(HIGHEST_RETENTION),
        )
        .orderBy("mean_days", "manager_id", "dept_name")
        .select(
            "manager_id",
            "manager_name",
            "dept_name",
            rounded_ratio(F.col("days"), F.col("people") * DAYS_PER_YEAR, 2).alias(
                "avg_years_under_manager"
            ),
            "retention_type",
        )
    )


def gender_ratio(employees: DataFrame, dept_emp: DataFrame, departments: DataFrame) -> DataFrame:
    """Men and women per department today, as counts and shares.

    Other values of gender count in the total only.
    """
    counts = (
        current_rows(dept_emp)
        .select("emp_no", "dept_no")
        .join(employees.select("emp_no", "gender"), "emp_no")
        .groupBy("dept_no")
        .agg(
            F.count_if(F.col("gender") == "M").alias("male_count"),
            F.count_if(F.col("gender") == "F").alias("female_count"),
            row_count().alias("total"),
        )
    )

    def share(people: Column) -> Column:
        return rounded_ratio(people * 100, F.col("total"), 2)

    men, women = F.col("male_count"), F.col("female_count")
    return (
        departments.join(counts, "dept_no")
        .select(
            "dept_no",
            "dept_name",
            "male_count",
            "female_count",
            share(men).alias("male_percentage"),
            share(women).alias("female_percentage"),
            share(F.abs(men - women)).alias("gender_disparity"),
        )
        .orderBy(F.desc("gender_disparity"), "dept_no")
    )


def annual_salary_by_department(
    dept_emp: DataFrame, departments: DataFrame, salaries: DataFrame, as_of: date = AS_OF
) -> DataFrame:
    """Salary cost by department and year, prorated by days of assignment.

    An overlap of salary and assignment counts whole in the year it starts.
    """
    pairs = overlap_join(
        close_open_intervals(salaries, as_of=as_of),
        close_open_intervals(dept_emp, as_of=as_of),
        "emp_no",
    )
    # Salary times days is summed as whole numbers and divided once. The first
    # sum keeps the join's partitioning; departments are looked up on its rows,
    # and the second makes the employees of a department name distinct.
    paid = F.sum(F.col("salary").cast("long") * F.col("overlap_days"))
    per_assignment = pairs.groupBy("emp_no", F.year("overlap_start").alias("year"), "dept_no").agg(
        paid.alias("salary_days")
    )
    per_employee = (
        per_assignment.join(departments, "dept_no")
        .groupBy("emp_no", "year", "dept_name")
        .agg(F.sum("salary_days").alias("salary_days"))
    )
    total = F.sum(F.col("salary_days").cast("decimal(20,0)"))
    return (
        per_employee.groupBy("year", "dept_name")
        .agg(
            F.round(total / DAYS_PER_YEAR, 0).cast("long").alias("total_salary"),
            row_count().alias("employee_count"),
        )
        .orderBy("year", "dept_name")
    )


def job_hoppers(dept_emp: DataFrame, employees: DataFrame, min_assignments: int = 4) -> DataFrame:
    """Employees with at least ``min_assignments`` department assignments.

    ``dept_change_count`` counts assignments: it is not the number of changes.
    """
    moves = (
        dept_emp.groupBy("emp_no")
        .agg(F.count("dept_no").alias("dept_change_count"))
        .filter(F.col("dept_change_count") >= min_assignments)
    )
    return (
        moves.join(employees, "emp_no")
        .select("emp_no", "first_name", "last_name", "dept_change_count")
        .orderBy(F.desc("dept_change_count"), "emp_no")
    )


def employee_master(
    employees: DataFrame,
    dept_emp: DataFrame,
    titles: DataFrame,
    salaries: DataFrame,
    departments: DataFrame,
    as_of: date = AS_OF,
    keep_equal: bool = False,
) -> DataFrame:
    """Current department, title and salary of each employee.

    Of several open rows the one that started last counts; an employee whose
    latest value is null drops out. With ``keep_equal`` every open row with that
    one's value stays, as a row of its own.
    """

    def current(history: DataFrame, value: str) -> DataFrame:
        equal = (value,) if keep_equal else ()
        rows = current_rows(history).select("emp_no", value, "from_date")
        latest = latest_by_key(rows, "emp_no", tie=(value,), keep_equal=equal)
        return latest.drop("from_date").filter(F.col(value).isNotNull())

    tenure = days_between(F.col("hire_date"), F.lit(as_of)) / DAYS_PER_TENURE_YEAR
    return (
        employees.select("emp_no", full_name().alias("full_name"), "hire_date")
        .join(current(dept_emp, "dept_no"), "emp_no")
        .join(current(titles, "title"), "emp_no")
        .join(current(salaries, "salary"), "emp_no")
        .join(departments, "dept_no")
        .select(
            "emp_no",
            "full_name",
            F.col("dept_name").alias("current_department"),
            F.col("title").alias("current_title"),
            F.col("salary").alias("current_salary"),
            "hire_date",
            F.round(tenure, 0).cast("int").alias("tenure_years"),
        )
    )


def employee_changes(
    employees: DataFrame,
    dept_emp: DataFrame,
    titles: DataFrame,
    salaries: DataFrame,
    dept_manager: DataFrame,
    departments: DataFrame,
    start: date | str | Column = PERIOD_START,
    end: date | str | Column = PERIOD_END,
    before: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Log of department, title, salary and manager changes in a period.

    Both days belong to the period. Department changes show department numbers,
    manager changes the names of the managers, null for one who is unknown.

    ``before`` has the ``last_values`` of the four histories, by their names, up
    to the day before ``start``; rows before the period are then not read.
    """
    period = as_day(start), as_day(end)

    def read(history: DataFrame) -> DataFrame:
        return history if before is None else history.filter(F.col("from_date").between(*period))

    histories = [read(h).select("emp_no") for h in (dept_emp, titles, salaries)]
    of_key = {
        "emp_no": heavy_keys(histories, ["emp_no"], HEAVY_WINDOW_ROWS),
        "dept_no": heavy_keys([read(dept_manager)], ["dept_no"], HEAVY_WINDOW_ROWS),
    }
    table_of = dict(zip(CHANGE_LABELS, CHANGING))

    def changes(history: DataFrame, key: str, value: str, label: str) -> DataFrame:
        heavy = False if of_key[key] is None else of_key[key]
        last = before[table_of[label]] if before else None
        found = value_changes(history, key, value, *period, label, heavy=heavy, before=last)
        return found.withColumns({c: F.col(c).cast("string") for c in ("old_value", "new_value")})

    def event(entity: str, name: Column) -> list[Column]:
        return [
            F.col(entity).cast("string").alias("entity_id"),
            name.alias("entity_name"),
            *[F.col(c) for c in ("change_date", "change_type", "old_value", "new_value")],
        ]

    of_employees = (
        changes(dept_emp, "emp_no", "dept_no", DEPARTMENT_CHANGE)
        .unionByName(changes(titles, "emp_no", "title", TITLE_CHANGE))
        .unionByName(changes(salaries, "emp_no", "salary", SALARY_CHANGE))
        .join(employees.select("emp_no", full_name().alias("name")), "emp_no")
        .select(*event("emp_no", F.col("name")))
    )

    managers = employees.join(dept_manager.select("emp_no"), "emp_no", "left_semi").select(
        F.col("emp_no").cast("string").alias("id"), full_name().alias("name")
    )
    old = managers.withColumnsRenamed({"id": "old_value", "name": "old_name"})
    new = managers.withColumnsRenamed({"id": "new_value", "name": "new_name"})
    of_departments = (
        changes(dept_manager, "dept_no", "emp_no", MANAGER_CHANGE)
        .join(departments, "dept_no")
        .join(old, "old_value", "left")
        .join(new, "new_value", "left")
        .drop("old_value", "new_value")
        .withColumnsRenamed({"old_name": "old_value", "new_name": "new_value"})
        .select(*event("dept_no", F.col("dept_name")))
    )
    return of_employees.unionByName(of_departments).orderBy(
        "change_date", "change_type", "entity_id", "old_value", "new_value"
    )
