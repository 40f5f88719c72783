"""The reports on small tables whose results can be told by hand."""

import pytest

from frames import OPEN, day, departments, employees, rows, table
from tidemark import plans
from tidemark.plans import reports


def test_overlap_counts_whole_in_the_year_it_starts(spark):
    salaries = table(spark, "salaries", (1, 36500, "1999-07-01", "2000-06-30"))
    stays = table(spark, "dept_emp", (1, "d1", "1999-01-01", OPEN))
    got = rows(plans.annual_salary_by_department(stays, departments(spark, "d1"), salaries))
    assert got == [(1999, "Dept d1", 36500, 1)]


def test_salary_is_prorated_on_a_switch(spark):
    salaries = table(spark, "salaries", (1, 36500, "1999-01-01", "2000-01-01"), (1, 73000, "2002-12-01", OPEN))
    stays = table(
        spark, "dept_emp", (1, "d1", "1998-01-01", "1999-04-11"), (1, "d2", "1999-04-11", OPEN)
    )
    df = plans.annual_salary_by_department(stays, departments(spark, "d1", "d2"), salaries)
    assert df.columns == ["year", "dept_name", "total_salary", "employee_count"]
    assert [tuple(r) for r in df.collect()] == [
        (1999, "Dept d1", 10000, 1),
        (1999, "Dept d2", 26500, 1),
        (2002, "Dept d2", 6000, 1),
    ]


def test_career_progression(spark):
    titles = table(
        spark,
        "titles",
        (1, "a", "2000-01-01", "2001-01-01"),
        (1, "b", "2001-01-01", OPEN),
        (1, "a", "1999-01-01", "2000-01-01"),
        (2, "a", "2001-12-31", OPEN),
        (9, "a", "2001-12-31", OPEN),
    )
    got = [tuple(r) for r in plans.career_progression(employees(spark, 1, 2), titles).collect()]
    assert got == [(1, "F1 L1", 2, 1.33), (2, "F2 L2", 1, 1.0)]


def test_turnover_counts_rows_over_people(spark):
    stays = table(
        spark,
        "dept_emp",
        (1, "d1", "1990-01-01", "1991-01-01"),
        (1, "d1", "1992-01-01", "1993-01-01"),
        (1, "d1", "1994-01-01", OPEN),
        (2, "d2", "1994-01-01", OPEN),
    )
    got = [tuple(r) for r in plans.department_turnover(departments(spark, "d1", "d2"), stays).collect()]
    assert got == [("d1", "Dept d1", 1, 2, 200.0), ("d2", "Dept d2", 1, 0, 0.0)]


def test_salary_on_the_day_of_a_switch_counts_twice(spark):
    salaries = table(
        spark, "salaries", (1, 100, "1995-01-01", OPEN), (8, 900, "1995-01-01", OPEN)
    )
    stays = table(
        spark,
        "dept_emp",
        (1, "d1", "1990-01-01", "1995-01-01"),
        (1, "d2", "1995-01-01", OPEN),
        (8, "d1", "1990-01-01", OPEN),
    )
    titles = table(spark, "titles", (1, "t", "1990-01-01", OPEN), (8, "t", "1990-01-01", OPEN))
    args = salaries, employees(spark, 1), stays, departments(spark, "d1", "d2"), titles
    got = [tuple(r) for r in plans.salary_trends(*args).collect()]
    assert got == [(1995, "Dept d1", "t", 100.0), (1995, "Dept d2", "t", 100.0)]


def test_salary_trends_with_heavy_keys_split(spark, monkeypatch):
    salaries = table(
        spark, "salaries", *[(1, 100 + y, f"{y}-03-01", f"{y + 1}-03-01") for y in range(1985, 2003)]
    )
    stays = table(spark, "dept_emp", (1, "d1", "1985-01-01", "1993-03-01"), (1, "d2", "1993-03-01", OPEN))
    titles = table(spark, "titles", (1, "t", "1985-01-01", "1990-01-01"), (1, "u", "1990-01-01", OPEN))
    args = salaries, employees(spark, 1), stays, departments(spark, "d1", "d2"), titles
    whole = rows(plans.salary_trends(*args))
    found = reports.heavy_slots
    monkeypatch.setattr(
        reports, "heavy_slots", lambda frames, keys, against=None: found(frames, keys, min_rows=1)
    )
    assert rows(plans.salary_trends(*args)) == whole
    assert len(whole) == 19


def test_senior_employees_ties_and_current_only(spark):
    ids = range(1, 15)
    stays = table(spark, "dept_emp", *[(n, "d1", "1990-01-01", OPEN) for n in ids if n != 3])
    titles = table(spark, "titles", *[(n, "t", "1990-01-01", OPEN) for n in ids])
    df = plans.senior_employees(employees(spark, *ids), stays, departments(spark, "d1"), titles)
    got = df.collect()
    assert [r.emp_no for r in got] == [1, 2, 4, 5, 6, 7, 8, 9, 10, 11]
    assert got[0].years_of_service == 4747 / 365


def manager_args(spark, *terms):
    stays = table(spark, "dept_emp", (1, "d1", "1994-01-01", OPEN), (5, "d2", "2002-01-01", OPEN))
    return (
        table(spark, "dept_manager", *terms),
        employees(spark, 1, 5, 10, 20),
        departments(spark, "d1", "d2"),
        stays,
    )


def test_current_employee_counts_past_an_ended_term(spark):
    args = manager_args(
        spark, (10, "d1", "1990-01-01", "1995-01-01"), (20, "d2", "2000-01-01", OPEN)
    )
    got = [tuple(r) for r in plans.manager_impact(*args).collect()]
    assert got == [
        (20, "F20 L20", "Dept d2", 1.0, "Lowest Retention"),
        (10, "F10 L10", "Dept d1", 9.0, "Highest Retention"),
    ]
    clipped = [tuple(r) for r in plans.manager_impact(*args, clip_to_manager=True).collect()]
    assert [r[3] for r in clipped] == [1.0, 1.0]
    assert {r[4] for r in clipped} <= {"Lowest Retention", "Highest Retention"}


def test_single_manager_is_lowest(spark):
    args = manager_args(spark, (10, "d1", "1990-01-01", OPEN))
    assert [r.retention_type for r in plans.manager_impact(*args).collect()] == ["Lowest Retention"]


def test_gender_other_counts_in_total_only(spark):
    people = table(
        spark,
        "employees",
        (1, "1960-01-01", "A", "B", "M", "1990-01-01"),
        (2, "1960-01-01", "A", "B", "F", "1990-01-01"),
        (3, "1960-01-01", "A", "B", "X", "1990-01-01"),
        (4, "1960-01-01", "A", "B", None, "1990-01-01"),
        (5, "1960-01-01", "A", "B", "M", "1990-01-01"),
    )
    stays = table(
        spark,
        "dept_emp",
        *[(n, "d1", "1990-01-01", OPEN) for n in range(1, 6)],
        (1, "d2", "1980-01-01", "1990-01-01"),
    )
    got = rows(plans.gender_ratio(people, stays, departments(spark, "d1", "d2")))
    assert got == [("d1", "Dept d1", 2, 1, 40.0, 20.0, 20.0)]


def test_job_hoppers_need_more_than_three_rows(spark):
    stays = table(
        spark,
        "dept_emp",
        *[(n, "d1", f"19{80 + i}-01-01", f"19{81 + i}-01-01") for n in (3, 4, 5) for i in range(n)],
    )
    df = plans.job_hoppers(stays, employees(spark, 3, 4, 5))
    assert df.columns == ["emp_no", "first_name", "last_name", "dept_change_count"]
    assert [tuple(r) for r in df.collect()] == [(5, "F5", "L5", 5), (4, "F4", "L4", 4)]


def master_args(spark):
    stays = table(
        spark,
        "dept_emp",
        (1, "d1", "1990-01-01", OPEN),
        (1, "d2", "1995-01-01", OPEN),
        (2, "d1", "1990-01-01", OPEN),
        (2, "d1", "1995-01-01", OPEN),
        (3, "d1", "1990-01-01", "1995-01-01"),
    )
    titles = table(spark, "titles", *[(n, "t", "1990-01-01", OPEN) for n in (1, 2, 3)])
    pay = table(spark, "salaries", *[(n, n * 100, "1990-01-01", OPEN) for n in (1, 2, 3)])
    return employees(spark, 1, 2, 3), stays, titles, pay, departments(spark, "d1", "d2")


def test_master_keeps_one_row_per_employee(spark):
    hired = day("1990-01-01")
    assert rows(plans.employee_master(*master_args(spark))) == [
        (1, "F1 L1", "Dept d2", "t", 100, hired, 13),
        (2, "F2 L2", "Dept d1", "t", 200, hired, 13),
    ]


def test_master_can_keep_equal_open_rows(spark):
    got = rows(plans.employee_master(*master_args(spark), keep_equal=True))
    assert [r[0] for r in got] == [1, 2, 2]


def changes(spark, managers, people):
    stays = table(spark, "dept_emp", (1, "d001", "1990-01-01", "2000-02-01"), (1, "d002", "2000-02-01", OPEN))
    titles = table(spark, "titles", (1, "a", "1990-01-01", "2000-03-01"), (1, "b", "2000-03-01", OPEN))
    pay = table(spark, "salaries", (1, 100, "1999-03-01", "2000-03-01"), (1, 200, "2000-03-01", OPEN))
    return plans.employee_changes(
        people, stays, titles, pay, managers, departments(spark, "d001", "d002")
    )


@pytest.mark.parametrize("heavy_rows", [10**6, 0])
def test_changes_of_all_kinds(spark, monkeypatch, heavy_rows):
    monkeypatch.setattr(reports, "HEAVY_WINDOW_ROWS", heavy_rows)
    managers = table(
        spark, "dept_manager", (1, "d001", "1990-01-01", "2000-01-01"), (77, "d001", "2000-01-01", OPEN)
    )
    df = changes(spark, managers, employees(spark, 1))
    assert df.dtypes == [
        ("entity_id", "string"),
        ("entity_name", "string"),
        ("change_date", "date"),
        ("change_type", "string"),
        ("old_value", "string"),
        ("new_value", "string"),
    ]
    assert [tuple(r) for r in df.collect()] == [
        ("d001", "Dept d001", day("2000-01-01"), "Manager Change", "F1 L1", None),
        ("1", "F1 L1", day("2000-02-01"), "Department Change", "d001", "d002"),
        ("1", "F1 L1", day("2000-03-01"), "Salary Change", "100", "200"),
        ("1", "F1 L1", day("2000-03-01"), "Title Change", "a", "b"),
    ]


def test_changes_of_unknown_employees_drop_out(spark):
    managers = table(spark, "dept_manager")
    assert changes(spark, managers, employees(spark, 2)).count() == 0


@pytest.mark.parametrize("period", [(None, "2000-01-01"), ("2000-01-01", "soon")])
def test_changes_need_a_period(spark, period):
    people = employees(spark, 1)
    empty = [table(spark, n) for n in ("dept_emp", "titles", "salaries", "dept_manager", "departments")]
    with pytest.raises(ValueError):
        plans.employee_changes(people, *empty, *period)


def test_master_without_a_latest_value(spark):
    stays = table(spark, "dept_emp", (1, "d1", "1990-01-01", OPEN), (2, "d1", "1990-01-01", OPEN))
    titles = table(spark, "titles", (1, None, "1995-01-01", OPEN), (1, "t", "1990-01-01", OPEN))
    titles = titles.union(table(spark, "titles", (2, "t", "1990-01-01", OPEN)))
    pay = table(spark, "salaries", (1, 10, "1990-01-01", OPEN), (2, 10, "1990-01-01", OPEN))
    args = employees(spark, 1, 2), stays, titles, pay, departments(spark, "d1")
    for keep_equal in (False, True):
        assert [r.emp_no for r in plans.employee_master(*args, keep_equal=keep_equal).collect()] == [2]
