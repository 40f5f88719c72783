"""Table declarations: schemas, keys and the two dates every report turns on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

# The end date that marks a row as still valid, the day on which
# still-valid rows are counted as ending, the year lengths the reports use, the
# period of the change report, and the labels that reports show.
OPEN_END = date(9999, 1, 1)
AS_OF = date(2002, 12, 31)
DAYS_PER_YEAR = 365
DAYS_PER_TENURE_YEAR = 365.25
PERIOD_START = date(2000, 1, 1)
PERIOD_END = date(2000, 6, 30)
DEPARTMENT_CHANGE = "Department Change"
TITLE_CHANGE = "Title Change"
SALARY_CHANGE = "Salary Change"
MANAGER_CHANGE = "Manager Change"
LOWEST_RETENTION = "Lowest Retention"
HIGHEST_RETENTION = "Highest Retention"


@dataclass(frozen=True)
class TableSpec:
    """Declared schema and primary key of one table.

    ``start`` and ``end`` name the valid-time columns of a history table and
    are None for a table that holds one row per entity.
    """

    schema: StructType
    key: tuple[str, ...]
    start: str | None = None
    end: str | None = None


def _fields(*columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


def _history(key: tuple[str, ...], *columns) -> TableSpec:
    bounds = (("from_date", DateType()), ("to_date", DateType()))
    return TableSpec(_fields(*columns, *bounds), key, "from_date", "to_date")


# Columns, types and keys of the tables.
SPECS: dict[str, TableSpec] = {
    "employees": TableSpec(
        _fields(
            ("emp_no", IntegerType()),
            ("birth_date", DateType()),
            ("first_name", StringType()),
            ("last_name", StringType()),
            ("gender", StringType()),
            ("hire_date", DateType()),
        ),
        ("emp_no",),
    ),
    "departments": TableSpec(
        _fields(("dept_no", StringType()), ("dept_name", StringType())),
        ("dept_no",),
    ),
    "dept_emp": _history(
        ("emp_no", "dept_no", "from_date"),
        ("emp_no", IntegerType()),
        ("dept_no", StringType()),
    ),
    "dept_manager": _history(
        ("emp_no", "dept_no", "from_date"),
        ("emp_no", IntegerType()),
        ("dept_no", StringType()),
    ),
    "titles": _history(
        ("emp_no", "title", "from_date"),
        ("emp_no", IntegerType()),
        ("title", StringType()),
    ),
    "salaries": _history(
        ("emp_no", "from_date"),
        ("emp_no", IntegerType()),
        ("salary", IntegerType()),
    ),
}
