"""The six personnel tables, derived from the order tables of a test folder.

A customer is an employee, an order day a department assignment, the first
order status of a year that begins on 1 April a title, the largest order of a
calendar year a salary. The histories end on different days, so intervals of
one employee overlap only in part.

Every history is first reduced to one row per key and period by an aggregate
that combines on the map side. What the window behind it then sees of a key is
bounded by the number of days or years, whatever the number of orders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.model import OPEN_END, SPECS
from tidemark.session import new_scratch_path
from tidemark.sources.readers import read_tables
from tidemark.sources.writers import write_tables

_stored: dict[tuple, str] = {}


def sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The two tables that everything is derived from."""
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in ("orders", "customer")]


def _files(spark: SparkSession, folder: str) -> tuple:
    """Name, size and modification time of the files of both source tables."""
    context, found = spark.sparkContext, []
    for name in ("orders", "customer"):
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        for file in path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path):
            found.append((str(file.getPath()), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as the assignment it stands for; a customer's day may repeat."""
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_custkey").cast("int").alias("emp_no"),
        F.concat(F.lit("d00"), F.substring("o_orderpriority", 1, 1)).alias("dept_no"),
        F.col("o_orderdate").cast("date").alias("from_date"),
        "o_orderkey",
    )


def _ended_by_next(df: DataFrame, key: str) -> DataFrame:
    """Let each row end where the next row of its key starts."""
    following = F.lead("from_date").over(Window.partitionBy(key).orderBy("from_date"))
    return df.withColumn("to_date", F.coalesce(following, F.lit(OPEN_END)))


def _first_of_year(year: Column, month: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(1))


def derive(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables as lazy frames over ``orders`` and ``customer``."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    dept_no = F.concat(F.lit("d00"), F.substring("o_orderpriority", 1, 1))
    emp_no = F.col("o_custkey").cast("int")
    day = F.col("o_orderdate").cast("date")
    year = F.year("o_orderdate")

    departments = orders.select(
        dept_no.alias("dept_no"), F.expr("substr(o_orderpriority, 3)").alias("dept_name")
    ).distinct()

    hired = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(day).alias("hire_date"))
    employees = customer.join(hired, "c_custkey").select(
        F.col("c_custkey").cast("int").alias("emp_no"),
        F.lit(date(1950, 1, 1)).alias("birth_date"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(F.col("c_nationkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        "hire_date",
    )

    dept_emp = (
        assignments(spark, folder)
        .groupBy("emp_no", "from_date")
        .agg(F.min(F.struct("o_orderkey", "dept_no")).alias("first"))
        .select("emp_no", "first.dept_no", "from_date")
    )

    turn = year + F.when(F.month("o_orderdate") >= 4, 1).otherwise(0)
    titles = (
        orders.groupBy(emp_no.alias("emp_no"), turn.alias("turn"))
        .agg(F.min(F.struct(day, "o_orderkey", "o_orderstatus")).alias("first"))
        .select(
            "emp_no",
            F.col("first.o_orderstatus").alias("title"),
            _first_of_year(F.col("turn") - 1, 4).alias("from_date"),
        )
    )

    salaries = (
        orders.groupBy(emp_no.alias("emp_no"), year.alias("year"))
        .agg(F.round(F.max("o_totalprice")).cast("int").alias("salary"))
        .select("emp_no", "salary", _first_of_year(F.col("year"), 1).alias("from_date"))
    )

    largest = F.struct((-F.col("o_totalprice")).alias("rest"), "o_orderkey", emp_no.alias("emp_no"))
    dept_manager = (
        orders.groupBy("o_orderpriority", year.alias("year"))
        .agg(F.min(largest).alias("first"))
        .select(
            "first.emp_no",
            dept_no.alias("dept_no"),
            _first_of_year(F.col("year"), 1).alias("from_date"),
        )
    )

    return {
        "employees": employees,
        "departments": departments,
        "dept_emp": _ended_by_next(dept_emp, "emp_no"),
        "dept_manager": _ended_by_next(dept_manager, "dept_no"),
        "titles": _ended_by_next(titles, "emp_no"),
        "salaries": _ended_by_next(salaries, "emp_no"),
    }


def stored(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables written once per application to the shared scratch folder.

    Queries then scan Parquet: filters and columns are pushed down, and the
    size Catalyst compares with its broadcast threshold is the real one. They
    are derived anew when a source file is another, or of another time or size.
    """
    run = (spark.sparkContext.applicationId, *_files(spark, folder))
    if run not in _stored:
        root = new_scratch_path(spark, "staffing")
        _stored[run] = write_tables(derive(spark, folder), root)
    return read_tables(spark, _stored[run], specs=SPECS)
