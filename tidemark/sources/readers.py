"""Table readers: a folder of Parquet tables, or a database over JDBC.

The JDBC driver jar must be on driver and executors (``spark.jars`` or
``--packages``); user and password are arguments and never stored here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType

from tidemark.model import SPECS, TableSpec

FETCH_SIZE = 10_000


def read_tables(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(SPECS),
    specs: dict[str, TableSpec] | None = None,
) -> dict[str, DataFrame]:
    """The tables below ``root``, one Parquet folder or file each.

    Types are taken from the files, so that they can be checked. For tables
    known to be clean ``specs`` gives them and saves a job per table.
    """
    tables = {}
    for name in names:
        reader = spark.read
        if specs and name in specs:
            reader = reader.schema(specs[name].schema)
        tables[name] = reader.parquet(f"{root}/{name}.parquet")
    return tables


def as_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables known to Spark SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read, split into ``partitions`` ranges of ``key``.

    Without a key, bounds (an empty table) or partitions it is a single read.
    """
    options = {"fetchsize": str(FETCH_SIZE), **properties, "url": url, "dbtable": table}
    if key and bounds and partitions and partitions > 1:
        options.update(
            partitionColumn=key,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def _bounds(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], key: str
) -> tuple[int, int] | None:
    """Lowest and highest key, computed by the database."""
    query = f"(select min({key}) as lo, max({key}) as hi from {table}) bounds"
    options = jdbc_options(url, query, properties)
    row = spark.read.format("jdbc").options(**options).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One table, read in parallel over an integer ``key`` if one is given."""
    split = bool(key and partitions and partitions > 1)
    bounds = _bounds(spark, url, table, properties, key) if split else None
    options = jdbc_options(url, table, properties, key, bounds, partitions)
    return spark.read.format("jdbc").options(**options).load()


def split_column(table: str) -> str | None:
    """The first integer column of the table's key: what a read is split on."""
    spec = SPECS[table]
    whole = (IntegerType, LongType)
    return next((c for c in spec.key if isinstance(spec.schema[c].dataType, whole)), None)


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    names: Iterable[str] = tuple(SPECS),
    partitions: int | None = None,
) -> dict[str, DataFrame]:
    """The named tables of one database, lazily."""
    return {
        name: read_jdbc(spark, url, name, properties, split_column(name), partitions)
        for name in names
    }
