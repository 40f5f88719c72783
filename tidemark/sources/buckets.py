"""Tables stored in buckets of one key, so that joins and sums on it move no rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.model import SPECS, TableSpec
from tidemark.operators.quality import cast_to, dedup
from tidemark.operators.skew import HEAVY_WINDOW_ROWS, heavy_keys
from tidemark.session import PARTITION_BYTES, input_bytes
from tidemark.sources.writers import write_parquet

# The tables that the reports join on the employee.
KEY = "emp_no"
KEYED = ("employees", "dept_emp", "titles", "salaries")


def bucket_count(spark: SparkSession, tables: Sequence[DataFrame]) -> int:
    """A bucket for each ``PARTITION_BYTES`` of the largest table, as many as partitions at least."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, *(-(-input_bytes(df) // PARTITION_BYTES) for df in tables))


def write_bucketed(
    df: DataFrame, uri: str, key: str, buckets: int, sort_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite ``uri`` with Parquet files, one for each bucket of ``key``; the table read back.

    Whoever reads the folder otherwise sees plain Parquet: the bucketing is known
    to the frame returned alone, and no name stays in the catalog.
    """
    spark = df.sparkSession
    parts = df.repartition(buckets, key)
    if sort_by:
        parts = parts.sortWithinPartitions(*sort_by)
    name = f"tidemark_{uuid.uuid4().hex}"
    writer = parts.write.mode("overwrite").bucketBy(buckets, key).option("path", uri)
    writer.format("parquet").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


def clean_in_buckets(
    tables: dict[str, DataFrame],
    root: str,
    specs: dict[str, TableSpec] = SPECS,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """``clean`` the tables, store each as ``root/<name>.parquet`` and return them as stored.

    Those of ``KEYED`` are in equal buckets of the employee. Their rows move
    once: they are made unique where they lie in their bucket. A table with an
    employee of more than ``HEAVY_WINDOW_ROWS`` rows would have one bucket far
    larger than the others, which no join can divide again; then none is
    bucketed, and rows are spread by their whole keys.
    """
    cast = {
        name: cast_to(df, specs[name].schema, strict) if name in specs else df
        for name, df in tables.items()
    }
    keyed = [name for name in KEYED if name in cast]
    spark = next(iter(tables.values())).sparkSession
    histories = [cast[name] for name in keyed]
    spread = not keyed or heavy_keys(histories, [KEY], HEAVY_WINDOW_ROWS) is not None
    buckets = 0 if spread else bucket_count(spark, [tables[name] for name in keyed])
    stored = {}
    for name, df in cast.items():
        spec, uri = specs.get(name), f"{root}/{name}.parquet"
        sort_by = (spec.end, spec.start) if spec and spec.start else ()
        if name in keyed and not spread:
            unique = dedup(df.repartition(buckets, KEY), spec.key)
            stored[name] = write_bucketed(unique, uri, KEY, buckets, sort_by)
            continue
        write_parquet(dedup(df, spec.key) if spec else df, uri, sort_by)
        stored[name] = spark.read.schema(df.schema).parquet(uri)
    return stored
