"""Parquet and CSV sinks. ``uri`` is any path Hadoop can write to.

Each sink overwrites what is there, also by an empty result, so no file of an
earlier run is left to be taken for the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.model import SPECS, TableSpec


def write_parquet(df: DataFrame, uri: str, sort_by: Sequence[str] = ()) -> str:
    """Overwrite ``uri`` with Parquet.

    ``sort_by`` orders rows within each file, without a shuffle, so that a
    filter on the leading columns can skip row groups.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(uri)
    return uri


def write_csv(
    df: DataFrame,
    uri: str,
    single_file: bool = False,
    sort_by: Sequence = (),
    on_empty: str = "header",
) -> str | None:
    """Overwrite ``uri`` with CSV files that carry a header line.

    ``single_file`` sends everything through one task and is meant for reports
    whose size does not grow with the data; ``sort_by`` then orders that file.
    ``on_empty="skip"`` writes nothing for an empty frame and returns None,
    ``"header"`` writes a file with the header only.
    """
    if on_empty not in ("header", "skip"):
        raise ValueError(f"on_empty must be 'header' or 'skip', not {on_empty!r}")
    if on_empty == "skip" and df.isEmpty():
        return None
    if single_file:
        df = df.repartition(1)
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").option("header", True).csv(uri)
    return uri


def write_report(df: DataFrame, uri: str, single_file: bool = False) -> tuple[str, str]:
    """One report as Parquet and as CSV.

    The CSV is written from the stored Parquet, so the report is computed once.
    """
    write_parquet(df, uri)
    stored = df.sparkSession.read.schema(df.schema).parquet(uri)
    write_csv(stored, uri + "_csv", single_file)
    return uri, uri + "_csv"


def write_tables(
    tables: dict[str, DataFrame], root: str, specs: dict[str, TableSpec] = SPECS
) -> str:
    """Each table as ``root/<name>.parquet``; histories have open rows together."""
    for name, df in tables.items():
        spec = specs.get(name)
        sort_by = (spec.end, spec.start) if spec and spec.start else ()
        write_parquet(df, f"{root}/{name}.parquet", sort_by)
    return root
