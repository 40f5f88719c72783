"""Checks and repairs of declared tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.values import row_count
from tidemark.model import SPECS, TableSpec
from tidemark.session import new_scratch_path


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls in each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: key values that occur more than once, and rows beyond the first.

    The second number is what ``dedup`` on this key removes.
    """
    groups = df.groupBy(*key).agg(row_count().alias("n")).filter("n > 1")
    return groups.agg(
        row_count().alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def _inverted(start: str, end: str) -> Column:
    return F.count_if(F.col(start) > F.col(end))


def inverted_intervals(df: DataFrame, start: str = "from_date", end: str = "to_date") -> DataFrame:
    """One row: how many intervals start after they end; null bounds do not count.

    A table without both columns has nothing to check and gives null.
    """
    if not {start, end} <= set(df.columns):
        return df.sparkSession.range(1).select(F.lit(None).cast("long").alias("inverted_intervals"))
    return df.agg(_inverted(start, end).alias("inverted_intervals"))


def type_diff(df: DataFrame, schema: StructType) -> list[tuple[str, str, str]]:
    """(column, type, declared type) where the two differ; reads the schema only."""
    found = dict(df.dtypes)
    declared = {f.name: f.dataType.simpleString() for f in schema}
    return [(c, found[c], t) for c, t in declared.items() if found.get(c, t) != t]


def _differing(df: DataFrame, schema: StructType) -> list[str]:
    return [column for column, *_ in type_diff(df, schema)]


def cast_to(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Cast the columns of a differing type to the declared one.

    Under ANSI mode a bad value is an error if ``strict`` and null otherwise.
    """
    casts = {}
    for c in _differing(df, schema):
        wanted = schema[c].dataType
        casts[c] = F.col(c).cast(wanted) if strict else F.col(c).try_cast(wanted)
    return df.withColumns(casts) if casts else df


def _failed(column: str, schema: StructType) -> Column:
    value = F.col(column)
    return F.count_if(value.isNotNull() & value.try_cast(schema[column].dataType).isNull())


def cast_failures(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows (column, failures): values a lenient cast would turn into null."""
    columns = _differing(df, schema)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, failures bigint")
    counts = df.agg(*[_failed(c, schema).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "failures")


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, or by all other columns if not given.

    So the row kept is always the same one, also if a task has to run again.
    """
    order = list(order) if order else [c for c in df.columns if c not in key]
    if not order:
        return df.dropDuplicates(list(key))
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def _finding(check: str, column: str, value: Column, detail: str | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        value.cast("long").alias("value"),
        F.lit(detail).cast("string").alias("detail"),
    )


def _cast_key(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The key columns as they are after a lenient cast."""
    differing = _differing(df, spec.schema)
    return [
        (F.col(c).try_cast(spec.schema[c].dataType) if c in differing else F.col(c)).alias(f"_key{i}")
        for i, c in enumerate(spec.key)
    ]


def _measures(name: str, df: DataFrame, spec: TableSpec | None) -> DataFrame:
    """All counts that need no key, in one aggregate of which each task hands on one row."""
    found = [_finding("rows", "*", row_count())]
    found += [_finding("nulls", c, F.count_if(F.col(c).isNull())) for c in df.columns]
    if spec:
        for c, type_found, declared in type_diff(df, spec.schema):
            detail = f"{type_found}, declared {declared}"
            found.append(_finding("type_mismatch", c, F.lit(1), detail))
            found.append(_finding("cast_failures", c, _failed(c, spec.schema)))
        if spec.start and {spec.start, spec.end} <= set(df.columns):
            inverted = _inverted(spec.start, spec.end)
            found.append(_finding("inverted_intervals", f"{spec.start},{spec.end}", inverted))
    rows = df.agg(F.array(*found).alias("all")).select(F.explode("all").alias("f"))
    return rows.select(F.lit(name).alias("table"), "f.*")


def _hash_of(key: list[Column]) -> Column:
    return F.xxhash64(*key)


def _met_again(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame | None:
    """The hashes (_table, _hash) that several keys of a table's rows have; None if there are none.

    A row moves as a hash and a count, combined in each task, and for all tables
    in one job. What is left is stored, so that its size is known.
    """
    parts = [
        df.select(F.lit(name).alias("_table"), _hash_of(_cast_key(df, specs[name])).alias("_hash"))
        for name, df in tables.items()
        if name in specs
    ]
    if not parts:
        return None
    counts = reduce(DataFrame.unionAll, parts).groupBy("_table", "_hash").agg(row_count().alias("_n"))
    target = new_scratch_path(parts[0].sparkSession, "hashes")
    counts.filter("_n > 1").select("_table", "_hash").write.parquet(target)
    found = parts[0].sparkSession.read.parquet(target)
    return None if found.isEmpty() else found


def _duplicates(name: str, df: DataFrame, spec: TableSpec, again: DataFrame | None) -> DataFrame:
    """Keys that occur more than once, by the keys themselves of the rows whose hash was met again."""
    label = ",".join(spec.key)
    columns = ("duplicate_keys", "surplus_rows")
    if again is None:
        counts = df.sparkSession.range(1).select(*[F.lit(0).alias(c) for c in columns])
    else:
        key = _cast_key(df, spec)
        rows = df.select(*key, _hash_of(key).alias("_hash"))
        rows = rows.join(again.filter(F.col("_table") == name), "_hash", "left_semi")
        counts = duplicate_keys(rows, [f"_key{i}" for i in range(len(key))])
    found = [_finding(c, label, F.col(c)) for c in columns]
    rows = counts.select(F.explode(F.array(*found)).alias("f"))
    return rows.select(F.lit(name).alias("table"), "f.*")


def profile(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """All checks of all tables as rows (table, check, column, value, detail).

    Counts by column are one global aggregate for each table. Keys are counted
    by hash first, in a job that runs when this is called and reads key columns
    alone; only rows whose hash was met again are counted by the key itself. So
    no measures move by key, and no keys that are unique. Keys are compared as
    they are after a lenient cast, so ``surplus_rows`` is what ``clean``
    removes. ``detail`` has the types of a mismatch. A table without a spec has
    no key and no declared types.
    """
    again = _met_again(tables, specs)
    held = {r[0] for r in again.select("_table").distinct().collect()} if again is not None else set()
    parts = []
    for name, df in tables.items():
        spec = specs.get(name)
        parts.append(_measures(name, df, spec))
        if spec:
            parts.append(_duplicates(name, df, spec, again if name in held else None))
    return reduce(DataFrame.unionByName, parts)


def clean(
    tables: dict[str, DataFrame],
    specs: dict[str, TableSpec] = SPECS,
    strict: bool = True,
    fix_nulls=None,
) -> dict[str, DataFrame]:
    """New dict of tables cast to their schema and unique by key.

    ``fix_nulls(df)``, if given, runs between the two steps; nulls are kept
    by default.
    """
    cleaned = {}
    for name, df in tables.items():
        spec = specs.get(name)
        if spec:
            df = cast_to(df, spec.schema, strict)
        if fix_nulls:
            df = fix_nulls(df)
        cleaned[name] = dedup(df, spec.key) if spec else df
    return cleaned
