"""State and change operators over one history table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_day, is_open
from tidemark.operators.skew import HEAVY_WINDOW_ROWS, heavy_keys, in_ranges


def current_rows(df: DataFrame, end: str = "to_date") -> DataFrame:
    """Rows that have not ended. The filter reaches the Parquet scan."""
    return df.filter(is_open(end))


def closed_rows(df: DataFrame, end: str = "to_date") -> DataFrame:
    """Rows that have ended; a null end is neither open nor closed."""
    return df.filter(~is_open(end))


def latest_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str = "from_date",
    tie: Sequence[str] = (),
    keep_equal: Sequence[str] = (),
) -> DataFrame:
    """The row with the latest ``order`` per key, ties broken by ``tie`` descending.

    A row number limited to 1 is cut down on the map side before the shuffle
    and again after it, so a hot key sends one row per input task. With
    ``keep_equal`` every row stays that equals the latest one in these columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (order, *tie)])
    latest = df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")
    if not keep_equal:
        return latest
    values = [*keys, *keep_equal]
    return df.join(latest.select(*values), values, "left_semi")


def last_values(
    df: DataFrame,
    key: str,
    value: str,
    until: date | str | Column,
    at: str = "from_date",
    after: date | str | Column | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Columns key, at, value: each key's last row up to ``until``, ties by the larger value.

    Rows without a key are left out; a row without a day comes before all others.
    With ``before``, the last values up to the day ``after``, only later rows are
    read. What is combined is one row a key and task.
    """
    rows = df.select(key, F.col(at).alias("at"), F.col(value).alias("value"))
    rows = rows.filter(F.col(key).isNotNull())
    if before is None:
        rows = rows.filter((F.col("at") <= as_day(until)) | F.col("at").isNull())
    else:
        rows = rows.filter((F.col("at") > as_day(after)) & (F.col("at") <= as_day(until)))
        rows = rows.unionByName(before)
    last = F.max(F.struct("at", "value")).alias("last")
    return rows.groupBy(key).agg(last).select(key, "last.at", "last.value")


def value_changes(
    df: DataFrame,
    key: str,
    value: str,
    start: date | str | Column,
    end: date | str | Column,
    label: str,
    at: str = "from_date",
    heavy: DataFrame | bool | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Changes of ``value`` per key that take effect from ``start`` to ``end``.

    The previous value is that of the row before in the order (``at``,
    ``value``) over the whole history. A key's first row is no change, and a
    null on either side is none; rows without a key are left out. Result: key,
    change_date, old_value, new_value, change_type.

    Rows after the period are dropped first, as nothing before depends on them.
    The rest is put in order by key, but for the keys with too many rows for
    one task: those are handled in a way that never gathers a key's rows.
    ``heavy`` replaces the search for them, ``False`` turns it off.

    ``before`` has the ``last_values`` of the history up to the day before
    ``start``. Then only rows of the period are read.
    """
    first, last = as_day(start), as_day(end)
    rows = df.select(key, F.col(at).alias("at"), F.col(value).alias("value"))
    rows = rows.filter(F.col(key).isNotNull())
    if before is None:
        rows = rows.filter((F.col("at") <= last) | F.col("at").isNull())
    else:
        rows = rows.filter(F.col("at").between(first, last))
    if heavy is None:
        heavy = heavy_keys([df if before is None else rows], [key], HEAVY_WINDOW_ROWS)
    if before is not None:
        rows = rows.unionByName(before)
    if isinstance(heavy, DataFrame):
        pairs = _ordered_pairs(rows.join(heavy, key, "left_anti"), key, first).unionByName(
            _heavy_pairs(rows.join(heavy, key, "left_semi"), key, first)
        )
    else:
        pairs = _ordered_pairs(rows, key, first)
    return pairs.filter(F.col("new_value") != F.col("old_value")).select(
        key,
        F.col("at").alias("change_date"),
        "old_value",
        "new_value",
        F.lit(label).alias("change_type"),
    )


def _ordered_pairs(rows: DataFrame, key: str, first: Column) -> DataFrame:
    """Each value from ``first`` on with the one before it: one shuffle by key."""
    in_order = Window.partitionBy(key).orderBy("at", "value")
    previous = F.lag("value").over(in_order)
    return rows.select(
        key, "at", previous.alias("old_value"), F.col("value").alias("new_value")
    ).filter(F.col("at") >= first)


def _heavy_pairs(rows: DataFrame, key: str, first: Column) -> DataFrame:
    """The same pairs but those of equal values, without a window over a key's rows.

    History before the period counts through its last row, a maximum combined
    on the map side. What is in the period is put in order by ranges of (key,
    day, value), so that a key, or a day of it, is spread over as many tasks as
    it needs. Rows that are equal in all three are one: there is no change
    between them. Each range looks back within itself, and its first row at the
    last row of the range before, of which there is one for each range. The
    ranges are stored, since they would be cut elsewhere when made again.
    """
    period = rows.filter(F.col("at") >= first).distinct()
    before = (
        rows.filter((F.col("at") < first) | F.col("at").isNull())
        .groupBy(key)
        .agg(F.max(F.struct("at", "value")).alias("last"))
        .select(key, "last.at", "last.value")
    )
    order = (key, "at", "value")
    placed = in_ranges(period.unionByName(before), order)
    row = F.struct(F.col(key).alias("key"), "value")
    ends = placed.groupBy("_range").agg(F.max_by(row, "_place").alias("end"))
    carried = ends.select("_range", F.lag("end").over(Window.orderBy("_range")).alias("carried"))
    within = F.lag(row).over(Window.partitionBy("_range").orderBy("_place"))
    previous = placed.withColumn("previous", within).join(carried, "_range")
    previous = previous.withColumn("previous", F.coalesce("previous", "carried"))
    old = F.when(F.col("previous.key") == F.col(key), F.col("previous.value"))
    return previous.select(
        key, "at", old.alias("old_value"), F.col("value").alias("new_value")
    ).filter(F.col("at") >= first)
