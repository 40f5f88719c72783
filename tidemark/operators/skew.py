"""Finding the keys that hold too many rows for one task, and splitting them by day.

Both searches count exactly, whatever the number of heavy keys: what they find
is a table in the shared scratch folder that is joined, not a list. They run
when called, over the key columns (and one day column) of the frames given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import row_count
from tidemark.session import new_scratch_path

# A key with more intervals than this is split into slots in the interval joins,
# if its rows on both sides make more pairs than one task compares in some seconds.
HEAVY_ROWS = 1_000
HEAVY_PAIRS = 1_000_000_000

# A key with more rows than this is kept out of the windows over a key.
HEAVY_WINDOW_ROWS = 1_000_000

BOUNDS = "_bounds"
FIRSTS = "_firsts"
LEVELS = "_levels"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again, so that its size is known."""
    target = new_scratch_path(df.sparkSession, name)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def _over(frames: Sequence[DataFrame], keys: Sequence[str], min_rows: int) -> DataFrame:
    """Keys and count ``_n`` where a frame has more than ``min_rows`` rows of a key without null."""
    parts = [frame.select(F.lit(i).alias("_frame"), *keys) for i, frame in enumerate(frames)]
    counts = reduce(DataFrame.unionAll, parts).groupBy("_frame", *keys).agg(row_count().alias("_n"))
    return counts.dropna(subset=list(keys)).filter(F.col("_n") > min_rows)


def heavy_keys(
    frames: Sequence[DataFrame], keys: Sequence[str], min_rows: int = HEAVY_ROWS
) -> DataFrame | None:
    """The keys that occur more than ``min_rows`` times in a frame, or None if none does.

    Rows are counted in each task before they move, and the keys are only
    stored if there are any. Null keys never join and are left out.
    """
    heavy = _over(frames, keys, min_rows)
    if not heavy.agg(row_count()).first()[0]:
        return None
    return _stored(heavy.select(*keys).distinct(), "heavy")


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted over all tasks, with the number of its range and its place in the order.

    Stored, so that ranges stay as they were cut. Rows equal in ``order`` are in
    one range.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = spread.withColumn("_place", F.monotonically_increasing_id())
    return _stored(placed.withColumn("_range", F.spark_partition_id()), "ranges")


def _with_many_pairs(
    heavy: DataFrame, frames: Sequence[DataFrame], against: DataFrame, keys: Sequence[str]
) -> DataFrame | None:
    """Those of the heavy keys whose rows on both sides make more than ``HEAVY_PAIRS`` pairs."""

    def counts(frame: DataFrame, name: str) -> DataFrame:
        held = frame.select(*keys).join(heavy, list(keys), "left_semi")
        return held.groupBy(*keys).agg(row_count().cast("double").alias(name))

    right = reduce(DataFrame.unionAll, [counts(f, "_n") for f in frames])
    pairs = right.join(counts(against, "_m"), list(keys)).filter(
        F.col("_n") * F.col("_m") > HEAVY_PAIRS
    )
    kept = _stored(pairs.select(*keys).distinct(), "heavy")
    return None if kept.isEmpty() else kept


def heavy_slots(
    frames: Sequence[DataFrame],
    keys: Sequence[str],
    start: str = "from_date",
    min_rows: int = HEAVY_ROWS,
    against: DataFrame | None = None,
) -> DataFrame | None:
    """The heavy keys with the days at which their slots begin, or None if there are none.

    ``against`` is the other side of the join: a key with few rows there is
    compared sooner than split, so it is not heavy. The other side is only
    counted if there are heavy keys at all.

    A key's rows are counted by day, and a slot ends with the day that brings it
    to ``min_rows``. So the bounds follow the key's own rows, in whatever years
    they lie, and no more than ``min_rows`` rows and those of one day begin in a
    slot. The window that adds up sees one row for each day of a key.

    The days are kept in rows of about the square root of their number, so that
    a slot is found without looking at all of them.
    """
    if against is not None:
        most = _over(frames, keys, min_rows).agg(F.max("_n")).first()[0]
        if not most or most * against.count() <= HEAVY_PAIRS:
            return None
    heavy = heavy_keys(frames, keys, min_rows)
    if heavy is not None and against is not None:
        heavy = _with_many_pairs(heavy, frames, against, keys)
    if heavy is None:
        return None
    rows = reduce(DataFrame.unionAll, [f.select(*keys, F.col(start).alias("_day")) for f in frames])
    days = (
        rows.join(heavy, list(keys), "left_semi")
        .filter("_day is not null")
        .groupBy(*keys, "_day")
        .agg(row_count().alias("_n"))
    )
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / max(1, min_rows))
    slots = days.withColumn("_slot", number).groupBy(*keys, "_slot").agg(F.min("_day").alias("_day"))
    listed = slots.groupBy(*keys).agg(F.array_sort(F.collect_list("_day")).alias("_days"))
    width = F.ceil(F.sqrt(F.size("_days"))).cast("int")
    nested = F.transform(
        F.sequence(F.lit(1), F.size("_days"), width), lambda i: F.slice("_days", i, width)
    )
    # Slots are numbered from 0, so there is one more than there are days. Nodes of
    # the highest level span the largest power of two of them that there is.
    levels = F.length(F.bin(F.size("_days") + 1)) - 1
    firsts = F.transform(BOUNDS, lambda part: part[0])
    cut = listed.select(*keys, nested.alias(BOUNDS), levels.alias(LEVELS)).withColumn(FIRSTS, firsts)
    slots = _stored(cut, "slots")
    return None if slots.isEmpty() else slots


def slot_of(day: Column) -> Column:
    """The slot of a day in its key's bounds; 0 for other keys and before the first bound.

    It never decreases with the day.
    """

    def reached(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda bound: bound <= day))

    part = reached(F.col(FIRSTS))
    width = F.size(F.element_at(BOUNDS, 1))
    inside = (part - 1) * width + reached(F.element_at(F.col(BOUNDS), part))
    return F.when(F.col(FIRSTS).isNull() | day.isNull() | (part == 0), 0).otherwise(inside)


def _node(kind: int, level: Column, index: Column) -> Column:
    """One number for a node: ``kind`` (1 or 2), level and place in the level; never 0."""
    return (index.cast("bigint") * 64 + level) * 3 + kind


def _halved(slot: Column, level: Column) -> Column:
    return F.call_function("shiftright", slot, level)


def ancestors(slot: Column, kind: int) -> Column:
    """The nodes above a slot, one a level: 1 + log2 of the number of slots."""
    levels = F.sequence(F.lit(0), F.col(LEVELS))
    return F.transform(levels, lambda i: _node(kind, i, _halved(slot, i)))


def cover(first: Column, last: Column, kind: int) -> Column:
    """The largest nodes that together span the slots from ``first`` to ``last``, each slot once.

    At most two a level. On each level what is left begins at ``low`` and ends
    before ``high``; an odd begin, or an end whose last node is a left child,
    belongs to no larger node. Empty if ``last`` is before ``first``.
    """

    def of_level(i: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), i)
        low, high = _halved(first + size - 1, i), _halved(last + 1, i)
        at_low = F.when((low < high) & (low % 2 == 1), _node(kind, i, low))
        at_high = F.when((low < high) & (high % 2 == 1), _node(kind, i, high - 1))
        return F.array(at_low, at_high)

    nodes = F.flatten(F.transform(F.sequence(F.lit(0), F.col(LEVELS)), of_level))
    return F.filter(nodes, lambda node: node.isNotNull())
