"""Joins of valid-time intervals.

Both joins are equi-joins on the key with the date rule as a residual
condition. Catalyst takes a broadcast join if it knows the right side to be
below ``spark.sql.autoBroadcastJoinThreshold`` and a sort-merge join on the key
otherwise, where adaptive execution splits a partition that is too large on
either side.

What a split cannot cure is a key with many intervals on the right, as every
left row of the key is compared with all of them. The days of such keys
(``heavy_slots``) are cut into slots, which are the leaves of a binary tree. An
interval stands at the few nodes that together span its slots (``cover``), a day
at all nodes above its slot (``ancestors``): a day and an interval that holds it
meet at exactly one node, and rows grow by the logarithm of the slots, however
long the intervals are.

Two intervals overlap if one holds the day on which the other one starts. So an
overlap join of a heavy key is the sum of two such searches: right starts in
left intervals, and left starts in right intervals that start before. Both are
one join on key and node, since the node's number also says which of the two it
is for; rows of all other keys stand at node 0 and are not repeated.

The search for heavy keys runs when the join is built, over the keys of the
right side and, if any are found, of the left one. Give the side with fewer rows
per key as the right one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between, earlier_of, is_open, later_of
from tidemark.model import AS_OF
from tidemark.operators.skew import (
    BOUNDS,
    FIRSTS,
    LEVELS,
    ancestors,
    cover,
    heavy_slots,
    slot_of,
)

NODE = "_node"
SLOT = "_slot"
# Kinds of nodes: which side's start is looked for in the other side's intervals.
RIGHT_START, LEFT_START = 1, 2


def close_open_intervals(df: DataFrame, end: str = "to_date", as_of: date = AS_OF) -> DataFrame:
    """Same columns, with open ends replaced by ``as_of``."""
    return df.withColumn(end, F.when(is_open(end), F.lit(as_of)).otherwise(F.col(end)))


def _key_list(key: str | Sequence[str], left: DataFrame, right: DataFrame) -> list[str]:
    keys = [key] if isinstance(key, str) else list(key)
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"key {k} has different types on the two sides")
    return keys


def _placed(df: DataFrame, keys: list[str], heavy: DataFrame, nodes: Callable[[], Column]) -> DataFrame:
    """``df`` with the column of nodes: 0 for most keys, a row for each node for heavy ones."""
    only = F.when(F.col(LEVELS).isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(nodes())
    return df.join(heavy, keys, "left").withColumn(NODE, F.explode(only)).drop(BOUNDS, FIRSTS, LEVELS)


def _spanned(start: str, end: str, kind: int) -> Column:
    return cover(slot_of(F.col(start)), slot_of(F.col(end)), kind)


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    strict: bool = True,
    start: str = "from_date",
    end: str = "to_date",
    suffixes: tuple[str, str] = ("_left", "_right"),
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Pairs of rows with equal key whose intervals overlap.

    ``strict`` leaves out pairs that only touch. Columns both sides have get a
    suffix, the key excepted; overlap_start, overlap_end and overlap_days are
    added. ``heavy`` replaces the search for heavy keys, ``False`` turns it off.
    """
    keys = _key_list(key, left, right)
    if heavy is None:
        heavy = heavy_slots([right], keys, start, against=left)
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    from_l, to_l = (c + suffixes[0] for c in (start, end))
    from_r, to_r = (c + suffixes[1] for c in (start, end))

    begins = later_of(F.col(from_l), F.col(from_r))
    if strict:
        meets = (F.col(from_l) < F.col(to_r)) & (F.col(to_l) > F.col(from_r))
    else:
        meets = (F.col(from_l) <= F.col(to_r)) & (F.col(to_l) >= F.col(from_r))

    if isinstance(heavy, DataFrame):

        def of_left() -> Column:
            own = ancestors(slot_of(F.col(from_l)), LEFT_START)
            return F.concat(_spanned(from_l, to_l, RIGHT_START), own)

        def of_right() -> Column:
            own = ancestors(slot_of(F.col(from_r)), RIGHT_START)
            return F.concat(_spanned(from_r, to_r, LEFT_START), own)

        kind, right_later = F.col(NODE) % 3, F.col(from_r) >= F.col(from_l)
        once = (kind == 0) | ((kind == RIGHT_START) == right_later)
        left = _placed(left, keys, heavy, of_left)
        right = _placed(right, keys, heavy, of_right)
        pairs = left.join(right, [*keys, NODE]).filter(meets & once).drop(NODE)
    else:
        pairs = left.join(right, keys).filter(meets)

    ends = earlier_of(F.col(to_l), F.col(to_r))
    return pairs.withColumns({"overlap_start": begins, "overlap_end": ends}).withColumn(
        "overlap_days", days_between(F.col("overlap_start"), F.col("overlap_end"))
    )


def point_in_interval_join(
    points: DataFrame,
    history: DataFrame,
    key: str | Sequence[str],
    at: str,
    start: str = "from_date",
    end: str = "to_date",
    heavy: DataFrame | bool | None = None,
    keep_slot: bool = False,
) -> DataFrame:
    """Pairs with equal key where ``start <= at <= end``.

    The interval columns of ``history`` are dropped. With ``keep_slot`` and an
    explicit ``heavy`` a chain of such joins looks up the slots of the points
    once; if there are no heavy keys, it shares one partitioning of them.
    """
    keys = _key_list(key, points, history)
    if heavy is None:
        heavy = heavy_slots([history], keys, start, against=points)
    low, high = "_interval_start", "_interval_end"
    history = history.withColumnsRenamed({start: low, end: high})
    inside = F.col(at).between(F.col(low), F.col(high))
    if not isinstance(heavy, DataFrame):
        return points.join(history, keys).filter(inside).drop(low, high)
    if SLOT not in points.columns:
        points = points.join(heavy, keys, "left").withColumn(SLOT, slot_of(F.col(at)))
        points = points.drop(BOUNDS, FIRSTS)
    only = F.when(F.col(LEVELS).isNull(), F.array(F.lit(0).cast("bigint")))
    points = points.withColumn(NODE, F.explode(only.otherwise(ancestors(F.col(SLOT), RIGHT_START))))
    history = _placed(history, keys, heavy, lambda: _spanned(low, high, RIGHT_START))
    pairs = points.join(history, [*keys, NODE]).filter(inside).drop(low, high, NODE)
    return pairs if keep_slot else pairs.drop(SLOT, LEVELS)
