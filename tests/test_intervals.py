"""Interval joins against brute force, whole and with heavy keys split."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import OPEN, day, rows, table
from tidemark.model import AS_OF, OPEN_END
from tidemark.operators import (
    close_open_intervals,
    closed_rows,
    current_rows,
    heavy_keys,
    heavy_slots,
    overlap_join,
    point_in_interval_join,
)
from tidemark.operators import intervals, skew
from tidemark.operators.skew import LEVELS, ancestors, cover, slot_of

DAY_ZERO = date(1985, 1, 1)


def random_history(seed, n, keys, extra):
    """Histories with hot key 0, inverted, open, null and future intervals."""
    pick = random.Random(seed)
    made = []
    for i in range(n):
        key = 0 if pick.random() < 0.4 else pick.randrange(keys)
        start = DAY_ZERO + timedelta(days=pick.randrange(7500))
        end = start + timedelta(days=pick.choice([0, 1, 30, 365, 400, 3000, -50]))
        if pick.random() < 0.15:
            end = OPEN_END
        if pick.random() < 0.03:
            end = None
        if pick.random() < 0.03:
            start = None
        made.append((key, extra + i, start, end))
    return made


def frame(spark, made, value):
    return spark.createDataFrame(made, f"k int, {value} int, from_date date, to_date date")


def brute_overlap(left, right, strict):
    out = []
    for k, a, ls, le in left:
        for j, b, rs, re in right:
            if k != j or None in (ls, le, rs, re):
                continue
            if (ls < re and le > rs) if strict else (ls <= re and le >= rs):
                start, end = max(ls, rs), min(le, re)
                out.append((k, a, b, start, end, (end - start).days))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("split", ["none", "some", "all"])
def test_overlap_join_equals_brute_force(spark, strict, split):
    left, right = random_history(1, 300, 12, 1000), random_history(2, 150, 12, 5000)
    l, r = frame(spark, left, "a"), frame(spark, right, "b")
    heavy = {
        "none": False,
        "some": heavy_slots([r], ["k"], min_rows=40),
        "all": heavy_slots([r], ["k"], min_rows=0),
    }[split]
    if heavy:
        assert heavy.count() == {"some": 1, "all": r.select("k").distinct().dropna().count()}[split]
    pairs = overlap_join(l, r, "k", strict=strict, heavy=heavy)
    got = rows(pairs.select("k", "a", "b", "overlap_start", "overlap_end", "overlap_days"))
    assert got == brute_overlap(left, right, strict)
    assert got


def test_overlap_join_on_two_columns(spark):
    left, right = random_history(8, 200, 6, 1000), random_history(9, 100, 6, 5000)
    l = frame(spark, left, "a").withColumn("j", F.col("a") % 2)
    r = frame(spark, right, "b").withColumn("j", F.col("b") % 2)
    for heavy in (False, heavy_slots([r], ["k", "j"], min_rows=3)):
        got = rows(
            overlap_join(l, r, ["k", "j"], heavy=heavy).select(
                "k", "a", "b", "overlap_start", "overlap_end", "overlap_days"
            )
        )
        want = [p for p in brute_overlap(left, right, True) if p[1] % 2 == p[2] % 2]
        assert got == want and got


@pytest.mark.parametrize("split", [False, True])
def test_point_in_interval_join_equals_brute_force(spark, split):
    points, history = random_history(3, 300, 10, 1000), random_history(4, 150, 10, 5000)
    p = frame(spark, points, "a").select("k", "a", F.col("from_date").alias("at"))
    h = frame(spark, history, "b")
    heavy = heavy_slots([h], ["k"], min_rows=2) if split else False
    got = rows(point_in_interval_join(p, h, "k", "at", heavy=heavy).select("k", "a", "b"))
    want = sorted(
        (
            (k, a, b)
            for k, a, at, _ in points
            for j, b, s, e in history
            if k == j and None not in (at, s, e) and s <= at <= e
        ),
        key=repr,
    )
    assert got == want and got


def test_chain_of_point_joins_shares_slots(spark):
    points, h1, h2 = (random_history(s, 80, 4, s * 1000) for s in (5, 6, 7))
    p = frame(spark, points, "a").select("k", "a", F.col("from_date").alias("at"))
    results = []
    for min_rows in (0, 10**6):
        heavy = heavy_slots([frame(spark, h1, "b")], ["k"], min_rows=min_rows)
        heavy = False if heavy is None else heavy
        one = point_in_interval_join(
            p, frame(spark, h1, "b"), "k", "at", heavy=heavy, keep_slot=True
        )
        two = point_in_interval_join(one, frame(spark, h2, "c"), "k", "at", heavy=heavy)
        results.append(rows(two.select("k", "a", "b", "c")))
    assert results[0] == results[1] and results[0]


def pair_counts(spark, a, b):
    """Number of pairs under the strict, the inclusive and the point rule."""
    l = spark.createDataFrame([(1, *map(day, a))], "k int, from_date date, to_date date")
    r = spark.createDataFrame([(1, *map(day, b))], "k int, from_date date, to_date date")
    p = l.select("k", F.col("from_date").alias("at"))
    return (
        overlap_join(l, r, "k", heavy=False).count(),
        overlap_join(l, r, "k", strict=False, heavy=False).count(),
        point_in_interval_join(p, r, "k", "at", heavy=False).count(),
    )


@pytest.mark.parametrize(
    "a, b, counts",
    [
        (("2000-06-01", "2000-07-01"), ("2000-01-01", "2000-06-01"), (0, 1, 1)),
        (("2000-06-01", "2000-06-01"), ("2000-01-01", "2001-01-01"), (1, 1, 1)),
        (("2000-06-01", "2000-06-01"), ("2000-06-01", "2000-07-01"), (0, 1, 1)),
        (("2000-06-01", None), ("2000-01-01", "2001-01-01"), (0, 0, 1)),
        (("2000-06-01", "2000-07-01"), ("2000-08-01", "2000-09-01"), (0, 0, 0)),
    ],
)
def test_boundary_rules(spark, a, b, counts):
    assert pair_counts(spark, a, b) == counts


def test_key_types_must_agree(spark):
    l = spark.createDataFrame([], "k int, from_date date, to_date date")
    r = spark.createDataFrame([], "k bigint, from_date date, to_date date")
    with pytest.raises(ValueError, match="key k"):
        overlap_join(l, r, "k")


def test_heavy_keys_finds_the_hot_one_only(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in heavy_keys([df], ["k"]).collect()] == [7]
    assert heavy_keys([df], ["k"], min_rows=10_000) is None


def test_any_number_of_heavy_keys_is_split(spark):
    df = spark.range(30_000).select((F.col("id") % 10_000).alias("k"), F.lit(1).alias("v"))
    assert heavy_keys([df], ["k"], min_rows=2).count() == 10_000


@pytest.mark.parametrize("first_year, years", [(1700, 30), (1985, 18), (2010, 14), (2023, 1)])
def test_slots_hold_few_rows_in_any_years(spark, first_year, years):
    start = date(first_year, 1, 1)
    days = spark.range(2_000).select(
        F.lit(1).alias("k"),
        F.date_add(F.lit(start), (F.col("id") * (365 * years) / 2_000).cast("int")).alias("from_date"),
    )
    slots = days.join(heavy_slots([days], ["k"], min_rows=50), "k")
    counts = slots.groupBy(slot_of(F.col("from_date")).alias("slot")).count().collect()
    assert len(counts) >= 30 and max(r["count"] for r in counts) <= 50 + 2_000 // 365 + 1
    assert min(r["slot"] for r in counts) == 1


def test_hot_key_is_never_compared_with_all(spark):
    """Both sides of a key in one year: the join looks at a slot's rows only."""
    left = random_history(31, 400, 1, 1000)
    right = random_history(32, 400, 1, 5000)
    l, r = frame(spark, left, "a"), frame(spark, right, "b")
    heavy = heavy_slots([r], ["k"], min_rows=10)
    pairs = overlap_join(l, r, "k", heavy=heavy)
    got = rows(pairs.select("k", "a", "b", "overlap_start", "overlap_end", "overlap_days"))
    assert got == brute_overlap(left, right, True) and got


@pytest.mark.parametrize("slots", [1, 2, 3, 7, 8, 21])
def test_each_slot_is_covered_once(spark, slots):
    levels = F.lit((slots).bit_length() - 1).alias(LEVELS)
    spans = spark.range(slots).withColumnRenamed("id", "a").crossJoin(
        spark.range(slots).withColumnRenamed("id", "b")
    )
    spans = spans.select(F.col("a").cast("int"), F.col("b").cast("int"), levels)
    covers = spans.select("a", "b", cover(F.col("a"), F.col("b"), 1).alias("nodes")).collect()
    above = {
        r.a: set(r.nodes)
        for r in spans.filter("b = 0").select("a", ancestors(F.col("a"), 1).alias("nodes")).collect()
    }
    for r in covers:
        assert len(r.nodes) <= 2 * slots.bit_length() and 0 not in r.nodes
        for slot in range(slots):
            assert len(set(r.nodes) & above[slot]) == (r.a <= slot <= r.b)


def open_ended(spark, n):
    starts = F.date_add(F.lit(DAY_ZERO), (F.col("id") * 9000 / n).cast("int"))
    return spark.range(n).select(
        F.lit(1).alias("k"), "id", starts.alias("from_date"), F.lit(OPEN_END).alias("to_date")
    )


def test_long_intervals_of_a_hot_key_are_repeated_little(spark):
    """Rows after the split grow as n log n, not with the square."""
    counts = []
    for n in (20_000, 100_000):
        history = open_ended(spark, n)
        heavy = heavy_slots([history], ["k"])
        spanned = lambda: intervals._spanned("from_date", "to_date", 1)
        counts.append(intervals._placed(history, ["k"], heavy, spanned).count())
    assert counts[1] < 600_000 and counts[1] < 9 * counts[0]


def test_points_in_long_intervals_of_a_hot_key(spark):
    history = open_ended(spark, 20_000)
    points = history.filter("id % 400 = 0").select("k", F.col("from_date").alias("at"))
    heavy = heavy_slots([history], ["k"])
    found = [
        point_in_interval_join(points, history, "k", "at", heavy=h).groupBy("at").count().collect()
        for h in (heavy, False)
    ]
    assert sorted(map(repr, found[0])) == sorted(map(repr, found[1])) and len(found[0]) == 50


def test_keys_with_few_pairs_are_not_split(spark, monkeypatch):
    history = open_ended(spark, 3_000)
    few = history.limit(10)
    assert heavy_slots([history], ["k"], against=few) is None
    monkeypatch.setattr(skew, "HEAVY_PAIRS", 29_999)
    assert heavy_slots([history], ["k"], against=few).count() == 1
    assert heavy_slots([history], ["k"], against=few.filter("false")) is None


def test_open_and_closed_rows(spark):
    df = table(
        spark,
        "dept_emp",
        (1, "d1", "1990-01-01", "1995-01-01"),
        (1, "d2", "1995-01-01", OPEN),
        (2, "d1", "1995-01-01", None),
    )
    assert [r.dept_no for r in current_rows(df).collect()] == ["d2"]
    assert [r.emp_no for r in closed_rows(df).collect()] == [1]
    ends = [r.to_date for r in close_open_intervals(df).collect()]
    assert ends == [day("1995-01-01"), AS_OF, None]
