"""Latest rows and change detection against brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import day, rows
from tidemark.functions import as_day, previous_month
from tidemark.operators import heavy_keys, latest_by_key, value_changes

START, END = date(2000, 1, 1), date(2000, 6, 30)


def brute_changes(history, start=START, end=END):
    out = []
    by_key = {}
    for k, v, at in history:
        by_key.setdefault(k, []).append((at, v))
    for k, items in by_key.items():
        if k is None:
            continue
        items.sort(key=lambda x: (x[0] is not None, x[0] or START, x[1] is not None, x[1] or ""))
        for (_, old), (at, new) in zip(items, items[1:]):
            if at and start <= at <= end and None not in (old, new) and old != new:
                out.append((k, at, old, new, "Change"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["none", "hot", "all"])
@pytest.mark.parametrize("seed", range(2))
def test_value_changes_equals_brute_force(spark, seed, split):
    pick = random.Random(seed)
    history = []
    for _ in range(600):
        key = 0 if pick.random() < 0.4 else pick.randrange(25)
        at = START + timedelta(days=pick.randrange(-300, 250, 3))
        history.append(
            (
                None if pick.random() < 0.02 else key,
                None if pick.random() < 0.05 else pick.choice("abcd"),
                None if pick.random() < 0.03 else at,
            )
        )
    df = spark.createDataFrame(history, "k int, v string, from_date date")
    heavy = heavy_keys([df], ["k"], {"none": 10**6, "hot": 100, "all": 0}[split])
    if heavy is None:
        assert split == "none"
        heavy = False
    else:
        assert heavy.count() == {"hot": 1, "all": 25}[split]
    got = rows(value_changes(df, "k", "v", START, END, "Change", heavy=heavy))
    # The order of equal days is fixed, so repeated rows change nothing.
    assert got == brute_changes(history)
    assert got


def test_change_rules(spark):
    df = spark.createDataFrame(
        [
            (1, "d1", day("1999-05-01")),  # before the period
            (1, "d1", day("2000-01-15")),  # repeated: no change
            (1, "d2", day("2000-06-30")),  # last day counts
            (2, "d1", day("2000-02-01")),  # first record of an entity: no change
            (3, "d1", day("1999-01-01")),
            (3, "d2", day("2000-01-01")),  # first day counts
            (3, "d3", day("2000-07-01")),  # after the period
        ],
        "k int, v string, from_date date",
    )
    assert rows(value_changes(df, "k", "v", "2000-01-01", "2000-06-30", "x")) == [
        (1, day("2000-06-30"), "d1", "d2", "x"),
        (3, day("2000-01-01"), "d1", "d2", "x"),
    ]


@pytest.mark.parametrize("bad", [None, "2000-13-01", "yesterday", 20000101])
def test_bad_period_is_an_error(spark, bad):
    with pytest.raises(ValueError):
        as_day(bad)


def test_previous_month(spark):
    days = ["2000-05-01", "2000-03-31", "2000-01-15", "2001-03-01"]
    got = [spark.range(1).select(*previous_month(d)).first() for d in days]
    assert [tuple(map(str, r)) for r in got] == [
        ("2000-04-01", "2000-04-30"),
        ("2000-02-01", "2000-02-29"),
        ("1999-12-01", "1999-12-31"),
        ("2001-02-01", "2001-02-28"),
    ]
    column = spark.createDataFrame([(day("2000-05-09"),)], "d date")
    assert str(column.select(previous_month(F.col("d"))[0]).first()[0]) == "2000-04-01"


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [
            (1, "a", day("2000-01-01")),
            (1, "b", day("2001-01-01")),
            (1, "c", day("2001-01-01")),
            (2, "x", day("1999-01-01")),
            (3, "e", day("1999-01-01")),
            (3, "f", day("2000-01-01")),
            (3, "e", day("2001-01-01")),
        ],
        "k int, v string, from_date date",
    )
    latest = latest_by_key(df, "k", tie=("v",))
    assert [r[:2] for r in rows(latest)] == [(1, "c"), (2, "x"), (3, "e")]
    equal = latest_by_key(df, "k", tie=("v",), keep_equal=("v",))
    assert [r[:2] for r in rows(equal)] == [(1, "c"), (2, "x"), (3, "e"), (3, "e")]
