"""All reports with a third of the orders on one customer and heavy keys split."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.operators import history, intervals
from tidemark.operators.skew import heavy_keys, heavy_slots
from tidemark.plans import reports

SOURCE = "/root/testdata/sf0.01"
NAMES = [
    "annual_salary_by_department",
    "career_progression",
    "department_turnover",
    "employee_changes",
    "employee_master",
    "gender_ratio",
    "interval_overlap_inclusive",
    "interval_overlap_strict",
    "job_hoppers",
    "latest_by_key",
    "manager_impact",
    "salary_trends",
    "senior_employees",
    "value_changes",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    duck = duckdb.connect()
    duck.execute(
        f"""copy (select * replace (
              case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey,
              case when o_orderkey % 2 = 0 then '1-URGENT' else o_orderpriority end as o_orderpriority)
            from '{SOURCE}/orders.parquet') to '{folder}/orders.parquet'"""
    )
    duck.execute(f"copy (from '{SOURCE}/customer.parquet') to '{folder}/customer.parquet'")
    for table in ("orders", "customer"):
        duck.execute(f"create view {table} as from '{folder}/{table}.parquet'")
    return folder, duck


@pytest.fixture
def easily_heavy(monkeypatch):
    """Keys count as heavy from four rows on; returns what was found."""
    found = []

    def keys_of(frames, keys, min_rows=None):
        heavy = heavy_keys(frames, keys, 4)
        found.append(heavy)
        return heavy

    def slots_of(frames, keys, start="from_date", min_rows=None, against=None):
        heavy = heavy_slots(frames, keys, start, 4)
        found.append(heavy)
        return heavy

    for module in (history, reports):
        monkeypatch.setattr(module, "heavy_keys", keys_of)
    for module in (intervals, reports):
        monkeypatch.setattr(module, "heavy_slots", slots_of)
    return found


@pytest.mark.parametrize("broadcast", ["10m", "2k"])
@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, skewed, easily_heavy, name, broadcast):
    folder, duck = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = entry.queries()[name](spark, folder)
        columns = sorted(df.columns)
        got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    picked = duck.sql(entry.oracle_sql()[name]).project(", ".join(f'"{c}"' for c in columns))
    assert got == sorted(map(repr, picked.fetchall()))
    splits = {"annual_salary_by_department", "salary_trends", "employee_changes", "value_changes"}
    if name in splits or name.startswith("interval") or name == "manager_impact":
        assert any(h is not None for h in easily_heavy)
