"""Small hand-made tables."""

from datetime import date

from tidemark.model import SPECS

OPEN = "9999-01-01"


def day(text):
    return None if text is None else date.fromisoformat(text)


def table(spark, name, *rows):
    schema = SPECS[name].schema
    dates = {i for i, f in enumerate(schema) if f.dataType.simpleString() == "date"}
    typed = [tuple(day(v) if i in dates else v for i, v in enumerate(row)) for row in rows]
    return spark.createDataFrame(typed, schema)


def employees(spark, *ids, **overrides):
    rows = [
        overrides.get(f"e{n}", (n, "1960-01-01", f"F{n}", f"L{n}", "M", "1990-01-01")) for n in ids
    ]
    return table(spark, "employees", *rows)


def departments(spark, *ids):
    return table(spark, "departments", *[(d, f"Dept {d}") for d in ids])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
