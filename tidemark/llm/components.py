"""Connected components of an edge table, by rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    target = new_scratch_path(df.sparkSession, name)
    df.write.parquet(target)
    return df.sparkSession.read.parquet(target)


FEW = 100_000  # edges up to which one task takes a table, whose rounds then need no shuffle


def _pairs(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each of the pairs of columns of each row."""
    both = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]
    return edges.select(F.explode(F.array(*both)).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    both = _pairs(edges, ("u", "v"), ("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return _pairs(down.join(least, "u"), ("v", "m"), ("u", "m")).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns id, component (its smallest id) of all ids in the edges ``(u, v)``.

    Large-star and small-star rounds: neighbours are linked to the smallest id
    known nearby until each id but the smallest has one edge, to it. Tables are
    joined and combined before the shuffle; nothing of a component is gathered,
    unless there are no more than ``FEW`` edges altogether.
    Loops (u = v), repeated edges and nulls are left out; without edges there
    are no rows.
    """
    edges = edges.select("u", "v").filter("u <> v")
    few = edges.limit(FEW + 1).count() <= FEW

    def near(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if few else df

    now = stored(near(edges).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"),
        ).first()
        if not mark["n"] or mark == before:
            break
        before = mark
        now = stored(_small_star(_large_star(near(now))), "edges")
    return _pairs(near(now), ("u", "v"), ("v", "v")).distinct().toDF("id", "component")
