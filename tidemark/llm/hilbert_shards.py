"""Shards as runs of a Hilbert curve through several columns. DataFrame functions only.

Each dimension is quantised at equal-depth cut points of the whole table, the
cell is mapped to its index on the curve, rows are ordered by it and cut into
runs of equal count. Rows near in all dimensions then lie in the same files,
whose column ranges are narrow, so a filter on any dimension skips files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.session import new_scratch_path

BITS = 5
SHARDS = 8
# The parts of a monotonically increasing id: partition, row within it.
ROW_BITS = 33


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of integer cells below ``2 ** bits`` (Skilling's transform)."""
    n = len(cells)

    def literal_steps(pairs):
        return F.array(*[F.struct(F.lit(a).alias("q"), F.lit(b).alias("i")) for a, b in pairs])

    turns = [1 << b for b in range(bits - 1, 0, -1)]

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        own, first = F.element_at(x, i + 1), F.element_at(x, 1)
        is_set = own.bitwiseAND(q) != 0
        swap = F.when(is_set, F.lit(0)).otherwise(first.bitwiseXOR(own).bitwiseAND(q - 1))
        flip = F.when(is_set, q - 1).otherwise(swap)
        return F.transform(
            x,
            lambda v, k: v.bitwiseXOR(
                F.when(k == 0, flip).when(k == i, swap).otherwise(F.lit(0))
            ),
        )

    def gray(x: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(n)),
            lambda k: F.aggregate(F.slice(x, 1, k), F.lit(0), lambda a, v: a.bitwiseXOR(v)),
        )

    def mask(x: Column) -> Column:
        return F.aggregate(
            F.array(*map(F.lit, turns)) if turns else F.array().cast("array<int>"),
            F.lit(0),
            lambda t, q: t.bitwiseXOR(
                F.when(F.element_at(x, n).bitwiseAND(q) != 0, q - 1).otherwise(F.lit(0))
            ),
        )

    def interleave(x: Column, t: Column) -> Column:
        order = literal_steps((1 << b, i) for b in range(bits - 1, -1, -1) for i in range(n))
        return F.aggregate(
            order,
            F.lit(0).cast("bigint"),
            lambda a, s: a * 2
            + (F.element_at(x, s["i"] + 1).bitwiseXOR(t).bitwiseAND(s["q"]) != 0).cast("bigint"),
        )

    start = F.array(*[c.cast("int") for c in cells])
    turned = F.aggregate(literal_steps((q, i) for q in turns for i in range(n)), start, undo)
    return _let(turned, lambda x: _let(gray(x), lambda g: _let(mask(g), lambda t: interleave(g, t))))


def text_cuts(df: DataFrame, value: Column, bits: int = BITS) -> list[str]:
    """Equal-depth cut points of a text over the whole table, in the order of whole texts.

    Equal texts are counted before they move; the counts are stored in ranges of
    texts, and added up by range, then within each. Only the cut points, less
    than ``2 ** bits``, come to the driver.
    """
    counted = df.select(value.alias("value")).filter("value is not null").groupBy("value")
    counted = counted.agg(F.count(F.lit(1)).alias("n")).repartitionByRange("value")
    target = new_scratch_path(df.sparkSession, "texts")
    counted.withColumn("part", F.spark_partition_id()).write.parquet(target)
    held = df.sparkSession.read.parquet(target)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    parts = held.groupBy("part").agg(F.sum("n").alias("held"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"),
        F.sum("held").over(everything).alias("total"),
    )
    within = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = held.join(parts, "part").withColumn("upto", F.col("base") + F.sum("n").over(within))
    cells = 1 << bits
    crossed = F.expr(f"least({cells - 1}, upto * {cells} div total) > (upto - n) * {cells} div total")
    return sorted(r["value"] for r in upto.filter(crossed).select("value").collect())


def cut_points(df: DataFrame, values: list[Column], bits: int = BITS) -> list[list]:
    """Equal-depth cut points of each value over the whole table; of all numbers in one pass.

    Their number is fixed by ``bits``; they alone come to the driver.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    types = [f.dataType for f in df.select(*values).schema]
    texts = [isinstance(t, StringType) for t in types]
    numbers = [
        F.percentile_approx(v, shares, 1 << (bits + 6)).alias(f"d{i}")
        for i, v in enumerate(values)
        if not texts[i]
    ]
    row = df.agg(*numbers).first().asDict() if numbers else {}
    return [
        text_cuts(df, v, bits) if texts[i] else sorted(row[f"d{i}"] or [])
        for i, v in enumerate(values)
    ]


def cell(value: Column, cuts: list) -> Column:
    """The number of cut points below a value; 0 for null."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))
    return F.when(value.isNull(), 0).otherwise(below)


def hilbert_shards(
    df: DataFrame,
    *,
    dimensions: dict[str, Column],
    shards: int = SHARDS,
    bits: int = BITS,
    id_column: str = "doc_id",
    carry: tuple[Column, ...] = (),
) -> DataFrame:
    """Columns id, ``carry``, curve, shard, slot; shards hold counts at most one apart.

    Rows are ordered by the curve index, then by id (null first) and by
    ``carry``, so equal rows lie together and a hot cell is spread by id. Null
    dimensions are in the lowest cell. ``slot`` counts from 0 in each shard. An
    empty table gives no rows; repeated rows all keep a slot. Columns of ``df``
    that are not named are not read.

    One shuffle of the narrow rows by ranges. It is written to the scratch
    folder, since ranks need its partitions to be the same in both readings.
    """
    spark = df.sparkSession
    values = list(dimensions.values())
    cuts = cut_points(df, values, bits)
    curve = hilbert_index([cell(v, c) for v, c in zip(values, cuts)], bits)
    keyed = df.select(F.col(id_column), *carry, curve.alias("curve"))
    rest = [c for c in keyed.columns if c not in (id_column, "curve")]
    order = [F.col("curve"), F.col(id_column).asc_nulls_first(), *map(F.col, rest)]
    place = F.monotonically_increasing_id()
    target = new_scratch_path(spark, "curve")
    keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", place
    ).write.parquet(target)
    stored = spark.read.parquet(target).withColumn("part", F.shiftright("place", ROW_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    parts = (
        stored.groupBy("part")
        .agg(F.count(F.lit(1)).alias("held"))
        .select(
            "part",
            F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"),
            F.sum("held").over(everything).alias("total"),
        )
    )
    position = F.col("base") + F.col("place").bitwiseAND((1 << ROW_BITS) - 1)
    shard = F.expr(f"cast(((position + 1) * {shards} - 1) div total as int)")
    return (
        stored.join(parts, "part")
        .withColumn("position", position)
        .withColumn("shard", shard)
        .select(
            id_column,
            *rest,
            "curve",
            "shard",
            F.expr(f"position - (shard * total) div {shards}").alias("slot"),
        )
    )


def write_shards(df: DataFrame, target: str, *, dimensions: dict[str, Column], **options) -> str:
    """Write all columns of ``df`` into ``target``, a folder for each shard, sorted by slot.

    The columns added are called ``shard`` and ``slot``, with an underscore more
    for each that ``df`` already has of these names. Repeated rows are all
    written, null ids come first; an empty table gives an empty folder.
    """
    taken = {c.lower() for c in df.columns}
    names = []
    for name in ("shard", "slot"):
        while name in taken:
            name += "_"
        names.append(name)
    held = hilbert_shards(
        df, dimensions=dimensions, carry=(F.struct("*").alias("tm_row"),), **options
    )
    added = [F.col(c).alias(n) for c, n in zip(("shard", "slot"), names)]
    placed = held.select(*added, "tm_row.*").repartitionByRange(*names)
    placed.sortWithinPartitions(*names).write.partitionBy(names[0]).parquet(target)
    return target
