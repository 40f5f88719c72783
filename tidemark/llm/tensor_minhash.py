"""Near-duplicate documents by MinHash with tensored banding, every link verified.

Two small collections of minhash groups are computed. The key of a table joins
one group of the first with one of the second, so ``a * b`` tables of five rows
need only ``a + b`` groups of two or three minhashes. Documents that meet in a table are
candidates; a link needs the exact Jaccard similarity of the full shingle sets.

Documents of one shingle set are one class from the start. Of the classes that
meet in a table each is first compared with the one of the smallest id, then,
if the table still holds several components, with one drawn for the table. What
this leaves in different components is compared with every class of another
component in the table, so no link is lost and copies do not become pairs. Sizes
and parity maps rule out most pairs that cannot be similar before that.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StructField,
    StructType,
)

from tidemark.llm.common import restricted, ship, small
from tidemark.llm.components import components, stored
from tidemark.llm.shingles import blocks, mix, shingle_sets

GROUPS = (2, 3)  # minhashes of a group of each collection; a key has their sum
MAP_BITS = 512  # of the parity map of a set, in which each shingle flips a bit
PARTS = [f"p{i}" for i in range(MAP_BITS // 64)]
SETS_ROWS = 100_000  # of sizes and parity maps that are handed to all tasks; more are shuffled
MISSED = 1e-4  # most that a pair at the threshold may be missed, all tables together


def groups_for(share: float, missed: float = MISSED) -> tuple[int, ...]:
    """Groups of each collection so that a pair at ``share`` misses all tables rarely enough."""
    each = math.log(missed / len(GROUPS))
    return tuple(math.ceil(each / math.log(1 - share**size)) for size in GROUPS)


def table_keys(values: np.ndarray, ends: np.ndarray, groups: tuple[int, ...]) -> np.ndarray:
    """For each set (none empty), one key for each pair of groups of the two collections."""
    starts = np.concatenate([[0], ends[:-1]])
    random = np.random.default_rng(7)
    halves = []
    for size, count in zip(GROUPS, groups):
        seeds = random.integers(0, 1 << 63, (2, count, size), dtype=np.uint64)
        columns = []
        for g in range(count):
            key = np.full(len(ends), g + 1, np.uint64)
            for r in range(size):
                turn, odd = seeds[0, g, r], seeds[1, g, r] * np.uint64(2) + np.uint64(1)
                least = np.minimum.reduceat((values ^ turn) * odd, starts)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
            columns.append(key)
        halves.append(np.stack(columns, axis=1))
    place = np.arange(math.prod(groups), dtype=np.uint64).reshape(1, *groups)
    left, right = halves[0][:, :, None], halves[1][:, None, :]
    return mix(mix(left + place) + right).reshape(len(ends), math.prod(groups))


def parity_maps(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set, ``MAP_BITS`` bits as 64-bit numbers.

    Two maps differ in at most as many bits as the sets differ in shingles.
    """
    owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    at = (mix(values) & np.uint64(MAP_BITS - 1)).astype(np.int64)
    flips = np.bincount(owner * MAP_BITS + at, minlength=len(ends) * MAP_BITS) & 1
    packed = np.packbits(flips.astype(bool).reshape(-1, MAP_BITS), axis=1)
    return packed.view(np.int64).reshape(len(ends), MAP_BITS // 64)


def signatures(
    df: DataFrame,
    *,
    shingle: int,
    groups: tuple[int, ...],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, n (size of the set), digest (of the set), keys, parity map; no keys if empty."""
    ship(df.sparkSession.sparkContext.applicationId)
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    schema = StructType(
        [
            source.schema["id"],
            StructField("n", LongType()),
            StructField("digest", BinaryType()),
            StructField("keys", ArrayType(LongType())),
            *[StructField(p, LongType()) for p in PARTS],
        ]
    )
    arrow = to_arrow_schema(schema)
    tables = math.prod(groups)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        values, ends = shingle_sets([t or b"" for _, t in rows], shingle)
        starts = np.concatenate([[0], ends[:-1]])
        sizes = ends - starts
        held = sizes > 0
        keys = np.empty((0, tables), np.uint64)
        if held.any():
            keys = table_keys(values, ends[held], groups)
        digests = [
            hashlib.blake2b(values[s:e], digest_size=16).digest() for s, e in zip(starts, ends)
        ]
        offsets = np.concatenate([[0], np.cumsum(held * tables)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], arrow.field("id").type),
                pa.array(sizes),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array(offsets),
                    pa.array(keys.reshape(-1).view(np.int64)),
                    type=arrow.field("keys").type,
                ),
                *[pa.array(np.ascontiguousarray(m)) for m in parity_maps(values, ends).T],
            ],
            schema=arrow,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for some in blocks(rows, lambda r: len(r[1] or b"")):
            yield block(some)

    return source.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, *, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets have ``100 * common >= percent * united``.

    ``texts`` has the text (id, text) of each id of a pair; of several texts any may link it,
    and each that does gives a row.
    """
    held = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("left")), "u").join(
        texts.select(F.col("id").alias("v"), F.col("text").alias("right")), "v"
    )
    held = held.select("u", "v", "left", "right")
    schema = StructType([held.schema["u"], held.schema["v"], StructField("linked", BooleanType())])
    arrow = to_arrow_schema(schema)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        for _, _, left, right in rows:
            numbers.setdefault(left, len(numbers))
            numbers.setdefault(right, len(numbers))
        values, ends = shingle_sets(list(numbers), shingle)
        starts = np.concatenate([[0], ends[:-1]])
        linked = []
        for _, _, left, right in rows:
            a, b = numbers[left], numbers[right]
            a, b = values[starts[a] : ends[a]], values[starts[b] : ends[b]]
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * common >= percent * (len(a) + len(b) - common))
        columns = [[r[0] for r in rows], [r[1] for r in rows], linked]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for some in blocks(rows, lambda r: len(r[2]) + len(r[3])):
            yield block(some)

    return held.mapInArrow(run, schema).filter("linked").select("u", "v")


def _possible(percent: int) -> Column:
    """Whether sizes and parity maps (``_l`` and ``_r``) allow the similarity."""
    n_l, n_r = F.col("n_l"), F.col("n_r")
    needed = F.ceil(percent * (n_l + n_r) / (100 + percent))
    apart = [F.bit_count(F.col(f"{p}_l").bitwiseXOR(F.col(f"{p}_r"))) for p in PARTS]
    return (100 * F.least(n_l, n_r) >= percent * F.greatest(n_l, n_r)) & (
        sum(apart[1:], apart[0]) <= n_l + n_r - 2 * needed
    )


def _apart(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows (key, id, component, main) of the tables that hold several components, stored.

    ``main`` is the component with most ids in the table.
    """
    labelled = shared.join(joined, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    labelled = stored(labelled, "labelled")
    held = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = held.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"), F.max_by("component", "n").alias("main")
    )
    mixed = mixed.filter("components > 1").select("key", "main")
    return stored(labelled.join(mixed, "key"), "apart")


def near_duplicates(
    df: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    missed: float = MISSED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, n_shingles, component_id, kept of each document.

    ``component_id`` is the smallest id linked to the document, directly or over
    others, itself included; ``kept`` marks that document. Null and empty texts,
    and rows without id, are linked with nothing; a row without id has no
    component and is kept. Rows of one id are one document in all links.
    Repeated rows give a row each. Texts of any length count whole. Other
    columns are not read.

    A pair at the threshold is missed by all tables with probability ``missed``
    at most, less the nearer the texts; what is compared is exact.
    """
    groups = groups_for(percent / 100, missed)
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    signed = stored(signatures(source, shingle=shingle, groups=groups, id_column="id"), "signed")
    linkable = signed.filter("n > 0 and id is not null")
    own = F.min_by(F.struct("n", "keys", *PARTS), "id").alias("own")
    heads = linkable.groupBy("digest").agg(F.min("id").alias("id"), own)
    heads = stored(heads.select("digest", "id", "own.*"), "heads")
    # One exchange by key feeds both the aggregate and the join.
    in_tables = heads.select("id", F.explode("keys").alias("key")).repartition("key")
    met = in_tables.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    met = met.filter("low < high").select("key", "low")
    shared = stored(in_tables.join(met, "key"), "shared")
    sets = small(heads.select("id", "n", *PARTS), SETS_ROWS)
    possible = _possible(percent)

    def named(frame: DataFrame, side: str, *whole: str) -> DataFrame:
        return frame.select(*whole, *[F.col(c).alias(f"{c}_{side}") for c in frame.columns if c not in whole])

    left, right = named(sets, "l"), named(sets, "r")
    stars = shared.filter("id <> low").select(F.col("low").alias("id_l"), F.col("id").alias("id_r"))
    stars = stars.distinct().join(left, "id_l").join(right, "id_r").filter(possible)
    done = stored(stars.select(F.col("id_l").alias("u"), F.col("id_r").alias("v")).distinct(), "pairs")
    in_pairs = stored(shared.select("id").distinct(), "in_pairs")
    texts = restricted(source.filter("id is not null"), in_pairs, "id").select(
        "id", F.col("text").cast("binary").alias("text")
    )
    texts = stored(texts.distinct(), "texts")
    links = stored(verified(done, texts, shingle=shingle, percent=percent), "links")
    joined = stored(components(links), "components")
    apart = _apart(shared.select("key", "id"), joined)
    for exhaustive in (False, True):
        if not apart.limit(1).count():
            break
        members = apart.join(sets, "id")
        if exhaustive:  # one of a pair is not of the table's main component
            others = members.drop("main")
            members = members.filter("component <> main")
        else:
            columns = [c for c in members.columns if c not in ("key", "main")]
            drawn = F.min(F.struct(F.xxhash64("key", "id"), *columns)).alias("d")
            others = members.groupBy("key").agg(drawn).select("key", *[f"d.{c}" for c in columns])
        met = named(members.drop("main"), "l", "key").join(named(others, "r", "key"), "key")
        met = met.filter((F.col("component_l") != F.col("component_r")) & possible)
        u, v = F.least("id_l", "id_r").alias("u"), F.greatest("id_l", "id_r").alias("v")
        pairs = stored(met.select(u, v).distinct().join(done, ["u", "v"], "left_anti"), "pairs")
        more = stored(verified(pairs, texts, shingle=shingle, percent=percent), "links")
        if more.limit(1).count():
            links = links.union(more)
            joined = stored(components(links), "components")
            if not exhaustive:
                apart = _apart(apart.select("key", "id"), joined)
        done = done.union(pairs)
    component = F.coalesce("component", "rep", "id")
    return (
        signed.select("id", "n", "digest")
        .join(heads.select("digest", F.col("id").alias("rep")), "digest", "left")
        .withColumn("rep", F.when(F.col("n") > 0, F.col("rep")))
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), component).alias("component_id"),
            (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
        )
    )
