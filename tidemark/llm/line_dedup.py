"""Line deduplication by an exact set-similarity join.

The tokens of a line are its distinct words, ordered by rarity over the whole
corpus. Lines of one token set are one class, whose first line stays. Two
classes can only be similar if the prefixes of their orders share a token; they
are joined on it, under the length filter, the positional filter and a bound
from 64-bit parity maps of the sets, and what remains is verified by the exact
Jaccard similarity of the words. A line is removed if any earlier line matches.

Copies with small edits form groups in which all match all. Each class is
therefore first compared with the earliest that shares one of a few keys, pairs
of tokens next to each other in the prefix, chosen by their hash so that copies
choose alike. What this leaves of a shared key is compared with the nearest of a
few classes drawn for the key. Only classes these two leave are joined with all
others.
"""

from __future__ import annotations

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
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from tidemark.llm.common import restricted, ship, small
from tidemark.llm.components import stored
from tidemark.llm.shingles import blocks, mix, word_hashes

PERCENT = 80
COUNT_BITS = 17  # token counts are kept by this many bits of the hash
RANK_BITS = 12
FIRST_ROUND = 3  # keys of a line in the first comparison
LONG = 48  # tokens from which on a parity map has 192 bits instead of 64
DRAWS = 2  # hashes by which the least and the greatest of a key are drawn
MAPS = [f"m{i}" for i in range(3)]
MARKED_ROWS = 1_000_000  # of marks that are handed to all tasks; more are joined by a shuffle
NO_ID = -(1 << 63)  # stands for a null id, before all others


def _source(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    ship(df.sparkSession.sparkContext.applicationId)
    return df.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(text_column, F.lit("")).cast("binary").alias("text"),
    )


def token_ranks(source: DataFrame) -> np.ndarray:
    """A rank by count for each bucket of tokens, counted over all texts.

    Any order of tokens gives the same result; one by rarity makes it fast.
    Tasks hand over their counts, which Spark sums; the driver gets one number
    for each of the ``2 ** COUNT_BITS`` buckets.
    """
    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        texts = (t for b in batches for t in b.column(0).to_pylist())
        for block in blocks(texts, len):
            at = (word_hashes(block)[0] >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
            total += np.bincount(at, minlength=len(total))
        held = np.flatnonzero(total)
        columns = [pa.array(held.astype(np.int32)), pa.array(total[held])]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    counted = source.select("text").mapInArrow(run, schema)
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    most = (1 << RANK_BITS) - 1
    return np.minimum(most, np.log2(counts + 1) * 100).astype(np.uint16)


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of its rarest tokens a set must share one of; 0 where only equal sets match."""
    sizes = n - (percent * n + 99) // 100 + 1
    # A set of n matches another only if one of n + 1 tokens may be it and one more.
    return np.where(100 * n < percent * (n + 1), 0, sizes)


def line_sets(source: DataFrame, rank: np.ndarray, percent: int) -> DataFrame:
    """One row (id, line, n, d1, d2, m0 to m2, prefix) for each line with words.

    ``d1`` and ``d2`` identify the token set, ``prefix`` holds its rarest tokens
    as 32-bit hashes in order. Each token flips a bit of the parity map, of
    which a short line has the first part only.
    """
    schema = StructType(
        [
            StructField("id", LongType()),
            StructField("line", IntegerType()),
            StructField("n", IntegerType()),
            StructField("d1", LongType()),
            StructField("d2", LongType()),
            *[StructField(m, LongType()) for m in MAPS],
            StructField("prefix", ArrayType(IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, t in rows]
        hashes, at, _ = word_hashes(texts)
        line_ends = np.flatnonzero(np.frombuffer(b"\n".join(texts), np.uint8) == 10)
        line = np.searchsorted(line_ends, at)
        ranks = rank[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
        keys = (ranks << np.uint64(64 - RANK_BITS)) | (hashes & np.uint64((1 << 52) - 1))
        order = np.argsort(keys)
        small = line[order].astype(np.uint16 if len(line_ends) < 65536 else np.int64)
        order = order[np.argsort(small, kind="stable")]
        keys, hashes, line = keys[order], hashes[order], line[order]
        if len(keys):
            new = (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
            new = np.concatenate([[True], new])
            keys, hashes, line = keys[new], hashes[new], line[new]
        first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(keys) else []
        first = np.asarray(first, np.int64)
        held = line[first]
        n = np.diff(np.concatenate([first, [len(keys)]]))
        mixed = mix(keys)
        if len(first):
            whole = mix(hashes)
            d1 = np.add.reduceat(whole, first)
            d2 = np.add.reduceat(mix(whole + np.uint64(1)), first)
            bit = np.uint64(1) << (mixed & np.uint64(63))
            part = (mixed >> np.uint64(6)) % np.uint64(len(MAPS))
            part[np.repeat(n < LONG, n)] = 0
            maps = [
                np.bitwise_xor.reduceat(np.where(part == i, bit, np.uint64(0)), first)
                for i in range(len(MAPS))
            ]
        else:
            d1 = d2 = np.empty(0, np.uint64)
            maps = [d1] * len(MAPS)
        sizes = prefix_size(n, percent)
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        prefix = (mixed[np.repeat(first, sizes) + within] >> np.uint64(32)).astype(np.uint32)
        lines_of = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        starts = np.cumsum(lines_of) - lines_of
        owner = np.searchsorted(starts, held, "right") - 1
        ids = np.array([i for i, _ in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[owner]),
                pa.array((held - starts[owner]).astype(np.int32)),
                pa.array(n.astype(np.int32)),
                pa.array(d1.view(np.int64)),
                pa.array(d2.view(np.int64)),
                *[pa.array(m.view(np.int64)) for m in maps],
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.array(prefix.view(np.int32)),
                    type=arrow.field("prefix").type,
                ),
            ],
            schema=arrow,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for some in blocks(rows, lambda r: len(r[1])):
            yield block(some)

    return source.mapInArrow(run, schema)


def _needed(percent: int) -> Column:
    """The common tokens that a pair of sets of ``l_n`` and ``r_n`` tokens needs."""
    total = F.col("l_n") + F.col("r_n")
    return F.ceil(percent * total / (100 + percent))


def _distance() -> Column:
    """Bits in which the parity maps differ: the tokens that only one of the two has, or fewer."""
    both = [F.col(f"l_{m}").bitwiseXOR(F.col(f"r_{m}")) for m in MAPS]
    counted = [F.bit_count(b) for b in both]
    whole = both[0].bitwiseXOR(both[1]).bitwiseXOR(both[2])
    long = F.least("l_n", "r_n") >= LONG
    return F.when(long, sum(counted[1:], counted[0])).otherwise(F.bit_count(whole))


def _may_match(percent: int) -> Column:
    """Length filter and bound from the parity maps: different tokens flip different bits."""
    smaller, larger = F.least("l_n", "r_n"), F.greatest("l_n", "r_n")
    return (100 * smaller >= percent * larger) & (
        _distance() <= F.col("l_n") + F.col("r_n") - 2 * _needed(percent)
    )


EARLIER = "r_id < l_id or r_id = l_id and r_line < l_line"


def _named(df: DataFrame, side: str, *columns: str) -> DataFrame:
    return df.select("token", *[F.col(c).alias(f"{side}_{c}") for c in columns])


def _drawn(shared: DataFrame, done: DataFrame, own: tuple[str, ...], percent: int) -> DataFrame:
    """For each class of a shared key that is not done, the nearest earlier one of those drawn."""
    members = shared.select("token", *[F.col(f"l_{c}").alias(c) for c in own])
    draws = []
    for seed in range(DRAWS):
        drawn = F.struct(F.xxhash64("id", "line", F.lit(seed)).alias("h"), *own)
        draws += [F.min(drawn), F.max(drawn)]
    some = members.groupBy("token").agg(F.array_distinct(F.array(*draws)).alias("some"))
    some = some.select("token", F.explode("some").alias("f")).select("token", "f.*")
    open_ = shared.drop(*[f"r_{c}" for c in own])
    gone = done.select(F.col("id").alias("l_id"), F.col("line").alias("l_line"))
    open_ = open_.join(small(gone, MARKED_ROWS), ["l_id", "l_line"], "left_anti")
    met = open_.join(_named(some, "r", *own), "token")
    met = met.filter(F.expr(EARLIER) & _may_match(percent))
    nearest = F.min(F.struct(_distance().alias("apart"), "r_id", "r_line")).alias("r")
    return met.groupBy("l_id", "l_line").agg(nearest).select("l_id", "l_line", "r.r_id", "r.r_line")


POSTING = ["place", "id", "spot", "before", *MAPS]
CHUNK_ROWS = 200_000  # of postings read before their pairs are looked for
CHUNK_PAIRS = 500_000  # that are held at a time


def _postings(marked: DataFrame) -> DataFrame:
    """A row for each token of each prefix, by token and size of the set.

    ``place`` is the token and the size, ``spot`` the line, the token's place in
    the prefix and whether the class is done, ``before`` the token before it.
    """
    every = marked.select("id", "line", "n", "done", "prefix", *MAPS, F.posexplode("prefix").alias("at", "token"))

    def packed(high: str, low: Column) -> Column:
        return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(low.cast("long"))

    every = every.select(
        packed("token", F.col("n")).alias("place"),
        "id",
        packed("line", 2 * F.col("at") + F.coalesce("done", F.lit(0))).alias("spot"),
        F.coalesce(F.get("prefix", F.col("at") - 1), F.lit(0)).alias("before"),
        *MAPS,
    )
    token = F.shiftright("place", 32)
    return every.repartition(token).sortWithinPartitions("place").select(*POSTING)


def _common(total: np.ndarray, percent: int) -> np.ndarray:
    """The common tokens that a pair of sets of ``total`` tokens needs."""
    return -(-percent * total // (100 + percent))


def _pairs_of(rows: dict[str, np.ndarray], old: int, percent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Places (later, earlier) in the sorted ``rows`` of pairs that may match, one after ``old``.

    Of each pair one token is enough, the rarest shared: it is early in the
    smaller set (each, if equal in size), and it and those after it suffice in
    both, as two sets with ``c`` common tokens share one of the first
    ``n - c + 1`` of each. For a larger set that bounds the sizes of the smaller
    ones as the length filter does. Where the tokens before are equal too, the
    pair has met at those. Parity maps rule out most of the rest.
    """
    place, own, before = rows["place"], rows["id"], rows["before"]
    n = place & 0xFFFFFFFF
    line, at, done = rows["spot"] >> 32, (rows["spot"] & 0xFFFFFFFF) >> 1, (rows["spot"] & 1) > 0
    early = at <= n - _common(2 * n, percent)
    smaller = np.flatnonzero(early)
    larger = np.arange(old, len(place))
    token = place[larger] & ~0xFFFFFFFF
    first = np.searchsorted(place, token | -(-percent * n[larger] // 100))
    # At most so many tokens in both sets that what follows this one can be all they share.
    most = np.maximum((n[larger] - at[larger]) * (100 + percent) // percent - n[larger], 0)
    last = np.minimum(np.searchsorted(place, token | np.minimum(most, n[larger]), "right"), larger)
    first = np.searchsorted(smaller, first)
    count = np.maximum(np.searchsorted(smaller, last) - first, 0)
    held = count > 0
    larger, first, count = larger[held], first[held], count[held]
    ends = np.cumsum(count)
    start = 0
    while start < (ends[-1] if len(ends) else 0):
        # Pairs are numbered through, so a row of many may be cut anywhere.
        stop = min(start + CHUNK_PAIRS, int(ends[-1]))
        of = np.arange(np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1)
        low = np.maximum(ends[of] - count[of], start)
        size = np.minimum(ends[of], stop) - low
        b = np.repeat(larger[of], size)
        within = np.repeat(low - ends[of] + count[of] + first[of], size)
        within += np.arange(len(b)) - np.repeat(np.cumsum(size) - size, size)
        a = smaller[within]
        start = stop
        met = (before[a] != before[b]) | (at[a] == 0) | (at[b] == 0)
        met &= ~(done[a] & done[b]) & (early[b] | (n[a] != n[b]))
        a, b = a[met], b[met]
        after = (own[b] > own[a]) | (own[b] == own[a]) & (line[b] > line[a])
        late, soon = np.where(after, b, a), np.where(after, a, b)
        fits = ~done[late] & ((own[a] != own[b]) | (line[a] != line[b]))
        late, soon = late[fits], soon[fits]
        needed = _common(n[late] + n[soon], percent)
        apart = [rows[m][late] ^ rows[m][soon] for m in MAPS]
        counted = [np.bitwise_count(x).astype(np.int64) for x in apart]
        long = np.minimum(n[late], n[soon]) >= LONG
        whole = np.bitwise_count(apart[0] ^ apart[1] ^ apart[2])
        differ = np.where(long, sum(counted), whole)
        fits = differ <= n[late] + n[soon] - 2 * needed
        late, soon, needed = late[fits], soon[fits], needed[fits]
        fits = np.minimum(n[late] - at[late], n[soon] - at[soon]) >= needed
        yield late[fits], soon[fits]


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs (l_id, l_line, r_id, r_line) of sorted postings that may match, r before l, l not done.

    Rows are read in order of token and size, so a set meets the smaller ones of
    its token just before it. Of what was read only those are held that the next
    may match.
    """
    schema = StructType(
        [
            StructField("l_id", LongType()),
            StructField("l_line", IntegerType()),
            StructField("r_id", LongType()),
            StructField("r_line", IntegerType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def block(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(some)
            rows = {c: table[c].to_numpy() for c in POSTING}
            # Parity maps are bits, of which numpy counts those of unsigned numbers.
            rows |= {m: rows[m].view(np.uint64) for m in MAPS}
            old = len(held["place"]) if held else 0
            if old:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in POSTING}
            for late, soon in _pairs_of(rows, old, percent):
                line = (rows["spot"] >> 32).astype(np.int32)
                columns = [rows["id"][late], line[late], rows["id"][soon], line[soon]]
                if len(late):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)
            last = int(rows["place"][-1])
            least = (last & ~0xFFFFFFFF) | -(-percent * (last & 0xFFFFFFFF) // 100)
            kept = np.searchsorted(rows["place"], least)
            held = {c: rows[c][kept:].copy() for c in POSTING}

        some, size = [], 0
        for batch in batches:
            some.append(batch)
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield from block(some)
                some, size = [], 0
        if size:
            yield from block(some)

    return postings.mapInArrow(run, schema).distinct()


def matching(pairs: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (l_id, l_line, r_id, r_line) whose lines are similar, by their words."""
    ends = pairs.select(F.col("l_id").alias("id"), F.col("l_line").alias("line")).union(
        pairs.select("r_id", "r_line")
    )
    wanted = ends.groupBy("id").agg(F.collect_set("line").alias("wanted"))
    texts = restricted(source, stored(wanted, "wanted"), "id")
    schema = StructType(
        [
            StructField("id", LongType()),
            StructField("line", IntegerType()),
            StructField("words", BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ([], [], [])
            for own, text, lines in zip(*(c.to_pylist() for c in batch.columns)):
                all_lines = text.split(b"\n")
                for number in lines:
                    if number < len(all_lines):
                        words = sorted(set(all_lines[number].lower().split()))
                        for column, value in zip(found, (own, number, b" ".join(words))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(found, arrow)], schema=arrow
            )

    lines = stored(texts.select("id", "text", "wanted").mapInArrow(cut, schema).distinct(), "lines")
    left = lines.select(*[F.col(c).alias(f"l_{c}") for c in lines.columns])
    right = lines.select(*[F.col(c).alias(f"r_{c}") for c in lines.columns])
    held = pairs.join(left, ["l_id", "l_line"]).join(right, ["r_id", "r_line"])
    places = ["l_id", "l_line", "r_id", "r_line"]
    held = held.select(*places, "l_words", "r_words")
    out = StructType([*held.schema.fields[:4], StructField("similar", BooleanType())])
    out_arrow = to_arrow_schema(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                a, b = set(a.split()), set(b.split())
                common = len(a & b)
                similar.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(similar)], schema=out_arrow
            )

    return held.mapInArrow(compare, out).filter("similar").select(*places)


def removed_lines(
    df: DataFrame, *, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, line (from 0) of all lines of which an earlier line has the same or similar words.

    Lines end at line feeds, words at white space, A to Z count as lower case.
    Lines come in the order of ids, null first (shown as the smallest long), and
    of their number. Lines without words stay, as do null and empty texts. Rows
    of one id are one document: repeated rows lose the same lines. An empty
    table gives no rows. Texts of any length count whole; other columns are not
    read.
    """
    source = _source(df, id_column, text_column)
    lines = stored(line_sets(source, token_ranks(source), percent), "line_sets")
    payload = F.struct("id", "line", "n", *MAPS, "prefix")
    classes = lines.groupBy("d1", "d2").agg(F.min(payload).alias("first"))
    classes = stored(classes.select("d1", "d2", "first.*"), "classes")

    own = ("id", "line", "n", *MAPS)

    def key(i: Column) -> Column:
        return F.xxhash64(F.element_at("prefix", i), F.element_at("prefix", i + 1))

    keys = F.transform(F.sequence(F.lit(1), F.size("prefix") - 1), key)
    keys = F.when(F.size("prefix") > 1, F.slice(F.array_sort(keys), 1, FIRST_ROUND)).otherwise(
        F.transform("prefix", lambda token: F.xxhash64(token))
    )
    # One exchange by key feeds both the aggregate and the join.
    rare = classes.filter("size(prefix) > 0").select(*own, F.explode(keys).alias("token"))
    rare = rare.repartition("token")
    lowest = rare.groupBy("token").agg(F.min(F.struct(*own)).alias("f")).select("token", "f.*")
    shared = _named(rare, "l", *own).join(_named(lowest, "r", *own), "token")
    shared = stored(shared.filter(EARLIER), "shared")
    places = ["l_id", "l_line", "r_id", "r_line"]

    def marked_late(pairs: DataFrame) -> DataFrame:
        late = matching(pairs, source, percent)
        return late.select(F.col("l_id").alias("id"), F.col("l_line").alias("line")).distinct()

    near = stored(shared.filter(_may_match(percent)).select(*places).distinct(), "near")
    done = stored(marked_late(near), "done")
    drawn = stored(_drawn(shared, done, own, percent), "drawn")
    done = done.union(marked_late(drawn.join(near, places, "left_anti")))
    done = stored(done.withColumn("done", F.lit(1)), "done")
    near = near.union(drawn)
    marks = small(done, MARKED_ROWS)
    marked = classes.filter("size(prefix) > 0").join(marks, ["id", "line"], "left")
    rest = _candidates(_postings(marked), percent).join(near, places, "left_anti")
    found = matching(stored(rest, "rest"), source, percent)
    late = done.select("id", "line").union(
        found.select(F.col("l_id").alias("id"), F.col("l_line").alias("line"))
    )
    late = late.distinct().withColumn("late", F.lit(True))
    firsts = classes.join(late, ["id", "line"], "left").select(
        "d1", "d2", F.col("id").alias("first_id"), F.col("line").alias("first_line"), "late"
    )
    return (
        lines.select("id", "line", "d1", "d2")
        .join(firsts, ["d1", "d2"])
        .filter("late or id <> first_id or line <> first_line")
        .select(F.col("id").alias(id_column), "line")
        .distinct()
    )


def line_counts(
    df: DataFrame, *, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, n_lines, n_removed, removed (line numbers in order) of each document."""
    gone = removed_lines(df, percent=percent, id_column=id_column, text_column=text_column)
    gone = gone.groupBy(F.col(id_column).alias("tm_id")).agg(
        F.array_sort(F.collect_list("line")).alias("removed")
    )
    size = F.size(F.split(F.coalesce(text_column, F.lit("")), "\n")).cast("long")
    rows = df.select(
        F.col(id_column),
        size.alias("n_lines"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("tm_id"),
    )
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.join(gone, "tm_id", "left").select(
        id_column,
        "n_lines",
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
    )


def without_lines(
    df: DataFrame, *, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``df`` with the removed lines taken out of its texts; all rows and columns stay.

    Columns of any name may be there. A null text stays null.
    """
    gone = removed_lines(df, percent=percent, id_column=id_column, text_column=text_column)
    gone = gone.groupBy(F.col(id_column).alias("tm_id")).agg(F.collect_set("line").alias("tm_gone"))
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("tm_row"))
    row = row.withColumn("tm_id", F.coalesce(F.col(f"tm_row.{id_column}").cast("long"), F.lit(NO_ID)))
    text = F.col(f"tm_row.{text_column}")
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("tm_gone", i))
    cut = F.when(F.col("tm_gone").isNull(), text).otherwise(F.array_join(left, "\n"))
    joined = row.join(gone, "tm_id", "left")
    return joined.select(
        *[
            (cut if c == text_column else F.col(f"tm_row.`{c}`")).alias(c)
            for c in df.columns
        ]
    )
