"""Similarity digests of improbable features, kept in chained Bloom filters.

Every window of 64 bytes has an entropy. How rare its level is among all
windows of the corpus gives its rank; in each run of 64 windows the leftmost
of the rarest is counted, and windows counted often enough are features. Each
feature sets five bits of the newest Bloom filter of the document's chain, and
a full filter starts the next. Two chains are as near as their filters'
common bits, less what chance gives, are to the most that could be common.

Short texts have windows of 16 and 8 bytes besides, ranked among those of all
short texts. The classes overlap, so that texts of about one length have a
kind of feature in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.common import ship, turn

WINDOW = 64  # bytes of a feature
RUN = 64  # windows among which the rarest is counted
COUNTED = 16  # times a window has to be the rarest
LEVELS = 1000  # of entropy
WEAK, STRONG = 100, 990  # levels outside are no features: runs of few bytes, or noise
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
SHORT = 512  # windows; a text with fewer is searched in shorter runs
SHORT_RUN, SHORT_COUNTED = 16, 4
# Bytes of the further windows of short texts, below how many bytes of text, and their run;
# each that is the rarest once is a feature, so texts that share window + run - 1 bytes share one.
FURTHER = ((16, 512, 8), (8, 64, 4))
CHANCE = 0.1  # share of the way from chance to the most that still counts as nothing
BLOCK_BYTES = 512 * 1024  # worked on at a time, or one document
SCALE = 1024

COUNT = np.arange(WINDOW + 2)
WEIGHT = np.rint(COUNT * np.log2(np.maximum(COUNT, 1)) * SCALE).astype(np.int32)
STEP = WEIGHT[1:] - WEIGHT[:-1]
WHOLE = int(WEIGHT[WINDOW])


def levels(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The entropy level of every window; windows may go over the ends of documents."""
    whole = int(WEIGHT[window])
    size = len(data) - window + 1
    before = np.zeros(len(data), np.uint8)
    after = np.zeros(len(data), np.uint8)
    for lag in range(1, window):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    gained, lost = STEP[before], STEP[after]
    change = np.empty(size, np.int32)
    change[0] = gained[:window].sum()
    change[1:] = gained[window:] - lost[: size - 1]
    return (whole - np.cumsum(change, dtype=np.int32)) * np.int64(LEVELS) // whole


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where each starts and where it ends."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends


def within(texts: list[bytes], window: int, below: int) -> list[int]:
    """Which texts have windows of a further kind."""
    return [i for i, t in enumerate(texts) if window <= len(t) < below]


def window_counts(texts: list[bytes], window: int) -> np.ndarray:
    """How many windows of one size have each level."""
    data, starts, ends = joined(texts)
    if len(data) < window:
        return np.zeros(LEVELS + 1, np.int64)
    found = levels(data, window)
    own = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= window
    np.add.at(own, starts[long], 1)
    np.add.at(own, ends[long] - window + 1, -1)
    return np.bincount(found[np.cumsum(own)[: len(found)] > 0], minlength=LEVELS + 1)


def level_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each level; a row for each kind of window."""
    counts = [window_counts(texts, WINDOW)]
    for window, below, _ in FURTHER:
        counts.append(window_counts([texts[i] for i in within(texts, window, below)], window))
    return np.stack(counts)


def ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each level among those of its kind, the rarest first; the lower among equals.

    Short windows of bytes that all differ are no noise.
    """
    found = np.empty(counts.shape, np.int64)
    for kind, row in enumerate(counts):
        found[kind, np.argsort(row, kind="stable")] = np.arange(LEVELS + 1)
    found[:, :WEAK] = found[0, STRONG + 1 :] = LEVELS + 1
    return found


def chosen(found: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the features of all texts and the text each is in; ``found`` are ranks."""
    key = (found << 32) | np.arange(len(found))
    low, short = key, key
    for step in (1, 2, 4, 8, 16, 32):
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        short = low if step == SHORT_RUN // 2 else short
    places, owners = [], []
    for text, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        windows = end - start - WINDOW + 1
        if windows <= 0:
            continue
        run, needed, best = (SHORT_RUN, SHORT_COUNTED, short) if windows < SHORT else (RUN, COUNTED, low)
        if windows < run:
            best = key[start : start + windows].min(keepdims=True)
        else:
            best = best[start : start + windows - run + 1]
        cuts = np.flatnonzero(best[1:] != best[:-1]) + 1
        cuts = np.concatenate([[0], cuts, [len(best)]])
        counted = np.diff(cuts)
        best = best[cuts[:-1]]
        real = best >> 32 <= LEVELS
        enough = real & (counted >= needed)
        if not enough.any() and real.any():
            enough = real & (counted == counted[real].max())
        own = best[enough] & 0xFFFFFFFF
        places.append(own)
        owners.append(np.full(len(own), text))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(owners)


def winnowed(
    found: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, run: int
) -> tuple[np.ndarray, np.ndarray]:
    """As ``chosen``, for a further kind: all windows that are the leftmost rarest of a run."""
    places, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for text, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        own = (found[start : end - window + 1] << 32) | np.arange(start, end - window + 1)
        runs = np.lib.stride_tricks.sliding_window_view(own, min(run, len(own)))
        best = np.unique(runs.min(axis=1))
        best = np.sort(best[best >> 32 <= LEVELS] & 0xFFFFFFFF)
        places.append(best)
        owners.append(np.full(len(best), text))
    return np.concatenate(places), np.concatenate(owners)


def mixed(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of 64-bit numbers."""
    value = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(rows.shape[1]):
        value = (value ^ rows[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
    value *= np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(32))


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[bytes]:
    """The chained filters of each text, one after the other.

    A text without features, such as one below 8 bytes, is one feature itself;
    an empty text has no filter.
    """
    data, starts, ends = joined(texts)
    if len(data) >= WINDOW:
        places, owners = chosen(rank[0][levels(data)], starts, ends)
        rows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places]
        hashes = mixed(np.ascontiguousarray(rows).view(np.uint64))
    else:
        owners = np.empty(0, np.int64)
        hashes = np.empty(0, np.uint64)
    for kind, (window, below, run) in enumerate(FURTHER, 1):
        some = within(texts, window, below)
        if not some:
            continue
        data, starts, ends = joined([texts[i] for i in some])
        places, of = winnowed(rank[kind][levels(data, window)], starts, ends, window, run)
        rows = np.lib.stride_tricks.sliding_window_view(data, window)[places]
        hashes = np.concatenate([hashes, mixed(np.ascontiguousarray(rows).view(np.uint64))])
        owners = np.concatenate([owners, np.array(some)[of]])
    order = np.argsort(owners, kind="stable")
    hashes, owners = hashes[order], owners[order]
    counts = np.bincount(owners, minlength=len(texts))
    lone = [i for i, t in enumerate(texts) if t and not counts[i]]
    if lone:
        own = [hashlib.blake2b(texts[i], digest_size=8).digest() for i in lone]
        hashes = np.concatenate([hashes, np.frombuffer(b"".join(own), np.uint64)])
        owners = np.concatenate([owners, lone])
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
        counts = np.bincount(owners, minlength=len(texts))
    first = np.cumsum(counts) - counts
    filters = -(-counts // FILTER_FEATURES)
    base = np.cumsum(filters) - filters
    number = base[owners] + (np.arange(len(owners)) - first[owners]) // FILTER_FEATURES
    bits = np.zeros(int(filters.sum()) * FILTER_BITS, bool)
    for h in range(HASHES):
        part = (hashes >> np.uint64(11 * h)) & np.uint64(FILTER_BITS - 1)
        bits[number * FILTER_BITS + part.astype(np.int64)] = True
    packed = np.packbits(bits).tobytes()
    size = FILTER_BITS // 8
    return [packed[b * size : (b + n) * size] for b, n in zip(base.tolist(), filters.tolist())]


def likeness(left: bytes, right: bytes) -> float:
    """0 to 1: for each filter of the shorter chain the best of the other, on average.

    Equal chains are 1, also two without filters; one without is 0 to any other.
    """
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    size = FILTER_BITS // 8
    a, b = (
        np.unpackbits(np.frombuffer(x, np.uint8)).reshape(-1, FILTER_BITS).astype(np.float32)
        for x in ((left, right) if len(left) <= len(right) else (right, left))
    )
    best = np.zeros(len(a))
    held = a.sum(axis=1, keepdims=True)
    for first in range(0, len(b), size):
        block = b[first : first + size]
        other = block.sum(axis=1)
        most = np.minimum(held, other)
        chance = held * other / FILTER_BITS
        cut = chance + CHANCE * (most - chance)
        near = (a @ block.T - cut) / np.maximum(most - cut, 1e-6)
        best = np.maximum(best, near.max(axis=1))
    return float(np.clip(best, 0, 1).mean())


def blocks(rows: Iterator, size) -> Iterator[list]:
    """Lists of rows that together have about ``BLOCK_BYTES``."""
    turn(__name__)
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BLOCK_BYTES:
            yield held
            held, total = [], 0
    if held:
        yield held


def level_ranks(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """The rank of each entropy level among all windows of all texts, a row for each kind.

    Tasks count levels; the counts, ``LEVELS + 1`` numbers for each kind, are summed by Spark.
    """
    ship(df.sparkSession.sparkContext.applicationId)
    schema = StructType([StructField("level", IntegerType()), StructField("n", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + len(FURTHER), LEVELS + 1), np.int64)
        texts = (t for b in batches for t in b.column(0).to_pylist())
        for block in blocks(texts, len):
            total += level_counts(block)
        held = np.flatnonzero(total)
        columns = [pa.array(held.astype(np.int32)), pa.array(total.ravel()[held])]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    source = df.select(F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"))
    counts = np.zeros((1 + len(FURTHER)) * (LEVELS + 1), np.int64)
    for row in source.mapInArrow(run, schema).groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[row["level"]] = row["n"]
    return ranks(counts.reshape(-1, LEVELS + 1))


def followed(
    df: DataFrame, *, ranges: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows (range, extra, id, text) so that in each range every row is before its next.

    The order is that of descending integer ids, null last, equal ids by a hash
    of the text; after the last row comes the first. Rows are dealt to ``ranges`` ranges of about
    equal count; the first row of each is copied to the end of the range before
    (``extra``). The driver holds the cut points and one id for each range.
    """
    spark = df.sparkSession
    least = -(1 << 63)
    rows = df.select(
        F.coalesce(F.col(id_column), F.lit(least)).alias("key"),
        F.col(id_column).alias("id"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    side = max(1, round(ranges**0.5))
    shares = [k / (side * side) for k in range(1, side * side)] or [0.5]
    found = rows.agg(F.percentile_approx("key", shares, 16 * side * side)).first()[0]
    cuts = sorted(set(found or []))
    groups = [cuts[i : i + side] for i in range(0, len(cuts), side)]
    if groups:  # the number of cut points below a key: first the group, then within it
        firsts = F.array(*[F.lit(g[0]) for g in groups])
        table = F.array(*[F.array(*map(F.lit, g)) for g in groups])
        above = F.size(F.filter(firsts, lambda c: c < F.col("key")))
        within = F.size(F.filter(F.element_at(table, above), lambda c: c < F.col("key")))
        number = F.when(above == 0, 0).otherwise((above - 1) * side + within)
    else:
        number = F.lit(0)
    rows = rows.withColumn("range", -number.cast("int"))
    heads = rows.groupBy("range").agg(F.max("key").alias("head")).collect()
    heads = sorted((r["range"], r["head"]) for r in heads)
    copies = [(h, heads[i - 1][0]) for i, (_, h) in enumerate(heads)]
    to = spark.createDataFrame(copies, "head long, target int")
    own = F.struct("range", F.lit(False).alias("extra"))
    copied = F.struct(F.col("target").alias("range"), F.lit(True).alias("extra"))
    dealt = (
        rows.join(F.broadcast(to), F.col("key") == F.col("head"), "left")
        .withColumn(
            "both",
            F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, copied)),
        )
        .select("key", "id", "text", F.explode("both").alias("both"))
        .select("key", "id", "text", "both.range", "both.extra")
    )
    order = [F.col("range"), F.col("extra"), F.col("key").desc(), F.xxhash64("text")]
    return dealt.repartition("range").sortWithinPartitions(*order).select(
        "range", "extra", "id", "text"
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def rare_digests(
    df: DataFrame,
    *,
    ranges: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how near they are.

    Columns id, n_chars, edited_sha256, fingerprint, edited_fingerprint (both
    hexadecimal), near_edited, near_next. A null text is empty. An empty text
    has an empty fingerprint, near 1 to another empty one and 0 to the rest.
    Very long texts are one block. Repeated rows follow each other. One
    document is its own next. Other columns are not read.

    The levels are counted over all texts first; then texts move once, into
    ranges of ids, where each row meets its next.
    """
    spark = df.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = level_ranks(df, text_column)
    rows = followed(df, ranges=ranges, id_column=id_column, text_column=text_column)
    schema = StructType(
        [
            StructField(id_column, rows.schema["id"].dataType),
            StructField("n_chars", LongType()),
            StructField("edited_sha256", StringType()),
            StructField("fingerprint", StringType()),
            StructField("edited_fingerprint", StringType()),
            StructField("near_edited", DoubleType()),
            StructField("near_next", DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Each row's id and text, with the text of the row that follows in its range."""
        held = None
        for batch in batches:
            for number, extra, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and held[0] == number:
                    yield held[1], held[2], text
                held = None if extra else (number, own, text)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        new = [edited(text, following) for _, text, following in rows]
        own = [text.encode() for _, text, _ in rows]
        after = [following.encode() for *_, following in rows]
        changed = [t.encode() for t in new]
        linked = [i for i in range(len(rows)) if i + 1 == len(rows) or after[i] != own[i + 1]]
        made = fingerprints([*own, *changed, *(after[i] for i in linked)], rank)
        n = len(rows)
        mine, theirs, rest = made[:n], made[n : 2 * n], made[2 * n :]
        following = [*mine[1:], b""]
        for i, other in zip(linked, rest):
            following[i] = other
        columns = [
            [r[0] for r in rows],
            [len(r[1]) for r in rows],
            [hashlib.sha256(t).hexdigest() for t in changed],
            [x.hex() for x in mine],
            [x.hex() for x in theirs],
            [likeness(a, b) for a, b in zip(mine, theirs)],
            [likeness(a, b) for a, b in zip(mine, following)],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in blocks(pairs(batches), lambda r: 2 * len(r[1])):
            yield block(some)

    return rows.mapInArrow(run, schema)
