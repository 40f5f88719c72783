"""Hashed byte n-grams of texts, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MULTIPLIER = np.uint32(0x9E3779B1)  # odd, so that hashing by it loses nothing


def gram_buckets(data: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of every n-gram of ``order`` bytes, with repeats, in order."""
    if len(data) < order:
        return np.empty(0, np.uint32)
    wide = data.astype(np.uint32)
    mixed = wide[: len(wide) - order + 1] + np.uint32(order)
    for n in range(1, order):
        mixed = mixed * MULTIPLIER
        mixed ^= mixed >> np.uint32(15)
        mixed += wide[n : len(wide) - order + 1 + n]
    mixed = mixed * MULTIPLIER
    mixed ^= mixed >> np.uint32(13)
    return (mixed * MULTIPLIER) >> np.uint32(32 - bits)


class Distinct:
    """The distinct values of arrays of buckets, without sorting.

    Each value stores the place of its last occurrence in a table; the
    occurrences that find their own place there are one of each value.
    """

    def __init__(self, bits: int):
        self.table = np.zeros(1 << bits, np.int32)

    def of(self, buckets: np.ndarray) -> np.ndarray:
        places = np.arange(len(buckets), dtype=np.int32)
        self.table[buckets] = places
        return buckets[self.table[buckets] == places]


def class_sample(df: DataFrame, label: str, order: Column, most: int) -> DataFrame:
    """At most ``most`` rows of each label, those lowest in a hash of ``order``.

    A first pass counts the labels; the second keeps about twice as many rows as
    needed by the hash, of which each task hands on at most ``most`` for a label.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if not counts:
        return df.limit(0)
    unit = (F.pmod(F.xxhash64(order.cast("string"), F.lit(7)), F.lit(1 << 20)) / (1 << 20)).alias("u")
    share = F.lit(1.0)
    for value, count in counts.items():
        share = F.when(F.col(label) == value, min(1.0, (2 * most + 50) / count)).otherwise(share)
    place = F.row_number().over(Window.partitionBy(label).orderBy("tm_unit", order))
    return (
        df.withColumn("tm_unit", unit)
        .filter(F.col("tm_unit") < share)
        .withColumn("tm_place", place)
        .filter(F.col("tm_place") <= most)
        .drop("tm_unit", "tm_place")
    )
