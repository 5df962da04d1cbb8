"""Which stored loads may hold given keys: a key range and a blocked Bloom filter per load and table.

A key falls into one block of ``WORDS`` 64-bit words and sets one bit in each; a block serves about ``SERVED`` keys, so a key that
isn't stored passes with a chance of about 1e-6. A filter is a table with a row per block, made by one grouping and probed by
an equality join, in built-in functions. Key columns are read only of loads in which a candidate is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.session import staged

DIRECT = 1_000_000  # stored rows up to which keys are compared without a filter
WORDS = 16
SERVED = 32


@dataclass(frozen=True)
class Held:
    """What a load holds of a table: rows and the range of the first key column, as text."""

    load: str
    rows: int
    low: str | None
    high: str | None

    @property
    def blocks(self) -> int:
        return max(1, -(-self.rows // SERVED))

    def meets(self, low, high) -> bool:
        """Whether a key between these may be stored; numbers compare as numbers."""
        if not self.rows or low is None or self.low is None:
            return False
        kind = type(low)
        return kind(self.low) <= high and low <= kind(self.high)


def _hashed(keys: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """The block of each key and two hashes whose bits choose a place in every word."""
    block = F.pmod(F.xxhash64(F.lit("block"), *key), F.lit(blocks)).alias("_block")
    return keys.select(*key, block, F.xxhash64(F.lit("low"), *key).alias("_h0"), F.xxhash64(F.lit("high"), *key).alias("_h1"))


def _bit(word: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(shiftright(_h{word // 8}, {word % 8 * 6}) & 63 as int))")


def write_filter(keys: DataFrame, key: Sequence[str], rows: int, path: str) -> None:
    spread = _hashed(keys, key, Held("", rows, None, None).blocks)
    spread.groupBy("_block").agg(*(F.bit_or(_bit(w)).alias(f"w{w}") for w in range(WORDS))).write.parquet(path)


def candidates(spark: SparkSession, keys: DataFrame, key: Sequence[str], held: Sequence[Held], path) -> DataFrame:
    """(key columns, load) of the distinct ``keys`` that pass the filter of a load. ``path(load)`` is where it lies."""
    out = None
    for h in held:
        probed = _hashed(keys, key, h.blocks).join(spark.read.parquet(path(h.load)), "_block")
        for w in range(WORDS):
            probed = probed.where(F.col(f"w{w}").bitwiseAND(_bit(w)) != 0)
        passed = probed.select(*key, F.lit(h.load).alias("load"))
        out = passed if out is None else out.unionByName(passed)
    return out if out is not None else keys.limit(0).withColumn("load", F.lit(""))


def stored_keys(spark: SparkSession, keys: DataFrame, key: Sequence[str], held: Sequence[Held], path, read) -> DataFrame:
    """Stored keys, among them all of ``keys`` that are stored. ``held`` are the loads whose range they meet; ``read(loads)`` reads loads, and is
    asked only for those with a candidate, or for all while they are few."""
    if sum(h.rows for h in held) <= DIRECT:
        few = read([h.load for h in held]) if held else None
        return keys.limit(0).select(*key) if few is None else few.select(*key)
    found = staged(candidates(spark, keys, key, held, path), "candidates")
    loads = sorted(row.load for row in found.select("load").distinct().collect())  # no more than there are loads
    if not loads:
        return keys.limit(0).select(*key)
    return read(loads).select(*key).join(found.select(*key).distinct(), list(key), "left_semi")
