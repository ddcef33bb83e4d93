"""A stored membership index: which keys a table may already hold.

A blocked Bloom filter as an ordinary table: keys hash to a range, a block of
256 bits in it, and one bit in each of the block's eight words. Building it is
one aggregate of ``bit_or`` with a map-side step, merging two indexes is the
same aggregate, and probing is an equi-join of the keys with the blocks. So
the index has any size, nothing of it goes through the driver, and a hot
key is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_KEY = 12  # about 0.5 % of absent keys look present


def key_hash(keys: Sequence[str], name: str = "__h") -> F.Column:
    """64 bits of the key columns; nulls hash like a value of their own."""
    parts = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return F.xxhash64(*parts).alias(name)


def range_of(h, ranges: int) -> F.Column:
    return F.pmod(F.col(h), F.lit(ranges)).cast("int")


def _block(h, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(h), F.lit("block")), F.lit(blocks)).cast("int")


def _bits(h) -> list[F.Column]:
    """One bit of 32 in each word: five bits of a second hash each."""
    g = F.xxhash64(F.col(h), F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 5 * i).bitwiseAND(31).cast("int")) for i in range(WORDS)]


def blocks_for(keys_per_range: int) -> int:
    """Blocks of a range that is to hold so many keys."""
    return max(1, -(-keys_per_range * BITS_PER_KEY // (32 * WORDS)))


def build_index(hashes: DataFrame, ranges: int, blocks: int, h: str = "__h") -> DataFrame:
    """(range, block, w0 .. w7) of a frame of key hashes."""
    cols = [F.bit_or(b).alias(f"w{i}") for i, b in enumerate(_bits(h))]
    return hashes.groupBy(range_of(h, ranges).alias("range"), _block(h, blocks).alias("block")).agg(*cols)


def merge_index(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("range", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def probe(rows: DataFrame, index: DataFrame, ranges: int, blocks: int, h: str = "__h", name: str = "maybe") -> DataFrame:
    """``rows`` with the flag ``name``: false says surely absent. Rows of one
    key are the same question, so the distinct hashes are joined, not the rows."""
    asked = rows.select(h).distinct().withColumn("range", range_of(h, ranges)).withColumn("block", _block(h, blocks))
    got = asked.join(index, ["range", "block"])
    hit = None
    for i, b in enumerate(_bits(h)):
        one = F.col(f"w{i}").bitwiseAND(b) != 0
        hit = one if hit is None else hit & one
    present = got.where(hit).select(F.col(h), F.lit(True).alias(name))
    return rows.join(present, h, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
