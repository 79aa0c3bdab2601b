"""Sets of integer keys as bitmaps: and, or and minus without joining keys.

Keys are grouped in blocks of 64 (``key >> 6``), and a block's keys are the bits of one
long, combined by ``bit_or`` (partial aggregation, so repeated keys cost nothing
beyond their task). A set of n dense keys is n / 64 rows. Set operations are bit
operations on blocks that meet in one aggregation by block number.

NULL is no key. Negative keys are keys like others.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col

BLOCK_BITS = 6


#: A set of so many keys at most is sent to every task.
SENT_KEYS = 500_000


def without_keys(rows: DataFrame, key: str, keys: DataFrame, name: str, also: Column | None = None,
                 n_keys: int | None = None, parts: int | None = None) -> DataFrame:
    """``rows`` whose ``key`` is not a value of column ``name`` of ``keys`` (where ``also`` holds, if given).

    Up to ``SENT_KEYS`` keys (``n_keys``, counted by the caller) go to every task and the rows stay where they are.
    More are dealt with the rows into ``parts`` partitions, a number that follows the bytes of the rows; a
    partition's keys are looked up in a hash table, so the whole rows are not sorted.
    """
    on = c(key) == c(name) if also is None else (c(key) == c(name)) & also
    if n_keys is not None and n_keys <= SENT_KEYS:
        keys = F.broadcast(keys)
    elif parts:
        rows, keys = rows.repartition(parts, key), keys.repartition(parts, name).hint("shuffle_hash")
    return rows.join(keys, on, "left_anti")


def _block(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), BLOCK_BITS)


def _bit(key: Column) -> Column:
    seat = key.cast("bigint").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), seat)


def bitmap(keys: DataFrame) -> DataFrame:
    """(block, bits) of the keys in the first column."""
    key = c(keys.columns[0])
    return keys.where(key.isNotNull()).select(_block(key).alias("block"), _bit(key).alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("bits"))


def combined(sets: dict[str, DataFrame]) -> DataFrame:
    """(block, one column of bits for each named bitmap): all blocks of any set, absent ones as 0."""
    names = list(sets)
    zero = F.lit(0).cast("bigint")
    rows = [df.select("block", *[(c("bits") if x == name else zero).alias(x) for x in names]) for name, df in sets.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("block").agg(*[F.bit_or(x).alias(x) for x in names])


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of both bitmaps."""
    return combined({"a": a, "b": b}).select("block", c("a").bitwiseAND(c("b")).alias("bits")).where("bits <> 0")


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of at least one of the bitmaps."""
    return a.unionByName(b).groupBy("block").agg(F.bit_or("bits").alias("bits"))


def without(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks."""
    return combined({"a": a, "b": b}).select("block", c("a").bitwiseAND(F.bitwise_not(c("b"))).alias("bits")).where("bits <> 0")


def size(a: DataFrame) -> DataFrame:
    """(n): how many keys a bitmap holds."""
    return a.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias("n"))


def keys_of(a: DataFrame, name: str = "key") -> DataFrame:
    """The keys of a bitmap, one row each."""
    seats = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda i: F.call_function("getbit", c("bits"), i) == 1)
    return a.select("block", F.explode(seats).alias("i")).select((F.call_function("shiftleft", c("block"), F.lit(BLOCK_BITS)) + c("i")).alias(name))


def overlaps(sets: dict[str, DataFrame]) -> DataFrame:
    """(left_set, right_set, common_keys) of every pair of named key tables; a set with itself gives its size.

    One pass over each table and one aggregation by block, for any number of pairs.
    """
    blocks = combined({name: bitmap(df) for name, df in sets.items()})
    pairs = list(combinations_with_replacement(sets, 2))
    counts = blocks.agg(*[F.coalesce(F.sum(F.bit_count(c(a).bitwiseAND(c(b)))), F.lit(0)).cast("bigint").alias(f"n{i}") for i, (a, b) in enumerate(pairs)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left_set"), F.lit(b).alias("right_set"), c(f"n{i}").alias("common_keys")) for i, (a, b) in enumerate(pairs)])))
