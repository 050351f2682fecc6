"""Blocked Bloom filters as tables: one row per block, eight 64-bit words, one bit of a key in each word.

A filter with ``blocks`` blocks is built by or-ing the bits of its keys per block, in the task and after the shuffle, and
asked by an equi-join on the block. Filters of many groups (files) are one table with the group beside the block; blocks
without a key have no row, so a small group stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.joins import spread_join

WORDS = 8
WORD_COLUMNS = tuple(f"w{i}" for i in range(WORDS))
BITS_PER_KEY = 16


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))


def block_of(key_hash: str, blocks: int) -> Column:
    return F.pmod(F.col(key_hash), F.lit(blocks)).cast("int")


def bit_of(key_hash: str, word: int) -> Column:
    """Six bits of a second hash choose the bit; it is hashed anew, as the first hash chose the block."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key_hash}), {6 * word}) & 63 as int))")


def merged(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per block (and group): the union of filters."""
    return rows.groupBy(*by, "block").agg(*[F.bit_or(w).alias(w) for w in WORD_COLUMNS])


def filter_of(keys: DataFrame, key_hash: str, blocks: int, by: Sequence[str] = ()) -> DataFrame:
    """The filter of all keys, or one per group."""
    bits = [bit_of(key_hash, i).alias(w) for i, w in enumerate(WORD_COLUMNS)]
    return merged(keys.select(*by, block_of(key_hash, blocks).alias("block"), *bits), by)


def may_hold(keys: DataFrame, key_hash: str, filters: DataFrame, blocks: int) -> DataFrame:
    """The keys that a filter may hold, with the other columns of the filters (the group). Every key that is in a filter
    comes back; of the others about one in a thousand does, if the filter has ``BITS_PER_KEY`` bits a key."""
    asked = keys.withColumn("block", block_of(key_hash, blocks))
    every = reduce(Column.__and__, [F.col(w).bitwiseAND(bit_of(key_hash, i)) != 0 for i, w in enumerate(WORD_COLUMNS)])
    return spread_join(asked, filters, ["block"], "inner").where(every).drop("block", *WORD_COLUMNS)
