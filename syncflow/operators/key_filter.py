"""A Bloom filter of keys: which rows cannot match, before they are shuffled.

A large delta that is no longer broadcast may still be small against what it is merged
with. A filter of its keys takes some twelve bits a key: it is built by an aggregation,
measured, and broadcast to the scan of the other side, of which only rows that may
match go on to the join. Rows that match always pass; of the others less than one in a
hundred does.

Bits are kept in blocks of 4 kB (Spark's bitmaps). All bits of a key lie in one block, so
a row is tested by one lookup. A filter that is too large to be broadcast passes
everything: the join that follows decides, as it does without a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow.functions.columns import all_set, quoted
from syncflow.staging import Staging

BITS_PER_KEY = 12
BITS_SET = 6
#: Bits of a block: the size of a bitmap that Spark aggregates.
BLOCK_BITS = 32_768


@dataclass(frozen=True)
class KeyFilter:
    """``rows`` (block, bits) of ``blocks`` blocks; ``small`` if they may be broadcast."""

    rows: DataFrame
    blocks: int
    small: bool


def _hash(keys: Sequence[str], seed: int) -> Column:
    # Keys are compared as text, so that equal keys of different types meet.
    return F.xxhash64(F.lit(seed), *[quoted(k).cast("string") for k in keys])


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(_hash(keys, 0), F.lit(blocks))


def _positions(keys: Sequence[str]) -> list[Column]:
    """Places of a key's bits: one hash and multiples of another."""
    first, step = _hash(keys, 1), _hash(keys, 2)
    mask = F.lit(BLOCK_BITS - 1)
    low, odd = first.bitwiseAND(mask), step.bitwiseAND(mask).bitwiseOR(F.lit(1))
    return [(low + odd * i).bitwiseAND(mask) for i in range(BITS_SET)]


def key_filter(df: DataFrame, keys: Sequence[str], staging: Staging) -> KeyFilter:
    """The filter of the keys of ``df``, which is read twice: hand in a written table."""
    keyed = df.where(all_set(keys))
    n = keyed.count()
    blocks = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    places = keyed.select(
        _block(keys, blocks).alias("block"), F.explode(F.array(*_positions(keys))).alias("place")
    )
    rows, small = staging.write_checked(
        places.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")), "key-filter"
    )
    return KeyFilter(rows, blocks, small)


def may_match(df: DataFrame, keys: Sequence[str], known: KeyFilter) -> DataFrame:
    """Rows whose key may be in the filter; rows without a key match nothing."""
    keyed = df.where(all_set(keys))
    if not known.small:
        return keyed

    def is_set(place: Column) -> Column:
        byte = F.substring(F.col("_bits"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        bit = place.bitwiseAND(F.lit(7)).cast("int")
        return F.call_function("shiftright", value, bit).bitwiseAND(F.lit(1)) == 1

    held = known.rows.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    hit = F.lit(True)
    for place in _positions(keys):
        hit = hit & is_set(place)
    return (
        keyed.withColumn("_block", _block(keys, known.blocks))
        .join(F.broadcast(held), "_block")
        .where(hit)
        .select(*[quoted(c) for c in df.columns])
    )
