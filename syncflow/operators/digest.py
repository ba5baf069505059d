"""Finding differences of two tables by a tree of range digests.

A watermark tells what was created or updated, never what was deleted. To find that
without joining whole tables, keys are hashed to ranges (the first hex digits of their MD5),
and each range of a side is reduced to a count and a sum of row hashes. Ranges whose
digests agree hold the same rows; only the others are split further, by more digits. Rows are
joined in the ranges that still differ at the last level.

Ranges are of hashed keys, so they are even whatever the keys are. A side sends a digest
for each range that is asked for, some tens of bytes, and no rows. Sums of 60-bit hashes agree
by chance about once in 10**18.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow.functions.columns import all_set, quoted
from syncflow.staging import Staging

#: Hex digits of a range at each level: 256, 65,536 and 16,777,216 ranges at most.
LEVELS = (2, 4, 6)

_RANGE, _HASH = "_range", "_hash"


def _text(names: Sequence[str]) -> Column:
    """Values as one text; a null differs from any value, and texts cannot run together."""
    parts = []
    for name in names:
        value = quoted(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat_ws(",", *parts)


def key_range(keys: Sequence[str], digits: int) -> Column:
    """The range that a key belongs to."""
    return F.substring(F.md5(_text(keys).cast("binary")), 1, digits)


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], digits: int) -> DataFrame:
    row = F.substring(F.md5(_text([*keys, *columns]).cast("binary")), 1, 15)
    return df.where(all_set(keys)).select(
        key_range(keys, digits).alias(_RANGE),
        F.conv(row, 16, 10).cast("decimal(20,0)").alias(_HASH),
    )


def range_digests(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], digits: int
) -> DataFrame:
    """(range, row_count, digest) of every range that holds rows; rows without a key are left out.

    A partial aggregate reduces each task's rows to its ranges before the shuffle.
    """
    return _hashed(df, keys, columns, digits).groupBy(F.col(_RANGE).alias("range")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(_HASH).cast("decimal(38,0)").alias("digest")
    )


def differing_ranges(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    staging: Staging,
    levels: Sequence[int] = LEVELS,
) -> tuple[DataFrame, bool]:
    """(range, target_rows, source_rows) where the tables differ, and whether they are few.

    Each side is scanned once: digests of the last level are written and added up for
    the levels above it. Level by level only ranges below a differing one are compared.
    """
    sides = [
        staging.write(range_digests(df, keys, columns, levels[-1]), "digests")
        for df in (target, source)
    ]
    differing, few = None, False
    for digits in levels:
        at = F.substring("range", 1, digits)
        compared = []
        for name, side in zip(("target", "source"), sides):
            if differing is not None:
                parent = differing.select(F.col("range").alias("parent"))
                parent = F.broadcast(parent) if few else parent
                width = levels[levels.index(digits) - 1]
                side = side.join(
                    parent, F.substring("range", 1, width) == F.col("parent"), "left_semi"
                )
            compared.append(
                side.groupBy(at.alias("range")).agg(
                    F.sum("row_count").alias(f"{name}_rows"),
                    F.sum("digest").cast("decimal(38,0)").alias(f"{name}_digest"),
                )
            )
        same = F.col("target_digest").eqNullSafe(F.col("source_digest")) & F.col(
            "target_rows"
        ).eqNullSafe(F.col("source_rows"))
        rows = compared[0].join(compared[1], "range", "full_outer").where(~same)
        zero = F.lit(0).cast("bigint")
        differing, few = staging.write_checked(
            rows.select(
                "range",
                F.coalesce("target_rows", zero).alias("target_rows"),
                F.coalesce("source_rows", zero).alias("source_rows"),
            ),
            "differing",
        )
    return differing, few


def table_differences(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    staging: Staging | None = None,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Keys whose rows differ, with ``change``: ``vanished``, ``added`` or ``changed``.

    Both tables have one row per key; rows without a key are left out. ``vanished`` keys are
    in the target only. Nothing but rows of differing ranges is shuffled.
    """
    levels = tuple(levels)
    staging = staging or Staging(target.sparkSession, "differences")
    ranges, few = differing_ranges(target, source, keys, columns, staging, levels)
    wanted = ranges.select("range")
    wanted = F.broadcast(wanted) if few else wanted
    sides = []
    for name, df in (("_target", target), ("_source", source)):
        inside = df.where(all_set(keys)).withColumn("range", key_range(keys, levels[-1]))
        sides.append(
            inside.join(wanted, "range", "left_semi").select(
                *[quoted(k) for k in keys], _text(columns).alias(name)
            )
        )
    joined = sides[0].join(sides[1], list(keys), "full_outer")
    change = (
        F.when(F.col("_source").isNull(), "vanished")
        .when(F.col("_target").isNull(), "added")
        .when(F.col("_target") != F.col("_source"), "changed")
    )
    return joined.select(*[quoted(k) for k in keys], change.alias("change")).where(
        F.col("change").isNotNull()
    )
