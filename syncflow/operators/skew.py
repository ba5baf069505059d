"""A join that keeps its balance when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncflow.functions.columns import all_set, quoted
from syncflow.staging import Staging

#: A key with more rows than this is joined apart from the others.
HOT_ROWS = 1_000_000
#: Parts a hot key is dealt to if its partners are too large to be broadcast.
SALTS = 64


def join_one(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """Join ``many`` to ``one``, which has one row per key (``inner`` or ``left``).

    A hash join sends all rows of a key to one task. Spark can split such a
    task only where both join inputs come straight from a shuffle, which is not
    so if ``one`` was aggregated. Hot keys are therefore counted first. If there
    are none, the join is a plain one. Otherwise their partners are written and
    measured: small ones are broadcast and the rows of hot keys stay in place;
    larger ones are copied once per salt, and the rows dealt over the salts.
    Rows without a key, which a left join would gather in one task, are not
    shuffled at all.

    ``many`` is read up to four times: hand in a table or staged rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    staging = staging or Staging(many.sparkSession, "hot-keys")
    on = list(keys)
    keyed = many.where(all_set(on))
    hot, few = staging.write_checked(
        keyed.groupBy(*[quoted(k).alias(k) for k in on])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .drop("_rows"),
        "hot",
    )
    if hot.isEmpty():
        joined = keyed.join(one, on, how)
    else:
        hot = F.broadcast(hot) if few else hot
        crowded, usual = (keyed.join(hot, on, f"left_{kind}") for kind in ("semi", "anti"))
        partners, small = staging.write_checked(one.join(hot, on, "left_semi"), "partners")
        if small:
            crowded = crowded.join(F.broadcast(partners), on, how)
        else:
            salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
            copies = partners.withColumn(
                "_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
            )
            crowded = (
                crowded.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
            )
        joined = crowded.unionByName(usual.join(one, on, how))
    if how == "left":
        alone = {
            f.name: F.lit(None).cast(f.dataType) for f in one.schema.fields if f.name not in on
        }
        joined = joined.unionByName(many.where(~all_set(on)).withColumns(alone))
    return joined
