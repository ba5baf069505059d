"""Keyed merging: latest row per key, change classification, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import all_set, quoted
from syncflow.operators.skew import HOT_ROWS, join_one
from syncflow.staging import Staging

NULL_POLICIES = ("overwrite", "keep")


def keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can be delivered: no key column is null."""
    return df.where(all_set(keys))


def unkeyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to report as failures: some key column is null."""
    return df.where(~all_set(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns, nulls least.

    The remaining columns break ties, so the choice does not depend on the
    input order. Spark limits each group to its first row before the shuffle,
    so a key that holds a third of the input sends one row per map task.
    """
    taken = [*keys, *order]
    ties = [_tie(f) for f in df.schema.fields if f.name not in taken]
    latest = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(
        *[quoted(c).desc_nulls_last() for c in order], *[c.desc_nulls_last() for c in ties]
    )
    return (
        df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")
    )


def orderable(dtype: T.DataType) -> bool:
    """Whether values of the type can be sorted."""
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _tie(field: T.StructField) -> Column:
    """A column to break ties by: what has no order goes by its JSON text."""
    if orderable(field.dataType):
        return quoted(field.name)
    return F.to_json(F.struct(quoted(field.name)))


def matched_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool = False
) -> DataFrame:
    """Distinct keys of ``source`` that ``target`` holds already.

    Only key columns are read. The source is the build side: a ``small`` one is
    broadcast and the target is not shuffled; otherwise both sides are joined
    by a shuffle of their keys.
    """
    columns = [quoted(k) for k in keys]
    wanted = source.select(*columns).distinct()
    if small:
        wanted = F.broadcast(wanted)
    return target.select(*columns).join(wanted, list(keys), "left_semi").distinct()


def classify_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """``source`` plus ``action``: ``update`` if the target has the key, else ``insert``.

    The source is read several times. With ``staging`` it is computed once and
    written; leave that out if it is a table already.
    """
    small = False
    if staging is not None:
        source, small = staging.write_checked(source, "source")
    known = matched_keys(target, source, keys, small).withColumn("_known", F.lit(True))
    action = F.when(F.col("_known"), F.lit("update")).otherwise(F.lit("insert"))
    return join_one(source, known, keys, "left", hot_rows).select(
        *[quoted(c) for c in source.columns], action.alias("action")
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_policy: str = "overwrite",
    small: bool = False,
) -> DataFrame:
    """The target with the source's values, and the source's new rows.

    ``source`` has one row per key and no null keys. A source whose written size
    was checked (``small``) is broadcast, and the target is not shuffled.
    Otherwise one full outer join reads each side once.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {null_policy!r}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns absent from the target: {extra}")

    carried = [c for c in source.columns if c not in keys]
    arriving = source.select(
        *[quoted(k) for k in keys],
        *[quoted(c).alias(f"_new_{c}") for c in carried],
        F.lit(True).alias("_hit"),
    )
    types = {f.name: f.dataType for f in target.schema.fields}

    def merged(name: str) -> Column:
        if name not in carried:
            return quoted(name).cast(types[name]).alias(name)
        fresh = quoted(f"_new_{name}").cast(types[name])
        if null_policy == "keep":
            return F.coalesce(fresh, quoted(name)).alias(name)
        return F.when(F.col("_hit"), fresh).otherwise(quoted(name)).alias(name)

    columns = [merged(c) for c in target.columns]
    if not small:
        return target.join(arriving, list(keys), "full_outer").select(*columns)
    changed = target.join(F.broadcast(arriving), list(keys), "left").select(*columns)
    known = matched_keys(target, source, keys, small=True)
    added = source.join(known, list(keys), "left_anti").select(
        *[
            (quoted(c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return changed.unionByName(added)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_policy: str = "overwrite",
    order: Sequence[str] = (),
    staging: Staging | None = None,
) -> DataFrame:
    """The target after the source rows were merged in by key.

    Source values win. ``null_policy="keep"`` lets a null leave the target
    value alone. Target columns the source does not carry keep their values
    (null on new rows). Source rows without a key are left out; repeated keys
    are reduced to their latest row by ``order``. The source is read several
    times; with ``staging`` it is computed once and written.
    """
    incoming = dedup_latest(keyed_rows(source, keys), keys, order)
    small = False
    if staging is not None:
        incoming, small = staging.write_checked(incoming, "incoming")
    return merge_rows(target, incoming, keys, null_policy, small)
