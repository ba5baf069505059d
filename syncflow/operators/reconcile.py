"""Matching per-record delivery results back to the rows that were sent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncflow.functions.columns import quoted
from syncflow.operators.numbering import number_rows
from syncflow.operators.skew import HOT_ROWS, join_one
from syncflow.staging import Staging

RESULT_COLUMNS = ("id", "success", "error")


def failures(results: DataFrame, null_is_failure: bool = True) -> DataFrame:
    """Results that did not succeed.

    A result without a verdict counts as failed; ``null_is_failure=False``
    leaves it out, as a plain ``success != 'true'`` does.
    """
    success = F.col("success").cast("string")
    if null_is_failure:
        return results.where(~success.eqNullSafe(F.lit("true")))
    return results.where(success != "true")


def delivery_verdicts(
    results: DataFrame, sent: DataFrame, key: str, null_is_failure: bool = True
) -> DataFrame:
    """A row per sent key and per result that belongs to none, with its ``verdict``.

    ``sent`` has one row per key and no null keys. ``verdict`` is ``delivered``,
    ``failed`` (some result of the key did not succeed), ``unanswered`` (no result
    has the key) or ``unmatched`` (the sent columns are null; ``result_key`` is
    what the result said). ``error`` is the least error text of a key's failures
    (``failed_results`` has them all), or that of the unmatched result. Results are
    reduced to a row per key before the join; unmatched ones are not.
    """
    success = F.col("success").cast("string")
    failed = ~success.eqNullSafe(F.lit("true")) if null_is_failure else success != "true"
    said = results.select(
        quoted(key).cast("string").alias("result_key"),
        F.coalesce(failed, F.lit(False)).alias("_failed"),
        F.col("error").cast("string").alias("error"),
    )
    reduced = (
        said.where(F.col("result_key").isNotNull())
        .groupBy("result_key")
        .agg(
            F.max("_failed").alias("_failed"),
            F.min(F.when(F.col("_failed"), F.col("error"))).alias("error"),
        )
    )
    sent_key = quoted(key).cast("string")
    joined = sent.join(reduced, sent_key == F.col("result_key"), "left")
    verdict = (
        F.when(F.col("result_key").isNull(), "unanswered")
        .when(F.col("_failed"), "failed")
        .otherwise("delivered")
    )
    columns = [quoted(c) for c in sent.columns]
    matched = joined.select(*columns, verdict.alias("verdict"), "error", "result_key")
    keys = sent.select(sent_key.alias("_sent_key"))
    strays = said.join(keys, F.col("result_key") == F.col("_sent_key"), "left_anti").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in sent.schema.fields],
        F.lit("unmatched").alias("verdict"),
        "error",
        "result_key",
    )
    return matched.unionByName(strays)


def failed_results(
    results: DataFrame,
    verdicts: DataFrame,
    key: str,
    null_is_failure: bool = True,
    staging: Staging | None = None,
) -> DataFrame:
    """A row per failed result of a sent key: the columns of its verdict, and its own error."""
    said = failures(results, null_is_failure).select(
        quoted(key).cast("string").alias("result_key"), F.col("error").cast("string").alias("error")
    )
    failed = verdicts.where(F.col("verdict") == "failed").drop("error")
    return join_one(said, failed, ["result_key"], staging=staging).select(
        *[quoted(c) for c in verdicts.columns]
    )


def align_by_key(
    results: DataFrame,
    sent: DataFrame,
    key: str,
    carry: Sequence[str],
    result_key: str | None = None,
    hot_rows: int = HOT_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """Join results to the sent rows on the external key.

    ``carry`` names the sent columns to add; for a key sent more than once they
    come from its greatest ``carry`` values. Reducing the sent side to one row
    per key first (with a partial aggregate) keeps a repeated key from pairing
    with itself. Keys are compared as text, which is how results carry them.

    With ``staging`` the result keys are written and measured; if they are few they
    are broadcast, and only sent rows with one of them are aggregated.
    """
    if staging is not None:
        named = quoted(result_key or key).cast("string")
        asked = results.select(named.alias("_asked")).where("_asked is not null").distinct()
        asked, few = staging.write_checked(asked, "asked")
        if few:
            sent = sent.join(
                F.broadcast(asked), quoted(key).cast("string") == F.col("_asked"), "left_semi"
            )
    grouped = sent.groupBy(quoted(key).cast("string").alias("_key"))
    if len(carry) == 1:  # a plain maximum needs no sort
        rows = grouped.agg(F.max(quoted(carry[0])).alias(carry[0]))
    else:
        newest = F.max(F.struct(*[quoted(c) for c in carry])).alias("_sent")
        rows = grouped.agg(newest).select(
            "_key", *[F.col("_sent").getField(c).alias(c) for c in carry]
        )
    found = results.withColumn("_key", quoted(result_key or key).cast("string"))
    return join_one(found, rows, ["_key"], hot_rows=hot_rows, staging=staging).drop("_key")


def align_by_position(
    results: DataFrame,
    sent: DataFrame,
    order: Sequence[str],
    result_order: Sequence[str],
    carry: Sequence[str],
    staging: Staging | None = None,
    check: bool = True,
) -> DataFrame:
    """Join the n-th result to the n-th sent row.

    Only for results that carry no key. Both orders must be total and both
    sides equally long; with ``check`` anything else raises instead of pairing
    the wrong rows.
    """
    staging = staging or Staging(results.sparkSession, "aligned")
    # Counted, checked and numbered: all of one evaluation.
    results = staging.write(results, "results")
    wanted = list(dict.fromkeys([*order, *carry]))
    if check:
        _require_total_order(results, result_order, "results")
        _require_total_order(sent, order, "sent rows")
    left = number_rows(results, result_order, staging, unique=check)
    right = number_rows(sent.select(*[quoted(c) for c in wanted]), order, staging, unique=check)
    if check:
        sizes = [df.agg(F.count(F.lit(1))).first()[0] for df in (left, right)]
        if sizes[0] != sizes[1]:
            raise ValueError(f"{sizes[0]} results for {sizes[1]} sent rows")
    return left.join(right.select("row_num", *[quoted(c) for c in carry]), "row_num", "inner")


def positioned(
    results: DataFrame, order: Sequence[str], n_sent: int, staging: Staging, name: str
) -> DataFrame:
    """Results numbered in their order; as many as were sent, or positions mean nothing."""
    _require_total_order(results, order, "results")
    n_results = results.count()
    if n_results != n_sent:
        raise ValueError(f"{n_results} results for {n_sent} sent rows")
    return number_rows(results, order, staging, unique=True, name=name)


def _require_total_order(df: DataFrame, order: Sequence[str], what: str) -> None:
    tied = df.groupBy(*[quoted(c) for c in order]).count().where("count > 1")
    if not tied.isEmpty():
        raise ValueError(f"{what} are tied in {list(order)}: positions are not defined")


def failure_log(
    results: DataFrame,
    sent: DataFrame,
    key: str,
    created: str,
    mode: str = "key",
    order: Sequence[str] = (),
    result_order: Sequence[str] = (),
    result_key: str | None = None,
    staging: Staging | None = None,
    null_is_failure: bool = True,
) -> DataFrame:
    """One row per failed result: key, ``error_message``, ``created_on_date``.

    By key the failures are picked first and joined alone. By position every
    result is numbered before the failures are picked, since a failure keeps
    the position it had among all results.
    """
    if mode == "key":
        failed = failures(results, null_is_failure)
        joined = align_by_key(failed, sent, key, [created], result_key, staging=staging)
        shown = quoted(result_key or key)
    elif mode == "position":
        bare = results.select(*RESULT_COLUMNS, *[c for c in result_order if c not in RESULT_COLUMNS])
        sent = sent.withColumn("_sent_key", quoted(key))
        aligned = align_by_position(
            bare, sent, order, result_order, ["_sent_key", created], staging
        )
        joined = failures(aligned, null_is_failure)
        shown = F.col("_sent_key")
    else:
        raise ValueError(f"mode must be 'key' or 'position', not {mode!r}")
    return joined.select(
        shown.alias(key),
        F.col("error").alias("error_message"),
        quoted(created).alias("created_on_date"),
    )


def failure_summary(log: DataFrame, error_col: str = "error_message") -> DataFrame:
    """Number of failures per error text, for whoever watches the runs."""
    return log.groupBy(quoted(error_col).alias(error_col)).agg(
        F.count(F.lit(1)).alias("failed_count")
    )
