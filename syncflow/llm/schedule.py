"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a schedule of ``2**k`` slots, one block of tokens each. Slot ``j``
falls on the van der Corput point of ``j`` (its bits reversed, as a fraction);
the cumulative targets of the sources cut the unit interval, and the piece that
the point falls into names the slot's source. Any stretch of the schedule then
holds each source in proportion, and the whole schedule is right to one block.
Slots of a source are ranked by their position. The rank has a closed form: the
points of an aligned stretch of ``2**c`` slots are evenly spaced, and the slots
before ``j`` are a union of such stretches, one per bit of ``j``. No slot is sorted.

The documents of a source are shuffled by a hash and laid end to end, again and
again, and cut into blocks of equal tokens; the slot of rank ``r`` takes block
``r``. Offsets come from sums over buckets of the hash, so no source is ordered in
one task. Everything is DataFrame expressions.

Targets: sources share ``share`` times all tokens by their weights; no source
gives more than ``max_epochs`` times its tokens, and what that leaves is shared
out again by weight. The sources' table (a row per source) is the only one that
is ordered as a whole.

Defined results: a null text has no tokens and is never taken. A null source is a
source of its own, after all others. Repeated rows are told apart by position
only, so each has a part of its own; if some are taken more often than others,
which one is undetermined but their number is not. An empty table, or one
without tokens, has an empty schedule and targets of 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.staging import Staging

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
#: Tokens of a block at most; small corpora get at least ``MIN_SLOTS`` slots.
BLOCK_TOKENS = 128
MIN_SLOTS = 1 << 16
#: Documents of a bucket, about.
BUCKET_DOCS = 2_000
#: Up to so many sources, their table is broadcast.
FEW_SOURCES = 20_000
#: Slots that one row of the first expansion stands for, and slots of a task at most.
CHUNK = 1 << 12
TASK_SLOTS = 1 << 21


def token_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; 0 for null."""
    words = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.translate(words, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def shuffled_place(doc_id: Column, text: Column) -> Column:
    """Where a document comes in its shuffled source: a hash of its id and text."""
    own = F.coalesce(doc_id.cast("string"), F.lit(""))
    body = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(own, F.lit("|"), body).cast("binary"))


@dataclass
class Mix:
    """Tables of one mix, all written to the staging folder.

    ``sources``: a row per source with its target. ``documents``: a row per input
    row, with ``id``, ``place`` (its hash), ``size`` and ``start``, the place in the
    source's shuffled tokens. ``schedule``: ``position, source_no, rank``. ``taken``:
    the parts of documents in each slot, ``position, doc_no, first_token, n_tokens``.
    """

    sources: DataFrame
    documents: DataFrame
    schedule: DataFrame
    taken: DataFrame


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int
) -> DataFrame:
    """Targets of a table (source, source_size) with a row per source.

    Sources are filled in the order in which they reach their limit: a source is
    at its limit if the others, sharing what is left by weight, could give no more.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(everything) - 1).withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(w) for w in weights]),
            (F.col("source_no") % len(weights) + 1).cast("int"),
        ).cast("long"),
    )
    limit = F.col("source_size") * max_epochs
    by_limit = Window.orderBy(limit / F.col("weight"), "source_no")
    whole = Window.partitionBy()
    filled = numbered.select(
        "*",
        F.sum("source_size").over(whole).alias("all_size"),
        F.coalesce(
            F.sum(limit).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("full_before"),
        F.sum("weight")
        .over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        .alias("weight_left"),
    )
    left = F.col("all_size") * share - F.col("full_before")
    capped = filled.withColumn("full", limit * F.col("weight_left") <= left * F.col("weight"))
    # The limit is met by a first stretch of that order.
    rest = capped.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("full"), limit)).over(whole), F.lit(0)).alias("full_size"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole).alias("weight_rest"),
    )
    shared = (F.col("all_size") * share - F.col("full_size")) * F.col("weight") / F.col("weight_rest")
    targets = rest.withColumn(
        "target", F.when(F.col("full"), limit.cast("double")).otherwise(shared.cast("double"))
    )
    upto = everything.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = everything.rowsBetween(Window.unboundedPreceding, -1)

    def reach(window) -> Column:
        """Targets up to here: whole numbers summed apart from shared parts."""
        whole_part = F.coalesce(F.sum(F.when(F.col("full"), limit)).over(window), F.lit(0))
        weight = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(window), F.lit(0))
        part = (F.col("all_size") * share - F.col("full_size")) * weight / F.col("weight_rest")
        return whole_part.cast("double") + F.coalesce(part.cast("double"), F.lit(0.0))

    return targets.select(
        "source",
        "source_no",
        "weight",
        "source_size",
        "target",
        reach(before).alias("target_from"),
        reach(upto).alias("target_to"),
    )


def _power(e: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), e)


def _rank(point: Column, low: Column, high: Column, bits: int) -> Column:
    """How many slots before that of ``point`` fall into points low to high - 1.

    Slot j has the point with j's bits reversed. For each set bit e of the point
    there is a stretch of earlier slots whose points are the numbers that agree
    with it below bit e, and are 0 at e.
    """

    def earlier(e: Column) -> Column:
        step = _power(e + 1)
        rest = point.bitwiseAND(_power(e) - 1)

        def upto(end: Column) -> Column:
            return F.floor((end - rest + step - 1) / step).cast("long")

        is_set = point.bitwiseAND(_power(e)) != 0
        return F.when(is_set, upto(high) - upto(low)).otherwise(F.lit(0).cast("long"))

    if not bits:
        return F.lit(0).cast("long")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(bits - 1)),
        F.lit(0).cast("long"),
        lambda total, e: total + earlier(e),
    )


def _reversed(point: Column, bits: int) -> Column:
    if not bits:
        return F.lit(0).cast("long")
    return F.conv(F.reverse(F.lpad(F.bin(point), bits, "0")), 2, 10).cast("long")


def schedule_slots(sources: DataFrame, bits: int, total: float) -> DataFrame:
    """``position, source_no, rank`` of ``2**bits`` slots."""
    slots = 1 << bits
    edge = lambda c: F.ceil(F.lit(float(slots)) * F.col(c) / F.lit(total)).cast("long")
    ranges = sources.select(
        F.col("source_no").cast("int"),
        edge("target_from").alias("low"),
        F.least(edge("target_to"), F.lit(slots)).alias("high"),
    ).where("low < high")
    chunks = ranges.select(
        "*",
        F.explode(
            F.sequence(
                F.floor(F.col("low") / CHUNK), F.floor((F.col("high") - 1) / CHUNK)
            )
        ).alias("chunk"),
    )
    # A row here makes up to CHUNK slots: few rows are no reason for few tasks.
    usual = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(max(min(usual, -(-slots // CHUNK)), slots // TASK_SLOTS), "chunk")
    points = chunks.select(
        "source_no",
        "low",
        "high",
        F.explode(
            F.sequence(
                F.greatest("low", F.col("chunk") * CHUNK),
                F.least(F.col("high") - 1, F.col("chunk") * CHUNK + CHUNK - 1),
            )
        ).alias("point"),
    )
    return points.select(
        _reversed(F.col("point"), bits).alias("position"),
        "source_no",
        _rank(F.col("point"), F.col("low"), F.col("high"), bits).alias("rank"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    block_tokens: int = BLOCK_TOKENS,
) -> Mix:
    """Schedule a mix of ``docs``."""
    if not 0 < share <= max_epochs:
        raise ValueError("share must be above 0 and at most max_epochs")
    staging = Staging(docs.sparkSession, "mix")
    measured = staging.write(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            token_count(F.col(text_col)).alias("size"),
            shuffled_place(F.col(id_col), F.col(text_col)).alias("place"),
        ),
        "measured",
    )
    sizes = staging.write(
        measured.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
        ),
        "sizes",
    )
    sources = staging.write(
        source_targets(sizes.drop("n_docs"), weights, share, max_epochs), "sources"
    )
    facts = sources.agg(F.max("target_to"), F.count(F.lit(1))).first()
    total, known = facts[0] or 0.0, sources
    if facts[1] <= FEW_SOURCES:
        known = F.broadcast(known)
    wanted = max(total / block_tokens, min(total, MIN_SLOTS), 1.0)
    bits = math.ceil(math.log2(wanted))

    # Offsets: whole buckets before, and the rows before within the bucket. Equal
    # rows are counted first, so that no bucket holds many of them.
    largest = sizes.agg(F.max("n_docs")).first()[0] or 0
    buckets = max(1, min(1 << 24, -(-largest // BUCKET_DOCS)))
    share_of = F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * buckets
    groups = (
        measured.join(
            known.select(
                F.col("source").alias("s_source"), "source_no", "source_size", "target"
            ),
            F.col("source").eqNullSafe(F.col("s_source")),
        )
        .withColumn("bucket", F.shiftright(share_of, 32))
        .groupBy("source_no", "bucket", "place", "size", "id", "source_size", "target")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    by_bucket = Window.partitionBy("source_no").orderBy("bucket")
    length = F.col("size") * F.col("copies")
    bucket_start = (
        groups.groupBy("source_no", "bucket")
        .agg(F.sum(length).alias("bucket_size"))
        .select(
            "source_no",
            "bucket",
            (F.sum("bucket_size").over(by_bucket) - F.col("bucket_size")).alias("bucket_start"),
        )
    )
    inner = Window.partitionBy("source_no", "bucket").orderBy("place", "size", "id")
    documents = (
        groups.withColumn("inner_start", F.sum(length).over(inner) - length)
        .join(bucket_start, ["source_no", "bucket"])
        .select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy_no")
        )
        .select(
            F.monotonically_increasing_id().alias("doc_no"),
            "id",
            "place",
            "source_no",
            "size",
            "source_size",
            "target",
            (F.col("bucket_start") + F.col("inner_start") + F.col("copy_no") * F.col("size")).alias(
                "start"
            ),
        )
    )
    documents = staging.write(documents, "documents")
    some = sources if total else sources.where(F.lit(False))
    schedule = staging.write(schedule_slots(some, bits, total or 1.0), "schedule")
    block = (total / (1 << bits)) or 1.0
    taken = staging.write(_taken(documents, schedule, block, max_epochs), "taken")
    return Mix(sources, documents, schedule, taken)


def _taken(documents: DataFrame, schedule: DataFrame, block: float, epochs: int) -> DataFrame:
    """The parts of documents that the slots take."""
    edge = lambda rank: F.floor(rank * F.lit(block)).cast("long")
    laid = (
        documents.where("size > 0")
        .select("doc_no", "source_no", "size", "source_size", "start", F.explode(
            F.array(*[F.lit(e) for e in range(epochs)])
        ).alias("epoch"))
        .withColumn("from", F.col("epoch") * F.col("source_size") + F.col("start"))
        .withColumn("to", F.col("from") + F.col("size"))
    )
    # Block edges are rounded down, so the first block that reaches past `from` is
    # found among the two around it.
    near = F.floor(F.col("from") / F.lit(block)).cast("long")
    last = F.floor(F.col("to") / F.lit(block)).cast("long") + 1
    parts = laid.select(
        "doc_no", "source_no", "from", "to", F.explode(F.sequence(near, last)).alias("rank")
    ).select(
        "doc_no",
        "source_no",
        "rank",
        (F.greatest("from", edge(F.col("rank"))) - F.col("from")).alias("first_token"),
        (F.least("to", edge(F.col("rank") + 1)) - F.greatest("from", edge(F.col("rank")))).alias(
            "n_tokens"
        ),
    )
    return (
        parts.where("n_tokens > 0")
        .join(schedule, ["source_no", "rank"])
        .select("position", "doc_no", "first_token", "n_tokens")
    )


def tokens_taken(mix: Mix) -> DataFrame:
    """``id, place, source_no, size, source_size, target, taken`` for every document."""
    taken = mix.taken.groupBy(F.col("doc_no").alias("t_doc_no")).agg(
        F.sum("n_tokens").alias("taken")
    )
    return mix.documents.join(taken, F.col("doc_no") == F.col("t_doc_no"), "left").select(
        "id",
        "place",
        "source_no",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )
