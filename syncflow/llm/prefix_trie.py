"""The trie of all conversation openings, by ROLLUP over blocks of turns.

Conversations are cut into blocks of ``width`` turns. A block is a row with a column
for each turn's id, and with the node that its conversation had reached before. One
``GROUP BY block, node, ROLLUP(t1 ... tk)`` then counts every prefix that ends in any
block: ``grouping_id`` tells how many columns a group holds. A node is named by its
smallest member and its depth, which no other node shares.

A conversation owns the nodes whose smallest member it is: all from some depth on.
So a node's parent, children and leaves follow from one depth per conversation, and
sums over a subtree are sums over its members, which a second ROLLUP takes.

Turn ids have 96 bits of MD5. The node before a block is a running sum of 96-bit
hashes of position and turn, so no conversation is gathered into one row.

Defined results: a null role or text is empty. Turns are ordered by turn (null first),
then role, then text; repeated rows are turns of their own. Rows without conv_id belong to no
conversation. A conversation without turns is a member of the root only. An empty
table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.operators.skew import HOT_ROWS, join_one
from syncflow.staging import Staging

#: Turns in a block.
WIDTH = 8

KEY = "decimal(38,0)"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)


def _turn_id(role: Column, text: Column) -> Column:
    digest = F.md5(
        F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary")
    )
    high, low = (F.conv(F.substring(digest, at, 12), 16, 10) for at in (1, 13))
    return (high.cast("decimal(15,0)") * F.lit(1 << 48).cast("decimal(15,0)") + low.cast(
        "decimal(15,0)"
    )).cast(KEY)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, n_bytes) from (conv_id, turn, role, text); pos counts from 1."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), role, text
    )
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.row_number().over(order).cast("long").alias("pos"),
        _turn_id(role, text).alias("turn_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def share_openings(turns: DataFrame, convs: DataFrame, group: int, lengths: int) -> DataFrame:
    """Conversations that branch off others.

    Conversation c takes the first ``h`` turns of conversation ``c - c % group`` (all, if
    it has fewer; none, if it is absent), then its own turns after its first ``h``;
    ``h`` is the CRC-32 of c's decimal digits modulo ``lengths``.
    """
    c = F.col("conv_id")
    heads = convs.select(
        "conv_id",
        (c - c % group).alias("base"),
        (F.crc32(c.cast("string").cast("binary")) % lengths).alias("head"),
    )
    first = turns.where(F.col("pos") < lengths)
    taken = heads.join(first.withColumnRenamed("conv_id", "base"), "base").where(
        F.col("pos") <= F.col("head")
    )
    kept = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_taken"))
    own = (
        turns.join(heads, "conv_id")
        .where(F.col("pos") > F.col("head"))
        .join(kept, "conv_id", "left")
        .withColumn("pos", F.coalesce("n_taken", F.lit(0)) + F.col("pos") - F.col("head"))
    )
    columns = ["conv_id", "pos", "turn_id", "n_bytes"]
    return taken.select(*columns).unionByName(own.select(*columns))


def _blocks(turns: DataFrame, whole: DataFrame, width: int) -> DataFrame:
    """(conv_id, block, node, n_turns, total, t1 ... tk); turns carry their running key."""
    place = F.pmod(F.col("pos") - 1, F.lit(width))
    cells = [
        F.max(F.when(place == i, F.col("turn_id"))).alias(f"t{i + 1}") for i in range(width)
    ]
    filled = turns.groupBy(
        "conv_id", F.floor((F.col("pos") - 1) / width).cast("long").alias("block")
    ).agg(F.max(F.when(place == 0, F.col("key") - F.col("part"))).cast(KEY).alias("node"), *cells)
    none = F.lit(None).cast(KEY)
    empty = whole.where("n_turns = 0").select(
        "conv_id",
        F.lit(0).cast("long").alias("block"),
        F.lit(0).cast(KEY).alias("node"),
        *[none.alias(f"t{i + 1}") for i in range(width)],
    )
    return filled.unionByName(empty)


def _rolled_up(blocks: DataFrame, width: int, *sums: str) -> DataFrame:
    """A row for each node: smallest member, depth, members, longest member, and sums."""
    cells = [f"t{i + 1}" for i in range(width)]
    held = " + ".join(f"if({t} is null, 0, 1)" for t in cells)
    sums = "".join(f", sum({s}) as {s}" for s in sums)
    rolled = blocks.sparkSession.sql(
        f"""select block, {width} - bit_count(grouping_id()) as level, {held} as held,
                   min(conv_id) as conv_id, count(*) as n_convs, max(n_turns) as longest {sums}
            from {{blocks}}
            group by block, node, rollup({", ".join(cells)})""",
        blocks=blocks,
    )
    # A shorter conversation has no turn in the last columns that its group holds; and
    # the node before a block is counted with the block where it ends.
    real = (F.col("held") == F.col("level")) & ((F.col("block") == 0) | (F.col("level") > 0))
    depth = (F.col("block") * width + F.col("level")).cast("long")
    return rolled.where(real).withColumn("depth", depth).drop("block", "level", "held")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, as text; rows come sorted by node and id."""
    for batch in batches:
        if not batch.num_rows:
            continue
        owner, depth, conv = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "depth", "conv_id")
        )
        new = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
        starts = np.concatenate(([0], new))
        ends = np.concatenate((new, [len(conv)]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner[starts]),
                pa.array(depth[starts]),
                pa.array(conv[starts]),
                pa.array(
                    [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, ends)],
                    pa.string(),
                ),
            ],
            names=["owner", "depth", "first", "ids"],
        )


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids; runs come sorted by node and first id."""
    node, state = None, None
    for batch in batches:
        done = []
        for owner, depth, ids in zip(
            *(batch.column(c).to_pylist() for c in ("owner", "depth", "ids"))
        ):
            if (owner, depth) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (owner, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)],
        names=[name for name, _ in kinds],
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from (owner, depth, conv_id).

    A node may hold very many ends: their ids are joined in many tasks, by ranges, and
    one task hashes the joined runs one after the other, holding one at a time.
    """
    runs = (
        ends.repartitionByRange("owner", "depth", "conv_id")
        .sortWithinPartitions("owner", "depth", "conv_id")
        .mapInArrow(_joined_ids, "owner long, depth long, first long, ids string")
    )
    return (
        runs.repartition("owner", "depth")
        .sortWithinPartitions("owner", "depth", "first")
        .mapInArrow(_hashed_ids, "owner long, depth long, ends_sha256 string")
    )


def prefix_trie(
    turns: DataFrame, convs: DataFrame, *, width: int = WIDTH, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv_id, pos, turn_id, n_bytes).

    ``convs`` lists all conversations (conv_id), also those without turns. Each node has
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes of last turns that members share, summed over the
    subtree) and ``ends_sha256`` (of the ids of members that end there).
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    spark = turns.sparkSession
    staging = Staging(spark, "prefix-trie")
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    high, low = (
        F.shiftrightunsigned(F.xxhash64(F.lit(i), "pos", "turn_id"), 16).cast("decimal(15,0)")
        for i in (1, 2)
    )
    part = (high * F.lit(1 << 48).cast("decimal(15,0)") + low).cast("decimal(29,0)")
    turns = staging.write(
        turns.withColumn("part", part).select(
            "*",
            F.sum("part").over(so_far).cast(KEY).alias("key"),
            F.sum("n_bytes").over(so_far).alias("up_to"),
        ),
        "turns",
    )
    sizes = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum("n_bytes").alias("total")
    )
    zero = F.lit(0).cast("long")
    whole = staging.write(
        convs.join(sizes, "conv_id", "left").select(
            "conv_id",
            F.coalesce("n_turns", zero).alias("n_turns"),
            F.coalesce("total", zero).alias("total"),
        ),
        "conversations",
    )
    blocks = staging.write(
        _blocks(turns, whole, width).join(whole, "conv_id"), "blocks"
    )
    first = staging.write(_rolled_up(blocks, width), "nodes")
    top = first.where("depth = 0").first()
    if top is None:
        return spark.createDataFrame([], NODES)

    # What each conversation owns, and the node above: that of its parent if it owns
    # any, else that where it ends.
    owners = first.groupBy("conv_id").agg(
        F.min("depth").alias("from_depth"),
        F.max((F.col("depth") == F.col("longest")).cast("long")).alias("leaf"),
    )
    members = staging.write(
        whole.join(owners, "conv_id", "left").withColumn(
            "up_depth", F.coalesce(F.col("from_depth") - 1, F.col("n_turns"))
        ),
        "members",
    )
    owned = staging.write(
        turns.join(members.select("conv_id", "from_depth"), "conv_id")
        .where(F.col("pos") >= F.col("from_depth"))
        .select("conv_id", F.col("pos").alias("depth"), "key", "n_bytes", "up_to"),
        "owned",
    )
    sought = staging.write(
        turns.select("conv_id", F.col("pos").alias("up_depth"), "key", "up_to").join(
            members, ["conv_id", "up_depth"]
        ),
        "sought",
    )
    columns = ["conv_id", "n_turns", "total", "from_depth", "leaf", "up_depth", "up_conv", "own"]
    own = F.when(F.col("from_depth").isNull(), zero)
    above = join_one(
        sought,
        owned.select("key", F.col("depth").alias("up_depth"), F.col("conv_id").alias("up_conv")),
        ["key", "up_depth"],
        hot_rows=hot_rows,
        staging=staging,
    ).withColumn("own", own.otherwise(F.col("total") - F.col("up_to")))
    # Below the root no key is needed; the root itself has no node above.
    at_root = members.where("up_depth <= 0").withColumns(
        {
            "up_conv": F.when(F.col("up_depth") == 0, F.lit(top["conv_id"])).cast("long"),
            "own": own.otherwise(F.col("total")),
        }
    )
    members = staging.write(
        above.select(*columns)
        .unionByName(at_root.select(*columns))
        .withColumn("leaf", F.coalesce("leaf", zero)),
        "placed",
    )

    summed = _rolled_up(
        blocks.join(members.select("conv_id", "own", "leaf"), "conv_id"),
        width,
        "total",
        "own",
        "leaf",
    )
    has_node = F.col("from_depth").isNotNull()
    children = (
        members.where(has_node & (F.col("from_depth") > 0))
        .groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"))
        .agg(F.count(F.lit(1)).alias("branches"))
    )
    ends = _end_digests(
        members.select(
            F.when(has_node, F.col("conv_id")).otherwise(F.col("up_conv")).alias("owner"),
            F.col("n_turns").alias("depth"),
            "conv_id",
        )
    ).withColumnRenamed("owner", "conv_id")
    place = ["conv_id", "depth"]
    owner = members.select(
        "conv_id",
        "n_turns",
        "from_depth",
        "up_conv",
        F.col("total").alias("owner_total"),
        F.col("own").alias("owner_own"),
    )
    nodes = (
        summed.join(owner, "conv_id")
        .join(owned.select(*place, "n_bytes", "up_to"), place, "left")
        .join(children, place, "left")
        .join(ends, place, "left")
    )
    before = F.coalesce(F.col("up_to") - F.col("n_bytes"), zero)
    shared = F.col("total") - F.col("n_convs") * before
    distinct = F.col("own") - F.col("owner_own") + F.col("owner_total") - before
    goes_on = (F.col("n_turns") > F.col("depth")).cast("long")
    parent = F.when(F.col("depth") > F.col("from_depth"), F.col("conv_id")).otherwise(
        F.col("up_conv")
    )
    return nodes.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, parent).alias("parent_conv_id"),
        F.col("n_convs").cast("long").alias("n_convs"),
        (goes_on + F.coalesce("branches", zero)).alias("n_children"),
        F.col("leaf").alias("n_leaves"),
        (shared - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
