"""Quotation linking: from messages with quotes to conversations without.

Lines are parsed into quote levels (the number of `>` marks before them) and
grouped into passages: lines of one level without a blank line between. A
passage's key is a hash of its words, lower-cased and joined by single spaces.
Passages a message wrote itself (level 0) are indexed under the smallest id; quoted
passages are joined to that index, and count if the original comes before the
message that quotes it. A message replies to the original of its outermost linked
level: the one that most of that level's passages come from, the smallest id of
those. Roots and depths follow by pointer doubling. All steps are DataFrame
expressions; hot passages are reduced before they are joined.

Ids are one or more columns, in their order; a message's replies have larger ids.
Ordered by root, depth and id, every message comes after what it replies to.

Defined results: a null text is empty and has no passages. A message with a null
in its id neither replies nor is replied to. Messages that share an id are one
for linking, each keeps its own text. A line that introduces a quote ("On ... wrote:") and quotes are
left out of the message's own text; blank lines at its ends too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.operators.skew import HOT_ROWS, join_one
from syncflow.staging import Staging

#: Marks of a quoted line: each with up to one blank after it.
MARKS = r"^[\x20\t]{0,3}(?:>[\x20\t]?)+"
INTRODUCTION = r"(?i)^on .*wrote:\s*$"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_lines(text: Column) -> Column:
    """Lines as (level, content)."""

    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, MARKS, 0)
        return F.struct(
            F.length(F.translate(marks, " \t", "")).alias("level"),
            F.substring(raw, F.length(marks) + 1, F.length(raw)).alias("content"),
        )

    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "\r", "")
    return F.transform(F.split(plain, "\n", -1), line)


def is_blank(content: Column) -> Column:
    return ~content.rlike(r"\S")


def normalised(content: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(content, r"\s+", " ")))


def passages(lines: Column) -> Column:
    """(level, key) of each passage, in order."""

    def begins(lines: Column, i: Column) -> Column:
        here, before = F.get(lines, i), F.get(lines, i - 1)
        return ~is_blank(here["content"]) & (
            (i == 0) | is_blank(before["content"]) | (before["level"] != here["level"])
        )

    def passage(lines: Column, starts: Column):
        def one(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(lines))
            content = F.transform(
                F.slice(lines, start + 1, end - start), lambda line: line["content"]
            )
            words = normalised(F.array_join(content, " "))
            return F.struct(
                F.get(lines, start)["level"].alias("level"),
                F.md5(words.cast("binary")).alias("key"),
            )

        return one

    def of(lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        return _let(
            F.filter(numbers, lambda i: begins(lines, i)),
            lambda starts: F.transform(starts, passage(lines, starts)),
        )

    return _let(lines, of)


def own_text(lines: Column) -> Column:
    """The lines of level 0, without introductions of quotes."""

    def of(lines: Column) -> Column:
        def own(line: Column, i: Column) -> Column:
            introduces = line["content"].rlike(INTRODUCTION) & (
                F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0
            )
            return (line["level"] == 0) & ~introduces

        kept = F.array_join(F.transform(F.filter(lines, own), lambda line: line["content"]), "\n")
        return F.regexp_replace(kept, r"^(?:[^\S\n]*\n)++|(?:\n[^\S\n]*+)++$", "")

    return _let(lines, of)


def _in_own_box(found: DataFrame, box_cols: list[str]) -> DataFrame:
    """Quoted passages with ``near``, the last earlier message of their box that wrote them."""
    if not box_cols:
        none = F.lit(None).cast(found.schema["id"].dataType)
        return found.where("level > 0").withColumn("near", none)
    # Only smaller ids count, so that a message which quotes itself has no link to itself.
    same = Window.partitionBy("key", *[F.col(f"id.{c}") for c in box_cols])
    placed = found.withColumn("place", F.dense_rank().over(same.orderBy("id")))
    earlier = same.orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("level") == 0, F.col("id"))).over(earlier)
    return placed.withColumn("near", last).where("level > 0").drop("place")


def link_quotes(
    messages: DataFrame,
    id_cols: list[str],
    text_col: str = "text",
    *,
    n_box: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``id``, ``own_text``, ``parent``, ``root``, ``depth``, ``n_quoted`` and ``n_linked``.

    Ids are structs of ``id_cols``; ``parent`` is null for roots. ``n_quoted`` counts
    quoted passages, ``n_linked`` those with an original. The first ``n_box`` columns
    name the box of a message; all but the last, unless told.
    """
    staging = Staging(messages.sparkSession, "quotes")
    parsed = messages.select(
        F.struct(*[F.col(c).alias(c) for c in id_cols]).alias("id"),
        parse_lines(F.col(text_col).cast("string")).alias("lines"),
    ).select(
        "id",
        own_text(F.col("lines")).alias("own_text"),
        passages(F.col("lines")).alias("passages"),
    )
    parsed = staging.write(parsed, "parsed")
    whole = F.lit(True)
    for c in id_cols:
        whole = whole & F.col(f"id.{c}").isNotNull()
    found = parsed.where(whole).select("id", F.explode("passages").alias("p")).select(
        "id", "p.level", "p.key"
    )
    # Repeats within a message are counted before anything is put in order.
    found = staging.write(
        found.groupBy("id", "level", "key").agg(F.count(F.lit(1)).alias("n")), "passages"
    )
    box_cols = id_cols[: len(id_cols) - 1 if n_box is None else n_box]
    quotes = staging.write(_in_own_box(found, box_cols), "quotes")
    far = quotes.where("near is null")
    # Only what is quoted from elsewhere needs the first holder of all.
    asked = far.select("key").distinct()
    first = (
        found.where("level = 0")
        .join(asked, "key", "left_semi")
        .groupBy("key")
        .agg(F.min("id").alias("first"))
    )
    first = staging.write(first, "originals")
    elsewhere = join_one(far, first, ["key"], hot_rows=hot_rows, staging=staging).where(
        F.col("first") < F.col("id")
    )
    linked = staging.write(
        quotes.where("near is not null")
        .select("id", "level", "n", F.col("near").alias("original"))
        .unionByName(elsewhere.select("id", "level", "n", F.col("first").alias("original")))
        .groupBy("id", "level", "original")
        .agg(F.sum("n").alias("n")),
        "linked",
    )
    parents = linked.groupBy("id").agg(
        F.min(F.struct("level", -F.col("n"), "original"))["original"].alias("parent"),
        F.sum("n").alias("n_linked"),
    )
    parents = staging.write(parents, "parents")
    threads = _threads(parents.select("id", "parent"), staging)
    joined = (
        parsed.select(
            "id",
            "own_text",
            F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_quoted"),
        )
        .join(parents.withColumnRenamed("id", "p_id"), F.col("id") == F.col("p_id"), "left")
        .join(threads.withColumnRenamed("id", "t_id"), F.col("id") == F.col("t_id"), "left")
    )
    return joined.select(
        "id",
        "own_text",
        "parent",
        F.coalesce("root", F.when(whole, F.col("id"))).alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "n_quoted",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )


def _threads(replies: DataFrame, staging: Staging) -> DataFrame:
    """``id, root, depth`` of all replies, by doubling the way to an ancestor.

    A way whose end is a root is finished and not joined again. Both sides of each join are
    tables, so Spark can split the task of a message that very many ways lead to.
    """
    known = replies.select(F.col("id").alias("a_id"))
    ends = F.col("a_id").isNull()
    ways = staging.write(
        replies.join(known, F.col("parent") == F.col("a_id"), "left").select(
            "id", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"), ends.alias("done")
        ),
        "ways",
    )
    while not ways.where("not done").isEmpty():
        above = ways.select(
            F.col("id").alias("a_id"),
            F.col("up").alias("a_up"),
            F.col("steps").alias("a_steps"),
            F.col("done").alias("a_done"),
        )
        further = ways.where("not done").join(above, F.col("up") == F.col("a_id"))
        ways = staging.write(
            ways.where("done").unionByName(
                further.select(
                    "id",
                    F.col("a_up").alias("up"),
                    (F.col("steps") + F.col("a_steps")).alias("steps"),
                    F.col("a_done").alias("done"),
                )
            ),
            "ways",
        )
    return ways.select("id", F.col("up").alias("root"), F.col("steps").alias("depth"))


def conversations(linked: DataFrame) -> DataFrame:
    """Messages of ``link_quotes`` in reply order, sorted by conversation.

    The order is by ranges, so a long conversation may span partitions.
    """
    return linked.repartitionByRange("root", "depth", "id").sortWithinPartitions(
        "root", "depth", "id"
    )


def quoted(text: Column, level: int) -> Column:
    """A text as quoted at a level; empty for null or an empty text."""
    marks = ">" * level + " "
    return F.when(
        F.length(text) > 0,
        F.concat(F.regexp_replace(F.concat(F.lit("\n"), text), "\n", "\n" + marks), F.lit("\n\n")),
    ).otherwise("")


def as_mailbox(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, text) as messages that quote the two turns before them.

    Repeated turns quote, and are quoted, with their smallest text.
    """
    known = (
        turns.where("conv_id is not null and turn is not null")
        .groupBy("conv_id", "turn")
        .agg(F.min("text").alias("said"))
    )

    def before(n: int) -> DataFrame:
        return known.select(
            F.col("conv_id").alias(f"c{n}"),
            (F.col("turn") + n).alias(f"t{n}"),
            F.col("said").alias(f"before{n}"),
        )

    joined = turns
    for n in (1, 2):
        joined = joined.join(
            before(n),
            (F.col("conv_id") == F.col(f"c{n}")) & (F.col("turn") == F.col(f"t{n}")),
            "left",
        )
    body = F.concat(
        quoted(F.col("before2"), 2),
        quoted(F.col("before1"), 1),
        F.coalesce("text", F.lit("")),
    )
    return joined.select("conv_id", "turn", F.trim(body).alias("text"))
