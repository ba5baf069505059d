"""Line deduplication over levelled sorted runs of line hashes.

A run is a parquet table sorted by line key that tells in how many documents a
key was found and the largest of their ids. Each batch of documents is reduced to its
keys and merged with the runs: keys that no run holds become a run of level 0, so
a key is in one run only; keys that a run holds become corrections of its
count and its largest id. When a level holds ``fanout`` runs they are compacted into one
run of the next level, so a key is rewritten only once per level. A line goes only if
enough documents hold it, whichever batch they came in. So lines are dropped when all
batches are in: all lines are joined once with the runs and their corrections, and a line
stays unless its key is common and another document is the last to hold it.

A line key is the line without the white space at both ends, with A-Z lower-cased.

Defined results: a null or empty text is one empty line. Every row counts as a
document, so repeated rows count each; all rows that carry the largest id keep
their lines. A null id is smaller than any id; if no holder has an id, all keep
their lines. Repeats inside a document count once and go or stay together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syncflow.staging import Staging

#: The characters `[\x20\x09-\x0D]`.
WHITE = " \t\n\x0b\x0c\r"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def key_hashes(text: Column, min_chars: int) -> Column:
    """The distinct hashed keys of a text's lines that are long enough."""
    keys = F.filter(
        F.transform(lines_of(text), line_key), lambda k: F.length(k) >= F.lit(min_chars)
    )
    return F.array_distinct(F.transform(keys, lambda k: F.unhex(F.md5(k.cast("binary")))))


class LineRuns:
    """Runs under one folder; ``levels[i]`` lists the runs of level ``i``.

    ``corrections`` has a table for each batch: what it adds to keys of earlier runs.
    """

    def __init__(self, staging: Staging, fanout: int = 4):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.staging, self.fanout = staging, fanout
        self.levels: list[list[DataFrame]] = []
        self.corrections: list[DataFrame] = []

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            # No key is in two runs: compacting sorts them into one, and counts nothing.
            rows = _all(self.levels[level]).sortWithinPartitions("key")
            self.levels[level] = []
            self._put(level + 1, self.staging.write(rows, f"run-{level + 1}"))

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Merge a batch of (key, doc_id), a row for each document and key."""
        found = batch.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        runs = self._runs()
        known = F.lit(False)
        if runs:
            held = _all(runs).select("key", F.lit(True).alias("held"))
            found = found.join(held.hint("merge"), "key", "left")
            known = F.col("held").isNotNull()
        merged = self.staging.write(
            found.select("key", "n_docs", "last_doc", known.alias("known")).sortWithinPartitions("key"),
            "batch",
        )
        if runs:
            self.corrections.append(merged.where("known").drop("known"))
        self._put(0, merged.where("not known").drop("known"))

    def merged(self) -> DataFrame:
        """All runs as one, with their corrections."""
        rows = _all([*self._runs(), *self.corrections])
        return rows.groupBy("key").agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
        )

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch whose key no run holds."""
        return batch.join(_all(self._runs()).select("key"), "key", "left_anti")


def _all(tables: list[DataFrame]) -> DataFrame:
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows


def _drop_lines(texts: pd.Series, keys: pd.Series, min_chars: int) -> Iterator[str | None]:
    for text, gone in zip(texts, keys, strict=True):
        if gone is None or text is None:
            yield None
            continue
        drop, kept = set(gone), []
        for line in text.split("\n"):
            key = line.strip(WHITE)
            if len(key) >= min_chars:
                digest = hashlib.md5(key.encode().lower(), usedforsecurity=False).digest()
                if digest in drop:
                    continue
            kept.append(line)
        yield "\n".join(kept) if kept else None


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``row`` (the input row), ``n_lines``, ``n_dropped`` and ``kept`` (the text left).

    ``n_lines`` counts before dropping. A document that loses all its lines has
    the empty text. Only narrow rows (key, id) are grouped; texts are shuffled
    once, to meet the keys their document loses.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "line-runs")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    found = staging.write(
        rows.select(
            "doc_id",
            F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch"),
            F.explode(key_hashes(F.col("text"), min_chars)).alias("key"),
        ),
        "lines",
    )
    runs = LineRuns(staging, fanout)
    for batch in range(batches):
        runs.add(found.where(F.col("batch") == batch).select("key", "doc_id"))
    common = staging.write(
        runs.merged().where((F.col("n_docs") >= min_docs) & F.col("last_doc").isNotNull()),
        "common",
    ).select("key", "last_doc")
    lost = (
        found.select("key", "doc_id")
        .join(common, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("lost_id"))
        .agg(F.collect_set("key").alias("lost"))
    )

    @F.pandas_udf("string")
    def dropped(texts: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series(list(_drop_lines(texts, keys, min_chars)), dtype=object)

    hit = F.col("lost").isNotNull()
    joined = rows.join(
        lost.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("lost_id")), "left"
    ).withColumn(
        "left_over", dropped(F.when(hit, F.coalesce("text", F.lit(""))), F.col("lost"))
    )
    before = F.size(lines_of(F.col("text")))
    after = F.when(F.col("left_over").isNull(), 0).otherwise(F.size(lines_of(F.col("left_over"))))
    return joined.select(
        "row",
        before.cast("long").alias("n_lines"),
        F.when(hit, before - after).otherwise(0).cast("long").alias("n_dropped"),
        F.coalesce(
            F.when(hit, F.coalesce("left_over", F.lit(""))), F.col("text"), F.lit("")
        ).alias("kept"),
    )
