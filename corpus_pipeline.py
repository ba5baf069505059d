"""A corpus, from raw documents to sampled token ids.

Each stage takes all that the one before it kept; what it returns is written as
parquet and read again as the input of the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from syncflow.llm import golay, gumbel_pieces, line_runs, ppm, schedule
from syncflow.llm.queries import VOCABULARY
from syncflow.staging import Staging


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or of doubtful language.

    If no document has both a language and a text, nothing can be learned; then all documents
    with letters stay.
    """
    model = ppm.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = ppm.identify(docs, model)
    return found.where((F.col("lang_pred") != ppm.UNKNOWN) & (F.col("score") >= 0.5)).select(
        "row.*"
    )


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts."""
    found = line_runs.dedup_lines(docs).select("row.*", F.col("kept").alias("kept\x00"))
    kept = F.col("`kept\x00`")
    return found.withColumns({"text": kept, "n_chars": F.length(kept).cast("long")}).drop(
        "kept\x00"
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: of the smallest id, then the smallest text hash.

    Rows without id come after all others of their group.
    """
    staging = Staging(spark, "near-copies")
    groups = staging.write(golay.near_duplicates(docs), "groups")
    who = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    least = groups.groupBy("root").agg(F.min(who).alias("least"))
    repeats = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = least.join(
        repeats,
        F.col("least.doc_id").eqNullSafe(F.col("doc_id"))
        & (F.col("least.text_hash") == F.col("text_hash")),
    ).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "n_rows")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")
    ).join(
        kept.hint("shuffle_hash"),
        F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")),
    )
    # Repeated rows are rare; only they are ranked.
    order = Window.partitionBy("id", "hash").orderBy(F.xxhash64("row"))
    ranked = rows.where("n_rows > 1").withColumn("place", F.row_number().over(order))
    return (
        rows.where("n_rows = 1")
        .select("row.*")
        .unionByName(ranked.where("place = 1").select("row.*"))
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents, as the mix takes them: 0, 1 or 2 times.

    Shares of a document are rounded. A source of which the mix takes something keeps at
    least the document that most is taken of, so that sources of few long documents stay.
    """
    staging = Staging(spark, "mix-stage")
    shares = staging.write(
        schedule.tokens_taken(schedule.mix_sources(docs))
        .groupBy("source_no", F.col("id").alias("t_id"), F.col("place").alias("t_place"))
        .agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
        .withColumn("times", F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")),
        "shares",
    )
    lost = (
        shares.groupBy("source_no")
        .agg(
            F.max("times").alias("times"),
            F.max(F.struct("taken", "t_id", "t_place")).alias("most"),
        )
        .where("times = 0 and most.taken > 0")
        .select("most.t_id", "most.t_place", F.lit(1).alias("times"))
    )
    taken = shares.where("times > 0").select("t_id", "t_place", "times").unionByName(lost)
    place = schedule.shuffled_place(F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), place.alias("p"))
    return (
        rows.join(
            taken.hint("shuffle_hash"),
            F.col("id").eqNullSafe(F.col("t_id")) & (F.col("p") == F.col("t_place")),
        )
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("row.*")
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three sampled segmentations of each document."""
    sampled = gumbel_pieces.sample_segmentations(
        docs.select("doc_id", "source", "lang", "text"),
        gumbel_pieces.Vocabulary.load(VOCABULARY),
        F.col("doc_id").cast("string"),
    )
    return sampled.select("row.*", "rank", "ids", "log_prob", "perturbed", "inclusion")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("mix", mix),
    ("encode", encode),
]

#: Hash functions and frozen statistics are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
