"""The periodic sync as a stream: new landing files in, keyed upsert out."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from syncflow.operators.audit import next_batch_id, tag_snapshot
from syncflow.plans.config import InboundConfig
from syncflow.plans.jobs import landed_schema, read_registry, sync_records
from syncflow.sinks.export import append_snapshot
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources import files
from syncflow.sources.tables import TableRef

#: Fixed value: the cadence of the periodic run.
CADENCE = "5 minutes"

Transform = Callable[[DataFrame], DataFrame]


def read_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    file_format: str = "json",
    max_files: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of the files that appear under ``landing``; each is read once."""
    reader = spark.readStream.schema(schema).format(file_format).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing)


def _start(stream: DataFrame, each: Callable, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it made this checkpoint.

    Micro-batches are numbered from 0 in every new checkpoint, so a batch number
    means something only together with this id.
    """
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def drop_repeats(
    stream: DataFrame, keys: Sequence[str], event_time: str, horizon: str
) -> DataFrame:
    """Leave out records whose ``keys`` came before, within ``horizon`` of event time.

    ``event_time`` is a timestamp column. Spark keeps a key as long as the watermark, which
    trails the newest event by ``horizon``, has not passed it; so the state is bounded by
    the keys of one horizon. Records older than the watermark are late and left out.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def stream_incremental(
    stream: DataFrame,
    target: KeyedTable,
    checkpoint: str,
    order: Sequence[str],
    writer: str = "stream",
    transform: Transform | None = None,
    null_policy: str = "overwrite",
    every: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into ``target``.

    Spark may run a micro-batch again after a crash. The target remembers the
    last batch of this checkpoint, so the repetition is skipped. ``every`` keeps
    the stream running (for instance ``CADENCE``); without it the stream takes
    what is there and stops.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        stream_id = checkpoint_id(target.spark, checkpoint)
        target.upsert(
            rows, order, null_policy, writer=f"{writer}:{stream_id}", batch=batch_id
        )

    return _start(stream, each, checkpoint, every)


def stream_snapshots(
    stream: DataFrame,
    snapshot: TableRef,
    checkpoint: str,
    transform: Transform | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append every micro-batch as a snapshot tagged with stream and batch id.

    A repeated micro-batch replaces its own partition.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        tagged = tag_snapshot(rows, batch_id).withColumn(
            "stream_id", F.lit(checkpoint_id(spark, checkpoint))
        )
        append_snapshot(tagged, snapshot, ["stream_id", "batch_id"])

    return _start(stream, each, checkpoint, every)


def stream_inbound(
    spark: SparkSession,
    cfg: InboundConfig,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """The inbound job over new landing files only.

    ``run_inbound`` reads the whole landing folder each time and drops what it
    took before by date. Here the checkpoint remembers the files, so every
    active record of a new file is taken, late ones too. Each micro-batch is
    one audited run. Its batch id is noted next to the checkpoint before
    anything is written; a repeated micro-batch replaces that batch.
    """
    cfg.validate()
    stream = read_landing(
        spark,
        cfg.landing,
        landed_schema(cfg),
        max_files=max_files,
        options={"multiLine": str(cfg.multi_line).lower()},
    )

    def each(batch: DataFrame, number: int) -> None:
        note = f"{checkpoint}/batch_ids/{checkpoint_id(spark, checkpoint)}-{number}"
        if not files.exists(spark, note):
            batch_id = next_batch_id(read_registry(spark, cfg), cfg.batch_columns).first()[0]
            files.publish_text(spark, note, str(batch_id))
        sync_records(spark, cfg, batch, late=True, batch_id=int(files.read_text(spark, note)))

    return _start(stream, each, checkpoint, every)
