"""Which landed files were taken: a high watermark of files, committed with each run.

A run that reads a whole landing folder parses every page that ever landed. Here a run
lists the folder (names, times and lengths; no file is opened), leaves out what earlier
runs have taken, and notes the rest as its plan before it reads anything. A plan
that was not committed is taken up again as it is, with the batch id it was given, so
a run that dies and is repeated replaces its own batch.

``plans/<n>.json`` and ``commits/<n>.json`` are small notes; the files of a run are
rows of parquet under ``files/``. One run at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import instant
from syncflow.sources import files

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)

#: File lists that are merged into one when a run is committed.
MERGE_AFTER = 50


@dataclass(frozen=True)
class FileRun:
    """A planned run: its number, where its files are listed, and its batch id."""

    number: int
    folder: str
    batch_id: int


def landed_files(spark: SparkSession, landing: str, after: datetime | None = None) -> DataFrame:
    """(path, modified, length) of all files under ``landing``, none of which is opened.

    ``after`` leaves out files that were modified up to then, while they are listed.
    """
    if not files.exists(spark, landing):
        return spark.createDataFrame([], FILES)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if after is not None:
        reader = reader.options(
            modifiedAfter=after.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC"
        )
    return reader.load(landing).select(
        "path", F.col("modificationTime").alias("modified"), "length"
    )


class LandingManifest:
    """The manifest of one landing folder, kept under ``path``.

    ``lag`` bounds how long after its modification a file may appear in the folder: older
    files are not looked at again. Without it every listed file is compared with all files
    taken. A file that was replaced (another time or length) counts as new.
    """

    def __init__(self, spark: SparkSession, path: str, lag: timedelta | None = None):
        self.spark, self.path, self.lag = spark, path.rstrip("/"), lag

    def _numbers(self, kind: str) -> list[int]:
        names = files.list_names(self.spark, f"{self.path}/{kind}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _note(self, kind: str, number: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/{kind}/{number:08d}.json"))

    def _publish(self, kind: str, number: int, note: dict) -> None:
        files.publish_text(
            self.spark, f"{self.path}/{kind}/{number:08d}.json", json.dumps(note)
        )

    def _commit(self) -> dict:
        numbers = self._numbers("commits")
        return self._note("commits", numbers[-1]) if numbers else {"folders": [], "newest": None}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(*[f"{self.path}/files/{f}" for f in folders])

    def taken(self) -> DataFrame:
        """All files of committed runs."""
        return self._read(self._commit()["folders"])

    def _write(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/files/{folder}")
        return folder

    def plan(self, landing: str, batch_id: Callable[[], int]) -> FileRun:
        """The run to do now: the one that was not finished, or one over all new files."""
        plans, commits = self._numbers("plans"), self._numbers("commits")
        number = max(commits, default=0) + 1
        if number not in plans:
            commit, after = self._commit(), None
            if self.lag is not None and commit["newest"]:
                after = datetime.fromisoformat(commit["newest"]) - self.lag
            taken = self._read(commit["folders"])
            if after is not None:
                taken = taken.where(F.col("modified") >= instant(after))
            fresh = landed_files(self.spark, landing, after).join(taken, FILES.names, "left_anti")
            note = {"folder": self._write(fresh), "batch_id": batch_id()}
            self._publish("plans", number, note)
        note = self._note("plans", number)
        return FileRun(number, note["folder"], note["batch_id"])

    def paths(self, run: FileRun) -> list[str]:
        """The files of a run: what its reader has to open."""
        return [r[0] for r in self._read([run.folder]).select("path").collect()]

    def commit(self, run: FileRun) -> None:
        """The files of the run are taken."""
        before = self._commit()
        folders = [*before["folders"], run.folder]
        newest = self._read([run.folder]).agg(
            F.max(F.convert_timezone(None, F.lit("UTC"), F.col("modified")))
        )
        marks = [before["newest"], *[r[0].isoformat() for r in newest.collect() if r[0]]]
        if len(folders) > MERGE_AFTER:
            folders = [self._write(self._read(folders).coalesce(1))]
        note = {"folders": folders, "newest": max((m for m in marks if m), default=None)}
        self._publish("commits", run.number, note)
