"""A keyed table whose base Spark buckets by key, so that merges do not shuffle it.

``KeyedTable`` rewrites the buckets that a delta touches, which pays off while deltas touch
few of them. Where many keys change, all buckets are hit, and reading and compacting
shuffle the whole base. Here the base is one Spark table, bucketed and sorted by the key:
deltas are shuffled to its buckets and merged bucket by bucket, and a compaction writes
each bucket by the task that merged it.

The base is declared to the session's catalog as an external table, since bucketing is
known to Spark by the catalog only. The files and the commit record stay the truth:
a session that does not know the table declares it again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import quoted
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources import files
from syncflow.staging import SMALL_DECODED, SMALL_ON_DISK, decoded_bytes

#: Deltas are merged into the base when they have this share of its bytes.
COMPACT_SHARE = 0.2

_BASE = "base"


class BucketedTable(KeyedTable):
    """Like ``KeyedTable``, with a base of ``buckets`` Spark buckets.

    Choose ``buckets`` so that one is what a task can sort, a few hundred megabytes.
    After ``compact_after`` deltas they are folded into one, and into the base once they
    have ``compact_share`` of its bytes: what is rewritten follows what was changed.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        compact_after: int | None = 16,
        compact_share: float = COMPACT_SHARE,
    ):
        super().__init__(spark, path, schema, keys, buckets, compact_after)
        self.compact_share = compact_share

    def _name(self, folder: str) -> str:
        place = hashlib.md5(f"{self.path}/{folder}".encode(), usedforsecurity=False)
        return f"keyed_{place.hexdigest()}"

    def _location(self, folder: str) -> str:
        return f"{self.path}/data/{folder}"

    def _base(self, commit: dict) -> DataFrame:
        folder = commit.get("current", {}).get(_BASE)
        if folder is None:
            return self._read_folders([])
        name = self._name(folder)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(
                f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                for f in self.schema.fields
            )
            keys = ", ".join(f"`{k.replace('`', '``')}`" for k in self.keys)
            place = self._location(folder).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
                f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
                f" LOCATION '{place}'"
            )
        return self.spark.table(name)

    def _merged(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        """Each key's newest row, in the buckets of the base."""
        others = [f.name for f in self.schema.fields if f.name not in self.keys]
        arriving = changes.select(
            *[quoted(k) for k in self.keys],
            *[quoted(c).alias(f"_new_{c}") for c in others],
            F.lit(True).alias("_hit"),
        )
        joined = base.join(arriving, self.keys, "full_outer")
        return joined.select(
            *[
                quoted(f.name)
                if f.name in self.keys
                else F.when(F.col("_hit"), quoted(f"_new_{f.name}"))
                .otherwise(quoted(f.name))
                .alias(f.name)
                for f in self.schema.fields
            ]
        )

    def compact(self) -> bool:
        """Merge all deltas into a new base. Returns whether there were any."""
        commit = self._commit()
        deltas = commit.get("deltas", [])
        if not deltas:
            return False
        changes, _ = self._changes(deltas)
        if commit.get("current"):
            rows = self._merged(self._base(commit), changes)
        else:
            rows = changes.repartition(self.buckets, *[quoted(k) for k in self.keys])
        folder = self._new_folder()
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .option("path", self._location(folder))
            .saveAsTable(self._name(folder))
        )
        self._publish({_BASE: folder}, [], commit.get("writers", {}))
        return True

    def _relieve(self) -> None:
        commit = self._commit()
        size = lambda folder: files.size(self.spark, self._location(folder))
        base = commit.get("current", {}).get(_BASE)
        deltas = commit["deltas"]
        if base is None or sum(size(d["folder"]) for d in deltas) >= self.compact_share * size(base):
            self.compact()
            return
        changes, _ = self._changes(deltas)
        folder = self._new_folder()
        changes.write.parquet(self._location(folder))
        small = size(folder) <= SMALL_ON_DISK
        small = small and decoded_bytes(self._read_folders([folder])) <= SMALL_DECODED
        one = {"folder": folder, "small": small}
        self._publish(commit["current"], [one], commit.get("writers", {}))

    def vacuum(self, keep: int = 2) -> list[str]:
        """As of ``KeyedTable``; what is deleted is no longer declared either."""
        removed = super().vacuum(keep)
        for folder in removed:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(folder)}")
        return removed
