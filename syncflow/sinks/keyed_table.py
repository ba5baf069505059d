"""A parquet table that is upserted by key.

Plain parquet has no ``MERGE INTO``, and files that are being read must not be
overwritten. An upsert therefore writes its rows as a delta beside the table, so
that its cost follows the delta, and publishes one small commit record that
names what is current. Readers put the newest row of each key in place of the
older ones; they see the table before or after a commit, never in between.

The table itself is split into key-hash buckets. Compaction folds the deltas
into the buckets they touch; it runs when the caller says so, and after
``compact_after`` deltas, which bounds what readers have to merge.

One writer at a time. Readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import quoted
from syncflow.operators.key_filter import key_filter, may_match
from syncflow.operators.merge import NULL_POLICIES, classify_changes, dedup_latest, keyed_rows
from syncflow.sources import files
from syncflow.staging import Staging

_BUCKET, _VERSION = "_bucket", "_version"

#: Deltas whose keys readers broadcast, if each was measured to be small.
FEW_DELTAS = 4
#: Commit records that compaction leaves.
KEPT_COMMITS = 100


class KeyedTable:
    """``path`` holds ``commits/`` and ``data/``; ``buckets`` is fixed at creation.

    Choose ``buckets`` so that one bucket is a few gigabytes: it bounds the
    commit record and is the unit of rewriting. With ``compact_after=None`` only
    the caller compacts.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        compact_after: int | None = 16,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.compact_after = list(keys), compact_after
        self.buckets = self._commit().get("buckets", buckets)

    # -- commit records ---------------------------------------------------

    def _versions(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.path}/commits")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _commit(self, version: int | None = None) -> dict:
        versions = self._versions()
        if not versions:
            return {}
        name = f"{self.path}/commits/{version or versions[-1]:08d}.json"
        return json.loads(files.read_text(self.spark, name))

    def _publish(self, current: dict, deltas: list[dict], writers: dict[str, int]) -> None:
        version = max(self._versions(), default=0) + 1
        record = {
            "buckets": self.buckets, "current": current, "deltas": deltas, "writers": writers,
        }
        files.publish_text(
            self.spark, f"{self.path}/commits/{version:08d}.json", json.dumps(record)
        )

    def _new_folder(self) -> str:
        return f"{max(self._versions(), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"

    # -- reading ------------------------------------------------------------

    def _read_folders(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self.path}/data/{folder}" for folder in folders]
        )

    def _base(self, commit: dict) -> DataFrame:
        """The rows of a commit without its deltas."""
        return self._read_folders(sorted(commit.get("current", {}).values()))

    def read(self) -> DataFrame:
        """The table as of its newest commit."""
        commit = self._commit()
        base = self._base(commit)
        deltas = commit.get("deltas", [])
        if not deltas:
            return base
        changes, small = self._changes(deltas)
        return self._unchanged(base, changes, small).unionByName(changes)

    def _changes(self, deltas: Sequence[dict]) -> tuple[DataFrame, bool]:
        """The newest row of each key in the deltas, and whether the keys may be broadcast."""
        rows = None
        for number, delta in enumerate(deltas):
            own = self._read_folders([delta["folder"]]).withColumn(_VERSION, F.lit(number))
            rows = own if rows is None else rows.unionByName(own)
        if len(deltas) > 1:
            rows = dedup_latest(rows, self.keys, [_VERSION])
        small = len(deltas) <= FEW_DELTAS and all(d["small"] for d in deltas)
        return rows.drop(_VERSION), small

    def _unchanged(self, base: DataFrame, changes: DataFrame, small: bool) -> DataFrame:
        """Rows of the buckets whose key no delta has; null keys do not occur."""
        keys = changes.select(*[quoted(k) for k in self.keys])
        return base.join(F.broadcast(keys) if small else keys, self.keys, "left_anti")

    # -- writing ------------------------------------------------------------

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        hashed = F.xxhash64(*[quoted(k) for k in self.keys])
        return df.withColumn(_BUCKET, F.pmod(hashed, F.lit(self.buckets)).cast("int"))

    def upsert(
        self,
        source: DataFrame,
        order: Sequence[str] = (),
        null_policy: str = "overwrite",
        writer: str | None = None,
        batch: int | None = None,
        unique: bool = False,
        small: bool | None = None,
        compact: bool = False,
    ) -> bool:
        """Merge ``source`` in; the newest row by ``order`` wins within the source.

        ``unique`` promises one row per key. The source is written once and
        measured, unless ``small`` says that it is read from a written table
        and whether its rows may be broadcast. Old rows are read only to fill
        columns that the source lacks, or leaves null under ``keep``.
        ``compact`` folds all deltas in afterwards.

        A ``batch`` that ``writer`` has committed before is skipped, which makes
        redelivery harmless. Returns whether anything was committed.
        """
        if null_policy not in NULL_POLICIES:
            raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {null_policy!r}")
        commit = self._commit()
        deltas, writers = list(commit.get("deltas", [])), dict(commit.get("writers", {}))
        if writer is not None and batch is not None and writers.get(writer, -1) >= batch:
            return False

        with Staging(self.spark, "upsert") as staging:
            # Typed like the table first, so that equal keys hash and match alike.
            carried = [f for f in self.schema.fields if f.name in source.columns]
            typed = source.withColumns({f.name: quoted(f.name).cast(f.dataType) for f in carried})
            incoming = keyed_rows(typed, self.keys)
            if not unique:
                ordered_by = [c for c in order if c not in self.keys]
                incoming = dedup_latest(incoming, self.keys, ordered_by)
            incoming = incoming.select(*[quoted(f.name) for f in carried])
            if small is None:
                incoming, small = staging.write_checked(incoming, "incoming")
            found = not incoming.isEmpty()
            if found:
                whole = len(carried) == len(self.schema.fields) and null_policy == "overwrite"
                rows = incoming if whole else self._filled(
                    incoming, null_policy, small, staging
                )
                folder = self._new_folder()
                rows.select(*[quoted(f.name) for f in self.schema.fields]).write.parquet(
                    f"{self.path}/data/{folder}"
                )
                deltas.append({"folder": folder, "small": bool(small)})
        if writer is not None and batch is not None:
            writers[writer] = batch
        elif not found:
            return False
        self._publish(commit.get("current", {}), deltas, writers)
        if compact:
            self.compact()
        elif self.compact_after is not None and len(deltas) >= self.compact_after:
            self._relieve()
        return True

    def _relieve(self) -> None:
        """What is done about ``compact_after`` deltas."""
        self.compact()

    def _filled(
        self, incoming: DataFrame, null_policy: str, small: bool, staging: Staging
    ) -> DataFrame:
        """Incoming rows, completed by what the table holds under their keys."""
        old = self.read()
        if small:
            keys = incoming.select(*[quoted(k) for k in self.keys])
            old = old.join(F.broadcast(keys), self.keys, "left_semi")
        else:
            # Old rows that match nothing are not shuffled.
            old = may_match(old, self.keys, key_filter(incoming, self.keys, staging))
        others = [f.name for f in self.schema.fields if f.name not in self.keys]
        held = old.select(
            *[quoted(k) for k in self.keys], *[quoted(c).alias(f"_old_{c}") for c in others]
        )

        def value(name: str) -> Column:
            if name not in incoming.columns:
                return quoted(f"_old_{name}").alias(name)
            if null_policy == "keep":
                return F.coalesce(quoted(name), quoted(f"_old_{name}")).alias(name)
            return quoted(name)

        return incoming.join(held, self.keys, "left").select(
            *[quoted(k) for k in self.keys], *[value(c) for c in others]
        )

    def compact(self) -> bool:
        """Fold all deltas into the buckets they touch. Returns whether there were any."""
        commit = self._commit()
        current, deltas = dict(commit.get("current", {})), commit.get("deltas", [])
        if not deltas:
            return False
        with Staging(self.spark, "compact") as staging:
            changes, small = self._changes(deltas)
            if len(deltas) > 1:
                changes, small = staging.write_checked(changes, "changes")
            keyed = self._with_bucket(changes)
            # At most ``buckets`` numbers come to the driver.
            touched = [r[0] for r in keyed.select(_BUCKET).distinct().collect()]
            old = self._read_folders([current[str(b)] for b in touched if str(b) in current])
            kept = self._with_bucket(self._unchanged(old, changes, small))
            folder = self._new_folder()
            # Rebalancing splits large buckets and joins small ones, so file sizes
            # follow the advisory partition size.
            kept.unionByName(keyed).hint("rebalance", _BUCKET).write.partitionBy(
                _BUCKET
            ).parquet(f"{self.path}/data/{folder}")
            current.update({str(b): f"{folder}/{_BUCKET}={b}" for b in touched})
        self._publish(current, [], commit.get("writers", {}))
        for version in self._versions()[:-KEPT_COMMITS]:
            files.delete(self.spark, f"{self.path}/commits/{version:08d}.json")
        return True

    def changes(self, source: DataFrame) -> DataFrame:
        """``source`` with ``action``: what an upsert would do to each row."""
        return classify_changes(self.read(), source, self.keys)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data and commit records older than the newest ``keep`` commits.

        Folders of a commit that is still being written are newer than the
        newest commit and stay.
        """
        versions = self._versions()
        kept = versions[-keep:]
        live: set[str] = set()
        for commit in map(self._commit, kept):
            live.update(commit["current"].values())
            live.update(d["folder"] for d in commit["deltas"])
        removed = []
        for version in files.list_names(self.spark, f"{self.path}/data"):
            if version in live or int(version.split("-")[0]) > max(versions, default=0):
                continue
            names = files.list_names(self.spark, f"{self.path}/data/{version}")
            parts = [f"{version}/{n}" for n in names if n.startswith(f"{_BUCKET}=")]
            for folder in parts if any(p in live for p in parts) else [version]:
                if folder not in live:
                    files.delete(self.spark, f"{self.path}/data/{folder}")
                    removed.append(folder)
        for version in versions[:-keep]:
            files.delete(self.spark, f"{self.path}/commits/{version:08d}.json")
        return removed
