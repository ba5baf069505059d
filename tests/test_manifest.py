from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from syncflow.sources import manifest as manifests
from syncflow.sources.manifest import LandingManifest, landed_files


def land(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)
    return path


def names(manifest, run):
    return sorted(p.rsplit("/", 1)[1] for p in manifest.paths(run))


def test_runs_take_new_files_only(spark, folder):
    landing, manifest = folder("landing"), LandingManifest(spark, folder("manifest"))
    empty = manifest.plan(landing, lambda: 1)
    assert manifest.paths(empty) == []
    manifest.commit(empty)
    land(landing, "a.json", "{}")
    land(landing, "deep/b.json", "{}")
    land(landing, "_SUCCESS", "")
    first = manifest.plan(landing, lambda: 7)
    assert names(manifest, first) == ["a.json", "b.json"]
    # Not committed: the plan stands, whatever has landed since.
    land(landing, "c.json", "{}")
    again = LandingManifest(spark, folder("manifest")).plan(landing, lambda: 99)
    assert again == first and first.batch_id == 7
    manifest.commit(again)
    second = manifest.plan(landing, lambda: 8)
    assert names(manifest, second) == ["c.json"] and second.number == first.number + 1
    manifest.commit(second)
    assert manifest.taken().count() == 3


def test_a_replaced_file_is_new(spark, folder):
    landing, manifest = folder("landing"), LandingManifest(spark, folder("manifest"))
    land(landing, "a.json", "{}")
    manifest.commit(manifest.plan(landing, lambda: 1))
    land(landing, "a.json", '{"more": 1}')
    assert names(manifest, manifest.plan(landing, lambda: 2)) == ["a.json"]


def test_lag_bounds_what_is_looked_at(spark, folder):
    landing = folder("landing")
    path = land(landing, "new.json", "{}")
    old = land(landing, "old.json", "{}")
    os.utime(path, (1_700_000_000, 1_700_000_000))
    os.utime(old, (1_600_000_000, 1_600_000_000))
    manifest = LandingManifest(spark, folder("manifest"), timedelta(days=1))
    run = manifest.plan(landing, lambda: 1)
    assert names(manifest, run) == ["new.json", "old.json"]
    manifest.commit(run)
    for name, age in (("late.json", 3600), ("too_late.json", 10 * 86_400)):
        os.utime(land(landing, name, "{}"), (1_700_000_000 - age,) * 2)
    assert names(manifest, manifest.plan(landing, lambda: 2)) == ["late.json"]
    whole = LandingManifest(spark, folder("manifest"))
    assert whole.taken().count() == 2


def test_lists_are_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(manifests, "MERGE_AFTER", 2)
    landing, manifest = folder("landing"), LandingManifest(spark, folder("manifest"))
    for i in range(5):
        land(landing, f"{i}.json", "{}")
        run = manifest.plan(landing, lambda: 1)
        assert names(manifest, run) == [f"{i}.json"]
        manifest.commit(run)
    assert manifest.taken().count() == 5
    with open(os.path.join(folder("manifest"), "commits", "00000005.json")) as note:
        assert len(json.load(note)["folders"]) <= 2


def test_listing_opens_no_file(spark, folder):
    path = land(folder("landing"), "a.json", "text")
    rows = landed_files(spark, folder("landing"))
    assert "content" not in rows.columns
    assert rows.select(F.col("length")).first()[0] == 4
    os.chmod(path, 0o000)
    assert rows.count() == 1
    assert landed_files(spark, folder("nowhere")).count() == 0


@pytest.mark.parametrize("records", [[{"Id": "1", "CreatedDate": 5, "More": {"x": [1, None]}}]])
def test_note_survives_odd_names(spark, folder, records):
    landing, manifest = folder("landing"), LandingManifest(spark, folder("manifest"))
    land(landing, "a b%20ä.json", json.dumps(records[0]))
    run = manifest.plan(landing, lambda: 1)
    assert spark.read.json(manifest.paths(run)).count() == 1
