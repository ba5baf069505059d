from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from syncflow.llm.line_runs import LineRuns, dedup_lines
from syncflow.staging import Staging

SCHEMA = "doc_id long, text string, kept string, key string"


def brute(rows, min_chars, min_docs):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    texts = [(i, (t or "").split("\n")) for i, t in rows]
    holders: dict[str, list] = {}
    for i, lines in texts:
        for k in {key(line) for line in lines}:
            holders.setdefault(k, []).append(i)
    out = []
    for i, lines in texts:
        kept = []
        for line in lines:
            k = key(line)
            ids = [x for x in holders[k] if x is not None]
            if len(k) >= min_chars and len(holders[k]) >= min_docs and ids and i != max(ids):
                continue
            kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LONG = "x" * 20_000 + "\n" + "\n".join(f"line {i % 50}" for i in range(2000))

ROWS = [
    (1, "Common line\nown 1\n\ncommon LINE  "),
    (2, "\tcommon line\r\nown 2\n"),
    (3, "common line"),
    (3, "common line"),
    (None, "common line\nnothing"),
    (None, None),
    (4, ""),
    (5, LONG),
    (6, LONG + "\nÉcole"),
    (7, "école\n\n"),
]


@pytest.mark.parametrize("min_chars,min_docs", [(4, 2), (4, 3), (0, 2), (40, 5)])
@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2)])
def test_against_brute_force(spark, min_chars, min_docs, batches, fanout):
    docs = spark.createDataFrame([(*r, "k", "q") for r in ROWS], SCHEMA)
    found = dedup_lines(docs, min_chars=min_chars, min_docs=min_docs, batches=batches, fanout=fanout)
    got = found.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS, min_chars, min_docs)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_are_compacted_and_sum_up(spark):
    runs = LineRuns(Staging(spark), fanout=2)
    for batch in range(5):
        runs.add(spark.createDataFrame([("a", batch), (f"b{batch}", batch)], "key string, doc_id long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # A key is in the run of the batch that brought it; later batches correct it.
    held = [r["key"] for level in runs.levels for run in level for r in run.collect()]
    assert sorted(held) == ["a", "b0", "b1", "b2", "b3", "b4"]
    assert [[tuple(r) for r in c.collect()] for c in runs.corrections] == [[("a", 1, i)] for i in range(1, 5)]
    merged = {r["key"]: (r["n_docs"], r["last_doc"]) for r in runs.merged().collect()}
    assert merged["a"] == (5, 4) and merged["b3"] == (1, 3)
    fresh = spark.createDataFrame([("a", 9), ("c", 9)], "key string, doc_id long")
    assert [r["key"] for r in runs.unseen(fresh).collect()] == ["c"]
    with pytest.raises(ValueError):
        LineRuns(Staging(spark), fanout=1)
    assert runs.merged().where(F.col("n_docs") > 1).count() == 1
