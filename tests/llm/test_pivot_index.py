from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from syncflow.llm.pivot_index import build_index, top_k, upper_bounds
from syncflow.staging import Staging

SCHEMA = "vec_id long, embedding array<float>, score long, id string"


def brute(rows, k, step):
    good = [
        (i, np.array([math.floor(256 * float(np.float32(x))) for x in v], dtype=np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {(q, tuple(a)) for q, a in good if q % step == 0}:
        near = sorted(
            (-int(np.dot(np.array(a, np.int64), b)), i) for i, b in good if i != q and len(b) == len(a)
        )
        out += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5, step=7, **how):
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    got = top_k(table, F.col("vec_id") % step == 0, k=k, **how).collect()
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got)


def vectors(n, dim, seed=0, clusters=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    v = centres[rng.integers(0, clusters, n)] + 0.3 * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize(
    "how",
    [
        {},
        {"n_pivots": 3, "n_annuli": 2, "first": 1, "block_rows": 16},
        {"n_pivots": 40, "n_annuli": 6, "sample_rows": 30, "first": 2},
    ],
)
def test_against_brute_force(spark, how):
    rows = vectors(300, 8)
    # Longer and shorter vectors, ties, and a large group of equal ones.
    rows += [(300 + i, [x * (1 + i % 5) for x in rows[i][1]]) for i in range(40)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]
    assert found(spark, rows, **how) == brute(rows, 5, 7)


def test_edge_cases(spark):
    rows = vectors(30, 4)
    rows += [(35, None), (42, [1.0, None, 0.0, 0.0]), (49, [float("nan")] * 4)]
    rows += [(None, [9.0] * 4), (56, [float("inf")] * 4), (63, [0.5, 0.5]), (64, [0.25, 1.0]), (70, [1.0])]
    rows += [(77, [0.0] * 4), (78, [0.0] * 4)]
    assert found(spark, rows) == brute(rows, 5, 7)
    assert found(spark, rows, k=100) == brute(rows, 100, 7)


def test_no_rows_and_no_queries(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.1])]) == []
    assert found(spark, [(7, [0.5, 0.5])]) == []


def share_opened(spark, rows, k=5):
    """Rows of annuli whose bound reaches a query's k-th score, of all; and that bounds hold."""
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows}
    table = spark.createDataFrame(
        [(i, [int(x) for x in v]) for i, v in whole.items()], "id long, v array<long>"
    )
    index = build_index(table, Staging(spark))
    data = np.array(list(whole.values()))
    cells = {r["id"]: r["cell"] for r in index.rows.collect()}
    queries = data[::20]
    bounds = upper_bounds(queries, index)
    annuli = index.annuli[data.shape[1]]
    at = np.searchsorted(annuli.number, [cells[i] for i in whole])
    scores = queries @ data.T
    assert (scores <= bounds[:, at]).all()
    least = np.sort(scores, axis=1)[:, -k - 1]
    return float(((bounds >= least[:, None]) * annuli.rows).sum() / (len(queries) * len(data)))


def test_annuli_are_skipped(spark):
    """Where vectors lie in groups, most rows are never scored."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(24, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    grouped = centres[rng.integers(0, 24, 2000)] + 0.02 * rng.normal(size=(2000, 16))
    assert share_opened(spark, list(enumerate(grouped.tolist()))) < 0.2
    # Without any structure there is nothing that a bound could tell apart.
    even = rng.normal(size=(500, 16))
    assert share_opened(spark, list(enumerate(even.tolist()))) <= 1
