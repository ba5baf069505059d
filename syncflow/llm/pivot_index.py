"""Exact top-k search by inner product over a pivot-distance index.

Vectors are scaled to whole numbers. One more component, the root of what a
vector's square lacks to the largest square, brings all vectors to one length;
the larger the inner product with a query (which gets 0 there), the smaller the
distance. Every vector is keyed by its nearest pivot and its distance from it, and
the distances of a pivot are cut into annuli. Of each annulus the index knows between
which distances its members lie from every pivot, not from their own only. By the
triangle inequality no member is closer to a query than the query's distance from
any pivot lies outside of that interval; the widest such gap bounds the inner
products inside.

A search has two rounds. The first looks into each query's annuli of the highest
bounds. The second expands to all annuli whose bound reaches the k-th score of
the first, and stops there: the rest cannot hold a better one. Bounds keep a margin
for rounding, scores are computed in whole numbers, so results are exact.

Pivots come from a bounded sample (``sample_rows``, smallest hashes), all rows are
indexed. Annuli are tables of rows split into blocks of ``block_rows``; queries come
in blocks too, so a task never holds more than two blocks, however many rows are
alike. The annuli's bounds (two numbers for each annulus and pivot) are all the
driver and the queries see of the index.

Defined results: null vectors, and those with a null or non-finite component,
neither ask nor answer. Vectors of different dimension have no score. Rows
without id take no part. Rows of one id never answer each other; otherwise each
answers on its own. An id that asks with several vectors gets the best answers to
any of them. Scores are exact while they and all squares stay below 2**53. An empty
table, or no queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.staging import Staging

PIVOTS = 32
ANNULI = 8
SAMPLE_ROWS = 4096
BLOCK_ROWS = 4096
#: Annuli that the first round looks into, per query.
FIRST = 4
#: Different dimensions that may be indexed together.
MAX_DIMENSIONS = 64


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(
        vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")
    )


def usable(vector: Column) -> Column:
    bad = F.exists(
        vector,
        lambda x: x.isNull()
        | F.isnan(x.cast("double"))
        | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


@dataclass
class Pivots:
    """Per dimension: pivots (with the added component) and the largest square."""

    points: dict[int, np.ndarray]
    square: dict[int, float]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        squares = (vectors * vectors).sum(axis=1)
        extra = np.sqrt(np.maximum(self.square[vectors.shape[1]] - squares, 0))
        return np.concatenate([vectors, extra[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Points far from one another: each next one is the farthest from those chosen."""
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)):
        at = int(nearest.argmax())
        if nearest[at] <= 0:
            break
        chosen.append(at)
        nearest = np.minimum(nearest, _distances(sample, sample[at : at + 1])[:, 0])
    return sample[chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as float rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _by_dimension(batch: pa.RecordBatch, at: str = "v") -> Iterator[pa.RecordBatch]:
    lengths = pa.compute.list_value_length(batch[at]).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield batch.filter(pa.array(lengths == n))


def _assign(batches: Iterator[pa.RecordBatch], pivots: Pivots) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _by_dimension(whole):
            vectors = _matrix(batch["v"])
            distances = _distances(pivots.lifted(vectors), pivots.points[vectors.shape[1]])
            nearest = distances.argmin(axis=1)
            yield pa.record_batch(
                [
                    batch["id"],
                    batch["v"],
                    pa.array(np.full(len(batch), vectors.shape[1], np.int32)),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distances[np.arange(len(batch)), nearest]),
                ],
                ["id", "v", "dim", "pivot", "distance"],
            )


@dataclass
class Annuli:
    """The bounds of all annuli of a dimension, by number.

    ``low`` and ``high`` have a row for each annulus and a column for each pivot.
    """

    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray


def _intervals(batches: Iterator[pa.RecordBatch], pivots: Pivots) -> Iterator[pa.RecordBatch]:
    """Of each annulus in a batch: its rows, and the least and largest distances from all pivots."""
    for whole in batches:
        for batch in _by_dimension(whole):
            vectors = _matrix(batch["v"])
            distances = _distances(pivots.lifted(vectors), pivots.points[vectors.shape[1]])
            cells = batch["cell"].to_numpy()
            order = np.argsort(cells, kind="stable")
            found, begin, counts = np.unique(cells[order], return_index=True, return_counts=True)
            low, high = (f.reduceat(distances[order], begin) for f in (np.minimum, np.maximum))
            n_pivots = distances.shape[1]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(found) * n_pivots, vectors.shape[1], np.int32)),
                    pa.array(np.repeat(found, n_pivots).astype(np.int32)),
                    pa.array(np.tile(np.arange(n_pivots, dtype=np.int32), len(found))),
                    pa.array(low.ravel()),
                    pa.array(high.ravel()),
                    pa.array(np.repeat(counts, n_pivots)),
                ],
                ["dim", "cell", "pivot", "low", "high", "n"],
            )


@dataclass
class PivotIndex:
    """``rows``: ``id, v, dim, cell``, with ``cell`` the number of the annulus."""

    rows: DataFrame
    pivots: Pivots
    annuli: dict[int, Annuli] = field(default_factory=dict)


def build_index(
    vectors: DataFrame,
    staging: Staging,
    *,
    n_pivots: int = PIVOTS,
    n_annuli: int = ANNULI,
    sample_rows: int = SAMPLE_ROWS,
) -> PivotIndex:
    """Index a table (id, v) of whole-number vectors."""
    square = F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    facts = (
        vectors.groupBy(F.size("v").alias("dim"))
        .agg(F.max(square).alias("square"), F.count(F.lit(1)).alias("n"))
        .orderBy("dim")
        .limit(MAX_DIMENSIONS + 1)
        .collect()
    )
    if len(facts) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} dimensions")
    hashed = F.xxhash64("id", "v")
    points = {}
    pivots = Pivots(points, {r["dim"]: r["square"] for r in facts})
    for fact in facts:
        span = int((1 << 64) * min(1.0, 2.0 * sample_rows / fact["n"])) - (1 << 63) - 1
        rows = (
            vectors.where((F.size("v") == fact["dim"]) & (hashed <= F.lit(span)))
            .orderBy(hashed)
            .limit(sample_rows)
            .select("v")
            .collect()
        )
        sample = np.array([r["v"] for r in rows], np.float64).reshape(len(rows), fact["dim"])
        points[fact["dim"]] = choose_pivots(pivots.lifted(sample), n_pivots)
    if not facts:
        return PivotIndex(
            vectors.select("id", "v", F.lit(0).alias("dim"), F.lit(0).alias("cell")), pivots
        )
    keyed = staging.write(
        vectors.mapInArrow(
            lambda b: _assign(b, pivots),
            "id long, v array<long>, dim int, pivot int, distance double",
        ),
        "keyed",
    )
    cuts = F.percentile_approx(
        "distance", [i / n_annuli for i in range(1, n_annuli)], 1000
    )
    edges = keyed.groupBy("dim", "pivot").agg(cuts.alias("edges"))
    ring = F.size(F.filter("edges", lambda e: e < F.col("distance"))).alias("ring")
    ringed = keyed.join(F.broadcast(edges), ["dim", "pivot"]).select(
        "id", "v", "dim", (F.col("pivot") * n_annuli + ring).alias("cell")
    )
    ringed = staging.write(ringed, "ringed")
    index = PivotIndex(ringed, pivots)
    bounds = (
        ringed.mapInArrow(
            lambda b: _intervals(b, pivots),
            "dim int, cell int, pivot int, low double, high double, n long",
        )
        .groupBy("dim", "cell", "pivot")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    )
    for dim, own in bounds.toPandas().sort_values(["cell", "pivot"]).groupby("dim"):
        shape = (-1, len(points[int(dim)]))
        index.annuli[int(dim)] = Annuli(
            own["cell"].to_numpy().reshape(shape)[:, 0],
            own["low"].to_numpy().reshape(shape),
            own["high"].to_numpy().reshape(shape),
            own["n"].to_numpy().reshape(shape)[:, 0],
        )
    return index


def upper_bounds(queries: np.ndarray, index: PivotIndex) -> np.ndarray:
    """Bound of the scores of each query in each annulus."""
    dim = queries.shape[1]
    annuli, square = index.annuli[dim], index.pivots.square[dim]
    squares = (queries * queries).sum(axis=1)
    # Queries get 0 as the added component; their length is their own.
    lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    to_pivot = _distances(lifted, index.pivots.points[dim])
    gap = np.zeros((len(queries), len(annuli.number)))
    for p in range(to_pivot.shape[1]):
        off = to_pivot[:, p : p + 1]
        np.maximum(gap, np.maximum(off - annuli.high[:, p], annuli.low[:, p] - off), out=gap)
    slack = 1e-6 * (1 + np.sqrt(square + squares))[:, None]
    gap = np.maximum(gap - slack, 0)
    bound = (squares[:, None] + square - gap * gap) / 2
    return bound + 1e-9 * np.abs(bound) + 1e-3


def _visits(
    batches: Iterator[pa.RecordBatch], shape: tuple, first: int, again: bool
) -> Iterator[pa.RecordBatch]:
    """(query, v, dim, cell) of the annuli to look into."""
    index = PivotIndex(None, *shape)
    for whole in batches:
        for batch in _by_dimension(whole):
            queries = _matrix(batch["v"])
            annuli = index.annuli.get(queries.shape[1])
            if annuli is None:
                continue
            for at in range(0, len(queries), 1024):
                part = batch.slice(at, 1024)
                bounds = upper_bounds(queries[at : at + 1024], index)
                n_first = min(first, bounds.shape[1])
                order = np.argpartition(-bounds, n_first - 1, axis=1)[:, :n_first]
                start = np.zeros(bounds.shape, bool)
                np.put_along_axis(start, order, True, axis=1)
                if again:
                    least = part["least"].to_numpy(zero_copy_only=False)
                    least = np.where(np.isnan(least), -np.inf, least)
                    wanted = ~start & (bounds >= least[:, None])
                else:
                    wanted = start
                row, cell = np.nonzero(wanted)
                yield pa.record_batch(
                    [
                        part["id"].take(pa.array(row)),
                        part["v"].take(pa.array(row)),
                        pa.array(np.full(len(row), queries.shape[1], np.int32)),
                        pa.array(annuli.number[cell].astype(np.int32)),
                    ],
                    ["query_id", "v", "dim", "cell"],
                )


def _scores(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of one block for each query of another."""
    empty = pa.table(
        {"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
    )
    if not queries.num_rows or not rows.num_rows:
        return empty
    ids = rows["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    data = _matrix(rows["v"].combine_chunks())[order]
    asked = queries["query_id"].to_numpy()
    vectors = _matrix(queries["v"].combine_chunks())
    out = []
    for at in range(0, len(asked), 256):
        scores = vectors[at : at + 256] @ data.T
        scores[asked[at : at + 256, None] == ids] = -np.inf
        # Ties go to smaller ids: rows are in their order and the sort is stable.
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        row = np.repeat(np.arange(len(scores)), best.shape[1])
        value = scores[row, best.ravel()]
        fine = np.isfinite(value)
        out.append(
            (asked[at : at + 256][row][fine], ids[best.ravel()][fine], value[fine].astype(np.int64))
        )
    asked, ids, value = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"query_id": asked, "id": ids, "score": value})


def _search(
    visits: DataFrame, index: PivotIndex, k: int, block_rows: int, staging: Staging
) -> DataFrame:
    """The best rows of all visited annuli: block by block of queries and rows."""
    visits = staging.write(visits, "visits")
    n_rows = {
        (dim, int(c)): int(n)
        for dim, a in index.annuli.items()
        for c, n in zip(a.number, a.rows, strict=True)
    }
    n_asked = {
        (r["dim"], r["cell"]): r["count"] for r in visits.groupBy("dim", "cell").count().collect()
    }
    splits = pd.DataFrame(
        [
            (d, c, -(-n_rows[d, c] // block_rows), -(-n // block_rows))
            for (d, c), n in n_asked.items()
        ],
        columns=["dim", "cell", "row_blocks", "query_blocks"],
    )
    spark = visits.sparkSession
    plan = F.broadcast(
        spark.createDataFrame(splits, "dim int, cell int, row_blocks int, query_blocks int")
    )

    def some(n: Column, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), n).cast("int")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    asked = visits.join(plan, ["dim", "cell"]).select(
        "dim",
        "cell",
        some(F.col("query_blocks"), "query_id").alias("query_block"),
        every(F.col("row_blocks")).alias("row_block"),
        "query_id",
        "v",
    )
    rows = index.rows.join(plan, ["dim", "cell"]).select(
        "dim",
        "cell",
        every(F.col("query_blocks")).alias("query_block"),
        some(F.col("row_blocks"), "id", "v").alias("row_block"),
        "id",
        "v",
    )
    key = ["dim", "cell", "query_block", "row_block"]
    found = (
        asked.groupBy(*key)
        .cogroup(rows.groupBy(*key))
        .applyInArrow(lambda a, b: _scores(a, b, k), "query_id long, id long, score long")
    )
    return best_of(found, k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    k: int = 5,
    scale: int = 256,
    n_pivots: int = PIVOTS,
    n_annuli: int = ANNULI,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    first: int = FIRST,
) -> DataFrame:
    """``query_id, rank, id, score``: the k rows of the highest inner product with each query."""
    staging = Staging(vectors.sparkSession, "pivots")
    rows = staging.write(
        vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"),
            whole_numbers(F.col(vector_col), scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    index = build_index(
        rows.select("id", "v"),
        staging,
        n_pivots=n_pivots,
        n_annuli=n_annuli,
        sample_rows=sample_rows,
    )
    # A repeated id asks once per different vector.
    queries = rows.where("asks").select("id", "v").distinct()
    shape = (index.pivots, index.annuli)
    schema = "query_id long, v array<long>, dim int, cell int"
    near = queries.mapInArrow(lambda b: _visits(b, shape, first, False), schema)
    begun = staging.write(_search(near, index, k, block_rows, staging), "begun")
    least = begun.where(F.col("rank") == k).select(
        F.col("query_id").alias("l_id"), F.col("score").cast("double").alias("least")
    )
    open_queries = queries.join(least, F.col("id") == F.col("l_id"), "left").select(
        "id", "v", "least"
    )
    far = open_queries.mapInArrow(lambda b: _visits(b, shape, first, True), schema)
    rest = _search(far, index, k, block_rows, staging)
    columns = ["query_id", "id", "score"]
    return best_of(begun.select(*columns).unionByName(rest.select(*columns)), k).select(
        "query_id", "rank", "id", "score"
    )
