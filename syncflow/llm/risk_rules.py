"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose statistic is above a cutoff. Cutoffs are chosen
from fixed grids by labelled holdouts, for all rules of a stratum together. The grids make
one fixed path, from settings that reject least to settings that reject most: each
step tightens one rule by one cutoff, all rules in turn. A step is admissible if
the share of good documents that any of its rules would reject has an exact
(Clopper-Pearson) upper confidence bound of at most the allowed risk. Steps are
tested in order, up to the first that is not admissible; the cutoffs of the step before
it are taken. As the path is fixed and each step rejects what those before it
reject, testing in sequence needs no correction for the number of steps. The
error probability is divided by the number of strata (Bonferroni), so with probability
1 - ``error`` no stratum loses more than ``risk`` of its good documents to all
rules together. A rule that the path has not reached rejects nothing there.

Defined results: words are `[^\\x20\\x09-\\x0D]+`. A null text has no words. A null
stratum is a stratum of its own. A document counts as good if it is labelled and
no label of its id is 0; labels without id or quality count for nothing; each row
of a repeated document counts. A statistic equal to the cutoff passes. Without
labels no rule rejects. An empty table has no rows and no cutoffs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow.staging import Staging

WHITE = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")

#: Words of a window that counts as repeated.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Share of good documents that all rules together may reject in a stratum.
RISK = 0.05
#: Probability that any promise fails.
ERROR = 0.05
#: Cutoffs of each rule, fixed before any label is seen.
GRIDS = {
    "symbol_share": (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "dup_line_share": (0.0, 0.05, 0.1, 0.2, 0.3, 0.5),
    "repeat_share": (0.0, 0.02, 0.05, 0.1, 0.2, 0.3),
    "upper_share": (0.05, 0.1, 0.2, 0.3, 0.5),
    "word_chars_mean": (10.0, 12.0, 15.0, 20.0, 30.0),
}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more, the first included.

    Windows get exact numbers by doubling: two halves' numbers make one pair.
    """
    n = len(ids)
    if n <= window:
        return 0
    numbers, length = ids.astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        pairs = (numbers[: len(numbers) - step] << 32) | numbers[step:]
        _, numbers = np.unique(pairs, return_inverse=True)
        length += step
    found = np.bincount(numbers)[numbers] > 1
    if not found.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(found)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = _WORD.findall(text)
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(WHITE):
            seen.add(line)
    repeat = 0
    if len(words) > WINDOW:
        numbers: dict[str, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        # Each word of a repeated window has come before.
        if len(words) - len(numbers) >= WINDOW:
            repeat = repeated_words(ids)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeat,
        len(_UPPER.findall(text)),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]


def count_texts(text: Column) -> Column:
    """The counts of a text column, as a struct."""

    @F.pandas_udf(", ".join(f"{c} long" for c in [*COUNTS, "n_lines"]))
    def counted(texts: pd.Series) -> pd.DataFrame:
        rows = [(*text_counts(t), 0 if t is None else t.count("\n") + 1) for t in texts]
        return pd.DataFrame(rows, columns=[*COUNTS, "n_lines"])

    return counted(text)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The statistic of each rule; null where there is nothing to divide by."""

    def per(count: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(count) / F.col(whole))

    return {
        "symbol_share": per("n_symbols", "word_chars"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "word_chars_mean": per("word_chars", "n_words"),
    }


# ---------------------------------------------------------------- exact bounds


def log_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) of a binomial variable, summed without loss."""
    if p <= 0 or k >= n:
        return 0.0
    if p >= 1:
        return -math.inf
    terms = (
        math.lgamma(n + 1)
        - math.lgamma(i + 1)
        - math.lgamma(n - i + 1)
        + i * math.log(p)
        + (n - i) * math.log1p(-p)
        for i in range(k, -1, -1)
    )
    largest, total = -math.inf, 0.0
    for term in terms:
        if term > largest:
            total = total * math.exp(largest - term) + 1 if total else 1.0
            largest = term
        else:
            total += math.exp(term - largest)
            # The terms fall off from the largest; the rest cannot matter.
            if term < largest - 45:
                break
    return min(0.0, largest + math.log(total))


def admissible(rejected: int, n: int, risk: float, error: float) -> bool:
    """Whether the exact upper bound of the rejection rate is at most ``risk``.

    The bound is below ``risk`` exactly if so few rejections would have a
    probability of at most ``error`` at that rate.
    """
    return n > 0 and rejected < n * risk and log_tail(rejected, n, risk) <= math.log(error)


def cutoff_path(grids: dict[str, tuple[float, ...]]) -> list[dict[str, float]]:
    """Settings (cutoff by rule) from the loosest on; each has one cutoff more, or a lower one."""
    path: list[dict[str, float]] = []
    current: dict[str, float] = {}
    for place in range(max(map(len, grids.values()), default=0)):
        for rule, grid in grids.items():
            if place < len(grid):
                current = {**current, rule: sorted(grid, reverse=True)[place]}
                path.append(current)
    return path


def last_admissible(rejected: list[int], n: int, risk: float, error: float) -> int:
    """How many steps of a path are admissible before the first that is not."""
    for step, k in enumerate(rejected):
        if not admissible(k, n, risk, error):
            return step
    return len(rejected)


def _chosen(
    frames: Iterator[pd.DataFrame], path: list[dict], rules: list[str], risk: float, error: float
) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = frame[[f"step_{i}" for i in range(len(path))]].to_numpy()
        chosen = [
            ({}, *path)[last_admissible(own.tolist(), int(n), risk, error)]
            for own, n in zip(counts, frame["n"])
        ]
        out = {rule: pd.array([c.get(rule) for c in chosen], "Float64") for rule in rules}
        yield pd.DataFrame({"stratum": frame["stratum"], **out})


def select_cutoffs(
    good: DataFrame,
    *,
    grids: dict[str, tuple[float, ...]] = GRIDS,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """``stratum`` and a cutoff per rule (null: none) from good documents.

    ``good`` has ``stratum`` and a column per rule. Counting is one aggregation; a
    row per stratum is left.
    """
    path = cutoff_path(grids)
    rejected = []
    for i, setting in enumerate(path):
        above = F.lit(False)
        for rule, cutoff in setting.items():
            above = above | F.coalesce(F.col(rule) > cutoff, F.lit(False))
        rejected.append(F.sum(F.when(above, 1).otherwise(0)).alias(f"step_{i}"))
    staging = Staging(good.sparkSession, "cutoffs")
    counts = staging.write(
        good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejected), "counts"
    )
    each = error / max(1, counts.count())
    rules = list(grids)
    schema = "stratum string, " + ", ".join(f"{rule} double" for rule in rules)
    return staging.write(
        counts.mapInPandas(lambda frames: _chosen(frames, path, rules, risk, each), schema),
        "cutoffs",
    )


@dataclass
class Verdicts:
    """``documents``: ``doc_id``, ``stratum``, counts, statistics, ``base_failed`` and
    ``kept``; ``cutoffs``: the table the verdicts were made with."""

    documents: DataFrame
    cutoffs: DataFrame


#: Up to so many strata, the cutoffs are broadcast.
FEW_STRATA = 10_000


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    quality_col: str = "quality",
    *,
    grids: dict[str, tuple[float, ...]] = GRIDS,
    risk: float = RISK,
    error: float = ERROR,
) -> Verdicts:
    """Count all texts, choose cutoffs by the labels, and judge every document."""
    staging = Staging(docs.sparkSession, "rules")
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        count_texts(F.col(text_col)).alias("counts"),
    ).select("doc_id", "stratum", "counts.*")
    counted = staging.write(
        counted.withColumns(statistics()).withColumn("base_failed", base_failed()), "counts"
    )
    marks = (
        labels.select(F.col(id_col).alias("l_id"), F.col(quality_col).alias("l_quality"))
        .where("l_id is not null and l_quality is not null")
        .groupBy("l_id")
        .agg(F.min("l_quality").alias("l_quality"))
        .where("l_quality <> 0")
    )
    # Only documents that the base rules pass can be lost to a cutoff.
    good = counted.where(~F.col("base_failed")).join(
        marks, F.col("doc_id") == F.col("l_id"), "left_semi"
    )
    cutoffs = select_cutoffs(
        good.select("stratum", *grids), grids=grids, risk=risk, error=error
    )
    limits = cutoffs.select(
        F.col("stratum").alias("c_stratum"), *[F.col(rule).alias(f"max_{rule}") for rule in grids]
    )
    if limits.count() <= FEW_STRATA:
        limits = F.broadcast(limits)
    rejects = F.lit(False)
    for rule in grids:
        rejects = rejects | F.coalesce(F.col(rule) > F.col(f"max_{rule}"), F.lit(False))
    documents = counted.join(
        limits, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left"
    ).withColumn("kept", ~F.col("base_failed") & ~rejects)
    return Verdicts(documents.drop("c_stratum"), cutoffs)
