"""Language identification by prediction by partial matching (PPM).

Each language gets a variable-order tree of byte contexts, at most ``ORDER``
bytes deep. A byte is coded in the longest context that was seen often enough;
if it never followed there, an escape is coded and the next shorter context takes
over, without the bytes that the longer one has ruled out. A context seen ``t``
times with ``d`` different followers gives a follower seen ``n`` times the
probability ``n / (t + d)`` and the escape ``d / (t + d)``. After the empty
context all 256 bytes are equally likely. Statistics are frozen after training, so
the code length of a byte depends on it and the three bytes before it alone, and
the probabilities after any context sum to one. The language with the shortest
code wins; its posterior probability under equal priors is the score.

Training counts come from a bounded sample: per language the ``train_docs``
labelled documents with the smallest hashes, whole. All else covers all rows.

Defined results: a text that is null or has no letter is ``und`` with score 0, as
is every text if nothing could be learned. Equal code lengths go to the smaller
language name. Repeated rows train and predict each. Input columns are kept
inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
ORDER = 3
#: Labelled documents per language that are counted.
TRAIN_DOCS = 1000
#: Contexts seen less often are left out of the trees.
MIN_CONTEXT = 2
#: Bytes that are scored at a time.
BLOCK = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")


def windows(data: np.ndarray) -> np.ndarray:
    """Each byte with the three before it as one number; zeros come before the first."""
    padded = np.concatenate([np.zeros(ORDER, np.uint8), data]).astype(np.uint32)
    n = len(data)
    return (
        (padded[:n] << 24) | (padded[1 : n + 1] << 16) | (padded[2 : n + 2] << 8) | padded[3 : n + 3]
    )


class _Table:
    """Sorted keys with columns of values."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        self.keys, self.columns = keys, columns

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys, and which of them are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


class ContextTree:
    """The frozen statistics of one language."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, min_context: int = MIN_CONTEXT):
        keys, n = grams.astype(np.int64), counts.astype(np.int64)
        self.followers: list[_Table] = []
        self.contexts: list[_Table] = []
        level = {}
        for k in range(ORDER, -1, -1):
            own = keys & ((1 << (8 * (k + 1))) - 1)
            follow, inverse = np.unique(own, return_inverse=True)
            level[k] = (follow, np.bincount(inverse, n, len(follow)).astype(np.int64))
        for k in range(ORDER + 1):
            follow, seen = level[k]
            context, inverse = np.unique(follow >> 8, return_inverse=True)
            total = np.bincount(inverse, seen, len(context)).astype(np.int64)
            kept = (total >= min_context) | (k == 0)
            distinct = np.bincount(inverse, minlength=len(context))
            if k:
                # What is left in the shorter context once these followers are ruled out.
                lower, lower_seen = level[k - 1]
                shorter = np.searchsorted(lower, follow & ((1 << (8 * k)) - 1))
                ruled = np.bincount(inverse, lower_seen[shorter], len(context)).astype(np.int64)
                at, _ = self.contexts[k - 1].find(context & ((1 << (8 * (k - 1))) - 1))
                rest = self.contexts[k - 1].columns[0][at] - ruled
                rest_distinct = self.contexts[k - 1].columns[1][at] - distinct
            else:
                rest = rest_distinct = np.zeros(len(context), np.int64)
            keep = kept[inverse]
            self.followers.append(_Table(follow[keep], seen[keep]))
            self.contexts.append(
                _Table(*(x[kept] for x in (context, total, distinct, rest, rest_distinct)))
            )

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window."""
        keys = keys.astype(np.int64)
        bits = np.zeros(len(keys))
        todo = np.arange(len(keys))
        # Of the context above, if it was used: what it leaves to the shorter one.
        entered = np.zeros(len(keys), bool)
        total, distinct = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for k in range(ORDER, -1, -1):
            own = keys[todo] & ((1 << (8 * (k + 1))) - 1)
            table = self.contexts[k]
            at, there = table.find(own >> 8)
            if not len(table.keys):
                continue
            t = np.where(entered[todo], total[todo], table.columns[0][at])
            d = np.where(entered[todo], distinct[todo], table.columns[1][at])
            place, hit = self.followers[k].find(own)
            hit &= there
            seen = self.followers[k].columns[0]
            bits[todo[hit]] += np.log2((t + d)[hit] / seen[place[hit]])
            escape = there & ~hit & (d > 0)
            bits[todo[escape]] += np.log2((t + d)[escape] / d[escape])
            total[todo[there]] = table.columns[2][at[there]]
            distinct[todo[there]] = table.columns[3][at[there]]
            entered[todo[there]] = True
            todo = todo[~hit]
        known = len(self.followers[0].keys)
        if known < 256:
            bits[todo] += np.log2(256 - known)
        return bits


@dataclass
class LanguageModel:
    """Trees of all languages, and the code lengths of all windows seen in training."""

    languages: list[str]
    trees: list[ContextTree]

    def __post_init__(self):
        seen = [t.followers[ORDER].keys for t in self.trees]
        keys = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        self.known = keys.astype(np.uint32)
        self.costs = [t.code_lengths(keys).astype(np.float32) for t in self.trees]
        # Where the windows that begin with the same two bytes are.
        self.first = np.searchsorted(keys, np.arange((1 << 16) + 1) << 16)
        self.depth = int(np.ceil(np.log2(max(1, np.diff(self.first).max(initial=1)) + 1)))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of windows among the known ones, or of a neighbour."""
        prefix = keys >> np.uint32(16)
        low, high = self.first[prefix], self.first[prefix + 1]
        for _ in range(self.depth):
            middle = (low + high) >> 1
            less = self.known[np.minimum(middle, len(self.known) - 1)] < keys
            less &= middle < high
            low = np.where(less, middle + 1, low)
            high = np.where(less, high, middle)
        return np.minimum(low, len(self.known) - 1)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language: texts x languages."""
        out = np.zeros((len(texts), len(self.languages)))
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            group.append(i)
            held += len(text)
            if held >= BLOCK or i == len(texts) - 1:
                self._add(texts, group, out)
                group, held = [], 0
        return out

    def _add(self, texts: list[bytes], group: list[int], out: np.ndarray) -> None:
        """Score a group of texts block by block."""
        if not len(self.known):
            return
        for i in group if len(group) == 1 else [None]:
            if i is not None:
                data = np.frombuffer(texts[i], np.uint8)
                for at in range(0, len(data), BLOCK):
                    before = min(at, ORDER)
                    keys = windows(data[at - before : at + BLOCK])[before:]
                    out[i] += [c.sum() for c in self._costs(keys)]
                return
        parts = [windows(np.frombuffer(texts[i], np.uint8)) for i in group]
        lengths = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(group)), lengths)
        for j, cost in enumerate(self._costs(np.concatenate(parts))):
            out[group, j] = np.bincount(owner, cost, len(group))

    def _costs(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        at = self.places(keys)
        new = np.flatnonzero(self.known[at] != keys)
        fresh, inverse = np.unique(keys[new], return_inverse=True)
        for tree, known in zip(self.trees, self.costs, strict=True):
            cost = known[at].astype(np.float64)
            if len(new):
                cost[new] = tree.code_lengths(fresh)[inverse]
            yield cost

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        has = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages or not has.any():
            return names, scores
        places = np.flatnonzero(has)
        bits = self.bits([texts[i].encode("utf-8", "replace") for i in places])
        best = bits.argmin(axis=1)
        lead = bits[np.arange(len(bits)), best][:, None] - bits
        scores[places] = 1 / np.exp2(np.maximum(lead, -1000)).sum(axis=1)
        for i, b in zip(places, best, strict=True):
            names[i] = self.languages[b]
        return names, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window counts per language of each batch."""
    for batch in batches:
        frame = batch.to_pandas()
        for language, rows in frame.groupby("lang"):
            parts = [windows(np.frombuffer(t.encode(), np.uint8)) for t in rows["text"] if t]
            if parts:
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch(
                    [pa.array([language] * len(grams)), pa.array(grams, pa.int64()), pa.array(n)],
                    ["lang", "gram", "n"],
                )


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    train_docs: int = TRAIN_DOCS,
    min_context: int = MIN_CONTEXT,
) -> LanguageModel:
    """Learn a tree per language from at most ``train_docs`` documents of each.

    (More only if rows repeat an id with the largest hash taken.) The driver gets
    the sampled hashes and the distinct windows of the sample.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(id_col).cast("string")).alias("h"),
        F.col(text_col).alias("text"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return LanguageModel([], [])
    # Hashes are uniform: this bound holds somewhat more than the wanted rows.
    span = 1 << 64
    bound = {
        r["lang"]: min(span - 1, int(span * 1.5 * (train_docs + 20) / r["n"])) - (1 << 63)
        for r in sizes
    }
    near = rows.select("lang", "h").where(_below(bound))
    ranked = near.groupBy("lang").agg(F.array_sort(F.collect_list("h")).alias("h"))
    cut = ranked.select("lang", F.slice("h", 1, train_docs).alias("h")).select(
        "lang", F.element_at("h", -1).alias("h")
    )
    cuts = {r["lang"]: r["h"] for r in cut.collect()}
    grams = (
        rows.where(_below(cuts))
        .select("lang", "text")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .to_pandas()
    )
    languages, trees = [], []
    for language, own in sorted(grams.groupby("lang"), key=lambda x: x[0].encode()):
        languages.append(language)
        trees.append(ContextTree(own["gram"].to_numpy(), own["n"].to_numpy(), min_context))
    return LanguageModel(languages, trees)


def _below(bound: dict[str, int]) -> Column:
    kept = F.lit(False)
    for language, most in bound.items():
        kept = kept | ((F.col("lang") == language) & (F.col("h") <= F.lit(most)))
    return kept


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``lang_pred`` and ``score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict([None if pd.isna(t) else t for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    found = docs.select(F.struct("*").alias("row"), predict(F.col(text_col)).alias("found"))
    return found.select("row", "found.lang_pred", "found.score")
