from __future__ import annotations

import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from syncflow.llm import gumbel_pieces as g
from syncflow.llm.queries import VOCABULARY

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def vocabulary():
    return g.Vocabulary.load(VOCABULARY)


def all_paths(text, vocabulary):
    """Probability of every segmentation."""
    ids = {
        p.decode().replace(" ", g.SPACE): i
        for i, p in enumerate(vocabulary.pieces)
        if i >= vocabulary.first_byte + 256 and " " not in p.decode()[1:]
    }

    def cut(word, first=True):
        if not word:
            yield (), 0.0
            return
        single = word[0] in ids and (first or word[0] != g.SPACE)
        for n in range(1, len(word) + 1):
            piece = word[:n]
            if piece in ids and (first or g.SPACE not in piece) and g.SPACE not in piece[1:]:
                for rest, l in cut(word[n:], False):
                    yield (ids[piece], *rest), l + vocabulary.log_weight[ids[piece]]
        if not single:
            data = word[0].encode()
            for rest, l in cut(word[1:], False):
                weight = len(data) * vocabulary.log_weight[vocabulary.first_byte]
                yield (*(vocabulary.first_byte + b for b in data), *rest), l + weight

    paths = {(): 0.0}
    for word in text.split(" ") if text else []:
        paths = {a + b: x + y for a, x in paths.items() for b, y in cut(g.SPACE + word)}
    total = np.logaddexp.reduce(list(paths.values()))
    return {p: math.exp(x - total) for p, x in paths.items()}


@pytest.mark.parametrize("text", ["the cat", "a\nb é", "ab", "x▁y", "日本語の"])
def test_samples_without_replacement(vocabulary, text):
    p, n, k = all_paths(text, vocabulary), 8000, 3
    by_text = defaultdict(list)
    estimate = Counter()
    for i, rank, ids, log_prob, value, inclusion in g.sample_texts([text] * n, np.arange(n), vocabulary, k):
        path = tuple(ids.tolist())
        assert math.exp(log_prob) == pytest.approx(p[path], rel=1e-6)
        assert vocabulary.decode(path) == text
        assert 0 < inclusion <= 1
        by_text[i].append((path, value))
        estimate[path] += p[path] / inclusion / n
        assert rank == len(by_text[i])
    first, pairs = Counter(), Counter()
    for found in by_text.values():
        assert len({x for x, _ in found}) == len(found) == min(k, len(p))
        assert all(a[1] >= b[1] for a, b in zip(found, found[1:], strict=False))
        first[found[0][0]] += 1
        if len(found) > 1:
            pairs[found[0][0], found[1][0]] += 1
    top = sorted(p, key=p.get, reverse=True)[:3]
    for a in top:
        assert first[a] / n == pytest.approx(p[a], abs=0.02)
        # Weighted by inclusion, the samples estimate all probabilities.
        assert estimate[a] == pytest.approx(p[a], abs=0.03)
        for b in top:
            if a != b and p[a] < 1 - 1e-9:
                assert pairs[a, b] / n == pytest.approx(p[a] * p[b] / (1 - p[a]), abs=0.02)


TEXTS = [
    None, "", " ", "  two  spaces ", "▁ mark ▁▁", "tab\tnew\nline\r\n", "emoji 😀 ‰ \x00 é", "a" * 3000,
    "word " * 5000, "ü" * 50 + " " + "ß漢" * 40,
]


def test_round_trip_and_batches(vocabulary, monkeypatch):
    keys = np.arange(len(TEXTS))
    whole = [(i, r, ids.tolist(), x) for i, r, ids, _, x, _ in g.sample_texts(TEXTS, keys, vocabulary, 4)]
    for i, _, ids, _ in whole:
        assert vocabulary.decode(ids) == (TEXTS[i] or "")
    assert {i for i, *_ in whole} == set(range(len(TEXTS)))
    assert sum(i == 1 for i, *_ in whole) == 1
    # A row gives the same samples in any batch.
    monkeypatch.setattr(g, "GROUP_CHARS", 10)
    monkeypatch.setattr(g, "BUILD_WORDS", 3)
    again = []
    for at in reversed(range(len(TEXTS))):
        again += [(at, r, ids.tolist(), x) for _, r, ids, _, x, _ in g.sample_texts(TEXTS[at : at + 1], keys[at : at + 1], vocabulary, 4)]
    assert sorted(again) == sorted(whole)


def test_operator(spark, vocabulary):
    rows = [(i, t, 0, "x") for i, t in enumerate(TEXTS)] + [(None, "the cat", 0, "x"), (3, TEXTS[3], 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int, ids string")
    found = g.sample_segmentations(docs, vocabulary, F.col("doc_id").cast("string"), k=2)
    decoded = found.select("row.doc_id", "rank", "ids", g.decode_ids(F.col("ids"), vocabulary, spark).alias("t"))
    got = decoded.collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r["t"] == texts[r["doc_id"]] for r in got)
    assert {r["doc_id"] for r in got} == set(texts)
    twice = [r["ids"] for r in got if r["doc_id"] == 3 and r["rank"] == 1]
    assert len(twice) == 2 and twice[0] == twice[1]
    nothing = spark.createDataFrame([], docs.schema)
    assert g.sample_segmentations(nothing, vocabulary, F.col("doc_id").cast("string")).collect() == []
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in nulls.select(g.decode_ids(F.col("ids"), vocabulary, spark)).collect()] == [None, ""]


@pytest.mark.parametrize("text", ["a  b", " x", "a b   ", "   ", "é  ▁ b\n     c"])
def test_runs_of_blanks_against_the_whole_vocabulary(vocabulary, text):
    """All segmentations, pieces of several blanks included, and the model's own one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    first = vocabulary.first_byte
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p and i >= first + 256}

    def cut(rest):
        if not rest:
            yield (), 0.0
            return
        known = rest[0].encode() in ids
        for n in range(1, len(rest) + 1):
            i = ids.get(rest[:n].encode())
            if i is not None:
                for tail, l in cut(rest[n:]):
                    yield (i, *tail), l + vocabulary.log_weight[i]
        if not known:
            data = rest[0].encode()
            for tail, l in cut(rest[1:]):
                yield (*(first + b for b in data), *tail), l + len(data) * vocabulary.log_weight[first]

    # Blanks are read as such, so that the mark in a text has no piece.
    paths = dict(cut(" " + text))
    total = np.logaddexp.reduce(list(paths.values()))
    found = list(g.sample_texts([text], np.arange(1), vocabulary, len(paths) + 5))
    got = {tuple(ids.tolist()): log_prob for _, _, ids, log_prob, _, _ in found}
    assert len(found) == len(got) and set(got) == set(paths)
    assert all(inclusion == 1 for *_, inclusion in found)
    for path, log_prob in got.items():
        assert log_prob == pytest.approx(paths[path] - total, abs=1e-6)
        assert vocabulary.decode(path) == text
    if g.SPACE not in text:
        assert tuple(model.encode(text)) in got


def test_round_trip_is_checked_by_the_sampler(spark, vocabulary):
    texts = ["a text", "", None, "  two  blanks ", "ünïcode 你好 ▁ \x00", "long " * 2000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, ids string")
    found = g.sample_segmentations(docs, vocabulary, F.col("i"), verify=True)
    rows = found.select("row.i", "rank", "ids", "round_trip").collect()
    assert all(r["round_trip"] for r in rows) and {r["i"] for r in rows} == set(range(6))
    for r in rows:
        assert vocabulary.decode(r["ids"]) == (texts[r["i"]] or "")
    assert "round_trip" not in g.sample_segmentations(docs, vocabulary, F.col("i")).columns


def test_a_wrong_piece_is_noticed(vocabulary):
    spelling = g._Spelling(vocabulary.pieces)
    good = np.array([i for i, p in enumerate(vocabulary.pieces) if p == b" a"][:1], np.int32)
    offsets = np.array([0, 1, 2, 2], np.int32)
    flat = np.concatenate((good, good))
    assert g._decoded_right(flat, offsets, [0, 1, 2], ["a", "b", None], spelling) == [
        True, False, True,
    ]
