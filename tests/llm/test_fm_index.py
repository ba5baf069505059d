from __future__ import annotations

import random
import re

import numpy as np
import pytest

from syncflow.llm import fm_index
from syncflow.llm.fm_index import ShardIndex, decontaminate, index_texts, remove_spans, suffix_array

DOCS = "doc_id long, text string, id string, items string"
ITEMS = "item_id long, text string, row_no string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        said = words(text)
        for i in range(max(min(len(said), 1), len(said) - window + 1)):
            windows.setdefault(tuple(said[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        said, hit, told = words(text), set(), set()
        for w, holders in windows.items():
            for i in range(len(said) - len(w) + 1):
                if tuple(said[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    told |= holders
        out.append((doc, len(said), len(hit), sorted(str(t) for t in told if t is not None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_and_search(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(1, 4, rng.integers(0, 200)).astype(np.uint64) for _ in range(7)]
    texts += [texts[0], texts[1][5:], np.zeros(300, np.uint64)]
    k = len(texts)
    symbols = np.concatenate([np.append(t.astype(np.int64) + k, i) for i, t in enumerate(texts)])
    expected = sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    assert suffix_array(symbols).tolist() == expected
    index = ShardIndex(index_texts(texts))
    joined = np.concatenate([np.append(t.astype(np.int64), -1) for t in texts])
    phrases = rng.integers(0, 5, (300, 6)).astype(np.uint64)
    sizes = rng.integers(1, 7, 300)
    found = {p: (a, b) for p, a, b in zip(*index.search(phrases, sizes))}
    for p, size in enumerate(sizes):
        phrase = phrases[p, 6 - size :].astype(np.int64)
        places = [
            i
            for i in range(len(joined) - size + 1)
            if (joined[i : i + size] == phrase).all()
        ]
        assert (p in found) == bool(places)
        if places:
            low, high = (np.array([x]) for x in found[p])
            assert sorted(index.locate(low, high).tolist()) == places


def corpus(seed):
    rng = random.Random(seed)
    said = ["Alpha", "beta", "GAMMA", "dél", "été", "x1", "42", "ﬁn", "zz", "É"]
    items = [" ".join(rng.choices(said, k=rng.randint(1, 12))) for _ in range(12)]
    items += ["beta", "alpha, beta!", items[0], "", None, "...", "unheard of " * 4]
    docs = [" ".join(rng.choices(said, k=rng.randint(0, 60))) for _ in range(40)]
    docs += [f"intro {t} outro-{t}" for t in items[:10]] + [docs[0]] * 5 + ["", None, "...\n"]
    docs.append("\n".join(rng.choices(said, k=900)) + "\x00" + (items[5] or ""))
    docs.append("w" * 3_000_000 + " " + items[3])
    numbers = [*range(len(items) - 1), None]
    numbers[3] = 2
    return list(zip([3, *range(len(docs) - 1)], docs)), list(zip(numbers, items))


@pytest.mark.parametrize("window,shard,block", [(10, 1 << 20, 1 << 19), (3, 64, 20), (4, 200, 9)])
def test_against_brute_force(spark, window, shard, block):
    docs, items = corpus(window)
    found = decontaminate(
        spark.createDataFrame([(*d, "i", "j") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, "r") for i in items], ITEMS),
        window=window,
        shard_words=shard,
        block_words=block,
    )
    rows = found.select("id", "n_words", "n_hit", "items", "spans").collect()
    assert sorted((tuple(r)[:4] for r in rows), key=repr) == brute(docs, items, window)
    for row in rows:
        spans = [tuple(s) for s in row["spans"]]
        assert sum(b - a for a, b in spans) == row["n_hit"]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_items_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(fm_index, "PIECE_WORDS", 5)
    docs, items = corpus(1)
    cut = list(fm_index._item_pieces(3)(iter([])))
    assert cut == []
    found = decontaminate(
        spark.createDataFrame([(*d, "i", "j") for d in docs], DOCS),
        spark.createDataFrame([(*i, "r") for i in items], ITEMS),
        window=3,
    )
    got = sorted((tuple(r) for r in found.select("id", "n_words", "n_hit", "items").collect()), key=repr)
    assert got == brute(docs, items, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b")], ITEMS.rsplit(",", 1)[0])
    assert decontaminate(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a b", "", "")], DOCS)
    row = decontaminate(some, items.where("false")).first()
    assert (row["n_words"], row["n_hit"], row["spans"], row["items"]) == (2, 0, [], [])


def test_spans_are_removed(spark):
    docs = [
        (1, "Keep this. One TWO three, four! And that."),
        (1, "Keep this. One TWO three, four! And that."),
        (2, "é one two three four"),
        (None, "nothing here"),
        (4, None),
    ]
    items = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    clean = remove_spans(
        spark.createDataFrame([(*d, "i", "j") for d in docs], DOCS), items, window=4
    )
    assert clean.columns == ["doc_id", "text", "id", "items"]
    got = sorted((tuple(r)[:2] for r in clean.collect()), key=repr)
    cut = (1, "Keep this. ! And that.")
    assert got == sorted([cut, cut, (2, "é "), (None, "nothing here"), (4, None)], key=repr)


def test_settings_are_checked(spark):
    docs = spark.createDataFrame([], DOCS)
    with pytest.raises(ValueError):
        decontaminate(docs, docs, window=0)


def test_one_text_is_indexed_once():
    index = ShardIndex(index_texts([np.array([5, 6, 7], np.uint64)]))
    phrase, low, high = index.search(np.array([[6, 7]], np.uint64), np.array([2]))
    assert index.locate(low, high).tolist() == [1]
