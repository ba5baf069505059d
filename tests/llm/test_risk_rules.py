from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from syncflow.llm import risk_rules as rr


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


RNG = random.Random(3)
TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a " * 9, "a " * 8, "x y " * 30,
    "p q r s t u v w\np q r s t u v w\n\n\x0b\n \n", "# $a\xa0b é|<>\x1c c",
    *(" ".join(RNG.choice("ab") for _ in range(RNG.randint(8, 60))) for _ in range(30)),
    *("\n".join(RNG.choice(["a b c d e f g h i", "x", "", " "]) for _ in range(9)) for _ in range(9)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert rr.text_counts(text)[:5] == brute_counts(text)


def test_long_text():
    words = [str(i) for i in range(50_000)]
    assert rr.text_counts(" ".join(words))[4] == 0
    assert rr.text_counts(" ".join(words + words[100:120]))[4] == 40


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (10, 3, 0.2), (500, 7, 0.01), (2000, 60, 0.05)])
def test_tail_is_exact(n, k, p):
    exact = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert math.exp(rr.log_tail(k, n, p)) == pytest.approx(exact, rel=1e-9)


def test_tail_limits():
    assert rr.log_tail(5, 5, 0.5) == 0 and rr.log_tail(0, 5, 0.0) == 0
    assert not rr.admissible(0, 0, 0.1, 0.05)
    assert rr.admissible(0, 100, 0.05, 0.05) and not rr.admissible(0, 50, 0.05, 0.05)


def test_promise_holds():
    """The share of runs with a broken promise stays below the error."""
    rng = np.random.default_rng(0)
    grid, risk, error, broken = np.linspace(0, 1, 11), 0.1, 0.1, 0
    for _ in range(300):
        sample = rng.random(200)
        chosen = next(
            (c for c in grid if rr.admissible(int((sample > c).sum()), 200, risk, error / 11)), None
        )
        broken += chosen is not None and 1 - chosen > risk + 1e-12
    assert broken / 300 < error


def test_path_is_nested():
    path = rr.cutoff_path(rr.GRIDS)
    assert len(path) == sum(map(len, rr.GRIDS.values()))
    for before, after in zip([{}, *path], path):
        changed = [r for r in after if after[r] != before.get(r)]
        assert len(changed) == 1 and after[changed[0]] < before.get(changed[0], math.inf)
        assert set(before) <= set(after)
    assert path[-1] == {rule: min(grid) for rule, grid in rr.GRIDS.items()}


def test_joint_promise_holds():
    """All rules and strata together: the share of runs with any broken promise."""
    rng = np.random.default_rng(1)
    grids = {r: tuple(np.linspace(0.0, 0.9, 10)) for r in "abc"}
    path, risk, error, strata, broken, found = rr.cutoff_path(grids), 0.1, 0.1, 4, 0, 0
    true = [1 - math.prod(max(0.0, c) ** 0.5 for c in setting.values()) for setting in path]
    for _ in range(300):
        any_broken = False
        for _ in range(strata):
            sample = rng.random((250, 3)) ** 2
            rejected = [
                int(np.any([sample[:, "abc".index(r)] > c for r, c in setting.items()], axis=0).sum())
                for setting in path
            ]
            steps = rr.last_admissible(rejected, 250, risk, error / strata)
            found += steps > 0
            any_broken |= steps > 0 and true[steps - 1] > risk + 1e-12
        broken += any_broken
    assert found and broken / 300 < error


def documents(n):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
        good = i % 4 > 0
        if not good:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), "ab"[i % 2] if i % 10 else None, False, 1))
        if i % 3:
            labels.append((i, int(good), "x"))
    return rows, labels


DOCS = "doc_id long, text string, lang string, kept boolean, n_words int"


def test_judge(spark):
    rows, labels = documents(3000)
    rows += [(None, None, "a", None, None), (5000, "", None, True, 0), rows[1], rows[1]]
    labels += [(None, 1, "x"), (7, None, "x"), (9999, 1, "x"), (1, 0, "x"), (1, 1, "x")]
    verdicts = rr.judge(
        spark.createDataFrame(rows, DOCS),
        spark.createDataFrame(labels, "doc_id long, quality int, lang string"),
        risk=0.2,
    )
    got = verdicts.documents.collect()
    assert len(got) == len(rows)
    cutoffs = {r["stratum"]: r for r in verdicts.cutoffs.collect()}
    assert cutoffs["a"]["symbol_share"] is not None and cutoffs["b"]["symbol_share"] is not None
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        counts = brute_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in rr.COUNTS[:5]) == counts
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        expected = not r["base_failed"] and not any(
            (c := cutoffs.get(r["stratum"])) is not None
            and c[rule] is not None
            and r[rule] is not None
            and r[rule] > c[rule]
            for rule in rr.GRIDS
        )
        assert r["kept"] == expected
    good = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 4 and r["doc_id"] < 3000]
    assert sum(r["kept"] for r in good) == len(good)
    bad = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 4 == 0 and r["stratum"]]
    assert not any(r["kept"] for r in bad if r["doc_id"] < 3000)


def test_few_or_no_labels_reject_nothing(spark):
    rows, labels = documents(60)
    docs = spark.createDataFrame(rows, DOCS)
    for some in (labels, []):
        verdicts = rr.judge(docs, spark.createDataFrame(some, "doc_id long, quality int, x string"))
        assert all(r["kept"] for r in verdicts.documents.collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rr.judge(docs, labels).documents.collect() == []
