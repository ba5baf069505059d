from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from syncflow.llm import schedule as s

SCHEMA = "doc_id long, text string, source string, size long, place string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        left = sum(weight[n] for n in names if n not in full)
        over = {n for n in names if n not in full and rest * weight[n] / left > most * sizes[n]}
        if not over:
            break
        full |= over
        if len(full) == len(names):
            break
    return {n: float(most * sizes[n]) if n in full else rest * weight[n] / left for n in names}


def corpus(seed, n=400):
    rng = random.Random(seed)
    names = ["a", "b", "c", "ä", None, "d" * 30]
    rows = []
    for i in range(n):
        source = rng.choices(names, [30, 1, 5, 8, 2, 10])[0]
        rows.append((i, " ".join(["w"] * rng.randint(0, 300)), source))
    rows += [(None, "x y  z\x0bq", "a"), (900, None, "a"), (901, "", "zero"), (1, "p q", "c"), (1, "p q", "c")]
    return rows


@pytest.mark.parametrize("seed,block", [(0, 128), (1, 7), (2, 100_000)])
def test_targets_and_takes(spark, seed, block):
    rows = corpus(seed)
    mix = s.mix_sources(docs_of(spark, rows), block_tokens=block)
    got = s.tokens_taken(mix).collect()
    sizes, sources = {}, {}
    for i, t, n in rows:
        sizes[n] = sizes.get(n, 0) + len((t or "").split())
    want = brute_targets(sizes)
    total = sum(want.values())
    assert len(got) == len(rows)
    targets = {(r["source_size"], round(r["target"], 6)) for r in got}
    assert targets == {(sizes[n], round(want[n], 6)) for n in sizes}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sources.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    slots = mix.schedule.count()
    assert slots & (slots - 1) == 0
    for (_, target), taken in sources.items():
        assert abs(sum(taken) - target) <= total / slots + 2
    assert sorted(r["size"] for r in got) == sorted(len((t or "").split()) for _, t, _ in rows)
    again = s.tokens_taken(s.mix_sources(docs_of(spark, rows[::-1]), block_tokens=block)).collect()
    key = lambda r: (repr(r["id"]), r["place"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_schedule_is_van_der_corput(spark):
    rows = corpus(3)
    mix = s.mix_sources(docs_of(spark, rows))
    sources = {r["source_no"]: r for r in mix.sources.collect()}
    slots = sorted((r["position"], r["source_no"], r["rank"]) for r in mix.schedule.collect())
    bits = len(slots).bit_length() - 1
    assert [p for p, _, _ in slots] == list(range(1 << bits))
    total = max(r["target_to"] for r in sources.values())
    seen: dict[int, int] = {}
    for position, source, rank in slots:
        point = int(format(position, f"0{bits}b")[::-1], 2) / (1 << bits) * total
        # The point lies in the source's piece of the unit interval.
        assert sources[source]["target_from"] <= point + 1e-6
        assert point < sources[source]["target_to"] + 1e-6
        assert rank == seen.get(source, 0)
        seen[source] = rank + 1
    # Any stretch holds each source in proportion.
    for begin in (0, 100, 5000):
        stretch = [x for _, x, _ in slots[begin : begin + 4096]]
        for no, r in sources.items():
            assert abs(stretch.count(no) - 4096 * r["target"] / total) <= 2 * bits


def test_parts_fit_together(spark):
    mix = s.mix_sources(docs_of(spark, corpus(4)), block_tokens=50)
    sizes = {r["doc_no"]: r["size"] for r in mix.documents.collect()}
    parts = mix.taken.collect()
    assert all(r["first_token"] + r["n_tokens"] <= sizes[r["doc_no"]] for r in parts)
    per_slot = {}
    for r in parts:
        per_slot[r["position"]] = per_slot.get(r["position"], 0) + r["n_tokens"]
    assert max(per_slot.values()) - min(per_slot.values()) <= 2


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)], [(1, "one", None)]])
def test_small_tables(spark, rows):
    got = s.tokens_taken(s.mix_sources(docs_of(spark, rows))).collect()
    assert len(got) == len(rows)
    assert sum(r["taken"] for r in got) in (0, 1, 2)


def test_hot_repeated_row(spark):
    rows = [(1, "a b c", "x")] * 300 + [(2, "d e", "y")] * 5
    got = s.tokens_taken(s.mix_sources(docs_of(spark, rows))).collect()
    assert len(got) == 305 and all(r["taken"] <= 2 * r["size"] for r in got)


def test_bad_settings_and_plan(spark):
    docs = docs_of(spark, corpus(5, 20))
    with pytest.raises(ValueError):
        s.mix_sources(docs, share=3)
    plan = s.tokens_taken(s.mix_sources(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.select(s.token_count(F.col("text")).alias("n")).where("n is null").count() == 0
