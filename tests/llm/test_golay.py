from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from syncflow.llm import golay
from syncflow.llm.components import components
from syncflow.staging import Staging


def brute_print(text: str | None) -> int:
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a B c d", "É x y z É x y z w", "w " * 40_000])
def test_fingerprint(text):
    assert golay.fingerprint(text.encode()) == brute_print(text)


def test_code_is_perfect():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    index = golay.decode(words)
    codeword = index << 11 | np.array([golay._remainder(int(i) << 11) for i in index])
    assert (np.bitwise_count(codeword ^ words) <= 3).all()


def test_every_near_pair_shares_a_key():
    rng = random.Random(5)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        prints = np.array([a, b], np.uint64)
        keys, owner = golay.file_keys(prints)
        order = np.argsort(keys, kind="stable")
        left, right = golay.links_of_run(keys[order], prints[owner][order], 4)
        assert [(int(left[0]), int(right[0]))] == [(min(a, b), max(a, b))]


def groups_of(prints, max_bits):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    items = sorted(root)
    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in items}


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_links_reach_what_all_pairs_reach(spark, max_bits):
    rng = random.Random(max_bits)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:12]:
        # Large groups of near copies, and chains.
        for _ in range(30):
            q = p
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                q ^= 1 << bit
            prints.add(q)
            p = q if rng.random() < 0.2 else p
    signed = [(int(np.array([p], np.uint64).view(np.int64)[0]),) for p in prints]
    links = golay.fingerprint_links(spark.createDataFrame(signed, "print long"), max_bits).collect()
    mask = (1 << 64) - 1
    assert all(((r["a"] ^ r["b"]) & mask).bit_count() <= max_bits for r in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in links:
        root[find(r["a"] & mask)] = find(r["b"] & mask)
    want = groups_of(prints, max_bits)
    same = lambda names: {frozenset(p for p in names if names[p] == n) for n in set(names.values())}
    assert same({p: find(p) for p in prints}) == same(want)


def test_spanning_links_of_a_large_run():
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    prints = {centre} | {centre ^ 1 << a ^ 1 << b for a in range(64) for b in range(a)}
    members = np.array(sorted(prints), np.uint64)
    leads = members == centre
    links = list(golay.spanning_links(members, leads, 4))
    assert sum(len(b) for _, b in links) == len(members) - 1


def test_near_duplicates(spark):
    rng = random.Random(2)
    body = [f"w{rng.randint(0, 500)}" for _ in range(400)]
    near = [*body[:200], "new", *body[201:]]
    rows = [
        (5, " ".join(body)), (3, " ".join(near)), (3, " ".join(near)), (9, " ".join(body).upper()),
        (7, None), (8, " \t"), (None, ""), (None, "alone here"), (4, "alone too"),
    ]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, print string, root int")
    got = golay.near_duplicates(docs).collect()
    want = groups_of({brute_print(t) for _, t in rows}, 4)
    least = {}
    for i, t in rows:
        if i is not None:
            g = want[brute_print(t)]
            least[g] = min(i, least.get(g, i))
    expected = [(i, brute_print(t), least.get(want[brute_print(t)])) for i, t in rows]
    found = [(r["doc_id"], r["print"] & (1 << 64) - 1, r["component_id"]) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    hexes = golay.near_duplicates(docs).select(golay.hex_print(golay.F.col("print")).alias("h"))
    assert all(len(r["h"]) == 16 for r in hexes.collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert golay.near_duplicates(docs).collect() == []
    with pytest.raises(ValueError):
        golay.fingerprint_links(spark.createDataFrame([], "print long"), 5)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(45)] + [(-5, -5)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(table, Staging(spark)).collect()}
    root = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
