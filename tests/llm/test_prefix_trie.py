from __future__ import annotations

import hashlib
import zlib

import pytest

from syncflow.llm.prefix_trie import ordered_turns, prefix_trie, share_openings

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        head = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        out[c] = convs.get(base, [])[:head] + turns[head:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, held in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in held if len(convs[c]) == len(path))
        out.append(
            (
                min(held),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(held),
                sum(len(p) == len(path) + 1 for p in below),
                sum(not any(q[:-1] == p for q in below if q) for p in below),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def turns_of(*texts, role="user"):
    return [(i, role, t) for i, t in enumerate(texts)]


COMMON = turns_of("hallo", "was gibt es", "nichts")
ROWS = [(c, *t) for c in (3, 4, 5, 17, 31) for t in COMMON]
ROWS += [(c, *t) for c in (6, 7) for t in COMMON[:2]]
ROWS += [(8, *t) for t in turns_of("hallo", "was gibt es", "viel", "äöü" * 500, "")]
ROWS += [(9, 0, "assistant", "hallo"), (9, None, "user", "first"), (9, None, None, None)]
ROWS += [(10, 1, "a", "tie"), (10, 1, "a", "tie"), (10, 1, "a", "eit"), (10, 1, None, None)]
ROWS += [(11, i, "user", f"t{i // 2}") for i in range(40)]
ROWS += [(12, i, "user", f"t{i // 2}") for i in range(25)]
ROWS += [(13, i, "user", f"t{i // 2}") for i in range(24)] + [(13, 24, "user", "end")]
ROWS += [(None, 0, "user", "nobody"), (-3, 0, "user", "hallo"), (-5, 0, "user", "ab"), (20, None, "", "a")]


@pytest.mark.parametrize("width,hot_rows", [(1, 10**6), (3, 2), (8, 10**6), (50, 1)])
@pytest.mark.parametrize("shared", [False, True])
def test_against_brute_force(spark, width, hot_rows, shared):
    rows = frame(spark, ROWS)
    turns = ordered_turns(rows)
    convs = turns.select("conv_id").distinct()
    expected = ordered(ROWS)
    if shared:
        turns = share_openings(turns, convs, 5, 9)
        expected = rebuilt(expected)
    got = prefix_trie(turns, convs, width=width, hot_rows=hot_rows).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(expected)


def test_conversations_without_turns(spark):
    turns = ordered_turns(frame(spark, [(2, 0, "a", "b")]))
    convs = spark.createDataFrame([(1,), (2,), (3,)], "conv_id long")
    got = sorted((tuple(r) for r in prefix_trie(turns, convs).collect()), key=repr)
    assert got == brute({1: [], 2: [("a", "b")], 3: []})


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "a:b", "c"), (4, 0, "a", "b:c")]
    turns = ordered_turns(frame(spark, rows))
    nodes = prefix_trie(turns, turns.select("conv_id").distinct())
    assert nodes.where("depth = 1").count() == 4


def test_empty(spark):
    turns = ordered_turns(frame(spark, []))
    nodes = prefix_trie(turns, turns.select("conv_id").distinct())
    assert nodes.collect() == [] and len(nodes.columns) == 8


def test_width(spark):
    turns = ordered_turns(frame(spark, []))
    with pytest.raises(ValueError):
        prefix_trie(turns, turns, width=0)
