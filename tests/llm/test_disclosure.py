from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from syncflow.llm import disclosure as d

KINDS = d.KINDS
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    figures = [int(c) for c in reversed(digits)]
    return sum(f if i % 2 == 0 else f * 2 - 9 * (f > 4) for i, f in enumerate(figures)) % 10 == 0


def brute_spans(text):
    text, out = text or "", []
    plain = lambda m: re.sub("[^0-9]", "", m.group())
    for no, (pattern, fine) in enumerate([
        (EMAIL, lambda m: True),
        (IP, lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        (CARD, lambda m: 12 <= len(plain(m)) <= 19 and luhn(plain(m))),
        (PHONE, lambda m: 9 <= len(plain(m)) <= 15),
    ]):
        for m in pattern.finditer(text):
            if fine(m):
                name = m.group().lower() if no < 2 else plain(m)
                out.append((m.start(), no, m.end(), f"{KINDS[no]}:{name}"))
    return sorted(out)


TEXTS = [
    None, "", "plain", "a@b.c", "x a@b.c_d@e.f, z@q", "a@b a@b.c.d-e @x.y .@.", "é😀 me+1@x-y.org😀 1.2.3.4",
    "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.00.1.1 1.2.3 01.02.03.004x", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111  1111 1111 1111", "+1 (555) 010-9999 +12 +123456789 +1234567890123456 ++1 234 567 89-",
    "+4111 1111 1111 1111 4111111111111111", "1" * 300, "0" * 12 + " 0" * 7, "a" * 5000 + "@" + "b." * 300 + "c",
    ".".join(["1"] * 4000), " ".join(f"u{i}@h.io 10.0.{i % 300}.1" for i in range(700)), "@" * 2000, "+1" * 2000,
]


def test_base_spans(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, start int")
    got = {r["doc_id"]: r for r in d.find_entities(docs, "doc_id", "text").collect()}
    for i, t in enumerate(TEXTS):
        spans = [(s["start"], s["kind_no"], s["end"], s["entity"]) for s in got[i]["spans"]]
        assert spans == brute_spans(t), t and t[:80]


def brute_terms(rows, min_docs, at, near):
    """Terms near entities that disclose them, from counts over all rows."""
    runs = [
        [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", t or "")]
        for _, t in rows
    ]
    beside = []
    for (_, t), words in zip(rows, runs, strict=True):
        found = {}
        spans = brute_spans(t)
        for no in range(len(KINDS)):
            pattern = [EMAIL, IP, CARD, PHONE][no]
            borders = [(m.start(), m.end()) for m in pattern.finditer(t or "")]
            for start, _, end, name in (s for s in spans if s[1] == no):
                low = max([e for _, e in borders if e <= start], default=0)
                high = min([b for b, _ in borders if b >= end], default=len(t))
                for word, a, b in words:
                    if (max(low, start - near) <= a and b <= start) or (
                        end <= a and b <= min(high, end + near)
                    ):
                        found.setdefault((name, word), set()).add((a, b))
        beside.append(found)
    n = len(rows)
    out = []
    for found in beside:
        spans = {}
        for (name, word), places in found.items():
            n_et = sum((name, word) in f for f in beside)
            n_e = sum(any(s[3] == name for s in brute_spans(t)) for _, t in rows)
            n_t = sum(any(w == word for w, _, _ in words) for words in runs)
            if n_et < min_docs or n_e == n:
                continue
            value = math.log(n * n_et / (n_e * n_t)) / math.log(n / n_e)
            if value >= at:
                for p in places:
                    spans[p] = max(spans.get(p, -9), value)
        out.append(sorted((a, b, round(v, 9)) for (a, b), v in spans.items()))
    return out


ROWS = [
    (1, "the quick informant Zebulon wrote to me@spy.org about nothing special"),
    (2, "agent ZEBULON, me@spy.org; the quick reply"),
    (None, "mail ME@spy.org zebulon9x the informant"),
    (4, "nothing special here, the quick brown Zebulonist"),
    (5, "call +44 20 7946 0000 informant the quick one " + "far " * 30 + "Zebulon"),
    (6, None),
    (7, ""),
    (8, "special quick nothing about agent reply"),
    (8, "special quick nothing about agent reply"),
    *[(10 + i, "the quick reply about nothing") for i in range(12)],
]


@pytest.mark.parametrize("near,at", [(64, 0.8), (16, 0.5), (5, 0.2)])
def test_disclosing_terms(spark, near, at):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, term string")
    got = d.sanitise(docs, near=near, generalise_at=at).collect()
    want = {}
    for (i, t), terms in zip(ROWS, brute_terms(ROWS, d.MIN_DOCS, at, near), strict=True):
        want.setdefault((i, t or ""), terms)
    assert len(got) == len(ROWS)
    for r in got:
        terms = [(t["start"], t["end"], round(t["disclosure"], 9)) for t in r["terms"]]
        assert terms == want[r["doc_id"], r["text"]]
        if not r["spans"]:
            assert r["clean_text"] == r["text"]
    assert any(want.values()) or near < 10


def test_clean_text(spark):
    rows = [
        ("ab +1 234 567 8901 cd 1.2.3.4", [(3, 3, 18), (22, 1, 29)], [(0, 2, False), (19, 21, True)]),
        ("x 4111 1111 1111 1111 y", [(2, 2, 21), (10, 3, 23)], []),
        ("é😀 a@b.c", [(3, 0, 8)], [(0, 1, True)]),
        ("", [], []),
    ]
    table = spark.createDataFrame(
        rows,
        "text string, spans array<struct<start:int,kind_no:int,end:int>>, "
        "terms array<struct<start:int,end:int,removed:boolean>>",
    )
    got = [r["c"] for r in table.select(d.clean_text().alias("c")).collect()]
    assert got == ["<word> <phone>  <ip>", "x <card>", "😀 <email>", ""]
    lists = [r["c"] for r in table.select(d.span_list(True).alias("c")).collect()]
    assert lists[0] == "term:0:2,phone:3:18,term:19:21,ip:22:29" and lists[3] == ""
    assert table.select(d.kind_count("ip").alias("n")).first()["n"] == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert d.sanitise(docs).collect() == []


def test_no_python(spark):
    docs = spark.createDataFrame([(1, "me@x.org")], "doc_id long, text string")
    plan = d.sanitise(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_prefix_sums(spark):
    table = spark.createDataFrame([([1] * 3000,), ([],), ([5, -2],)], "a array<int>")
    got = [r[0] for r in table.select(d.prefix_sums(F.col("a"))).collect()]
    assert got == [list(range(1, 3001)), [], [5, 3]]


def test_terms_anywhere_in_a_document(spark):
    """Far from the entity, behind digits that are no card, in one document, of two letters."""
    rows = [
        (1, "Li " + "far " * 60 + "4111 1111 1111 1111, exp 12 Zebulon, LI"),
        (2, "zebulon@spy.org " + "far " * 60 + "Quagmire; 4111-1111-1111-1111 zebulon"),
        *[(10 + i, "far exp quagmires") for i in range(30)],
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in d.sanitise(docs, min_term=1).collect()}
    marked = {
        i: [r["text"][t["start"] : t["end"]] for t in r["terms"]] for i, r in got.items()
    }
    assert marked[1] == ["Li", "Zebulon", "LI"]
    # The address is an entity of its own; its letters are no terms.
    assert marked[2] == ["Quagmire", "zebulon"]
    assert not any(marked[i] for i in marked if i >= 10)
    assert "Zebulon" not in got[1]["clean_text"] and "LI" not in got[1]["clean_text"]
