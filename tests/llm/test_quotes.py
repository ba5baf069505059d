from __future__ import annotations

from syncflow.llm.quotes import as_mailbox, conversations, link_quotes

SCHEMA = "box string, no long, text string, id string, root int"


def linked(spark, rows, **settings):
    messages = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    found = link_quotes(messages, ["box", "no"], **settings).collect()
    return {
        (r["id"]["box"], r["id"]["no"]): (
            r["own_text"],
            r["parent"] and tuple(r["parent"]),
            r["root"] and tuple(r["root"]),
            r["depth"],
            r["n_quoted"],
            r["n_linked"],
        )
        for r in found
    }, found


def test_threads(spark):
    rows = [
        ("a", 1, "Hello   there\nall\n\nsecond part"),
        ("a", 2, "On Monday A wrote:\n> hello there\n> ALL\n\nmy answer\n\n"),
        ("a", 3, "> > Hello there all\n\n>my answer\r\nand mine"),
        ("a", 4, "intro\n>>  my   answer\n>> \n> and MINE\n> unknown words\nend"),
        ("b", 1, "> not yet written\nalone"),
        ("b", 2, "not yet written"),
        ("b", 3, ">> second part\nonly a nested quote"),
        ("b", 4, None),
        ("b", 5, ""),
        ("b", 6, ">\n> \n  "),
        ("c", None, "> alone\nno id"),
    ]
    got, _ = linked(spark, rows)
    a1, a2, a3 = ("a", 1), ("a", 2), ("a", 3)
    assert got[a1] == ("Hello   there\nall\n\nsecond part", None, a1, 0, 0, 0)
    assert got[a2] == ("my answer", a1, a1, 1, 1, 1)
    assert got[a3] == ("and mine", a2, a1, 2, 2, 2)
    # The unknown line belongs to the passage above it, which so has no original.
    assert got["a", 4] == ("intro\nend", a2, a1, 2, 2, 1)
    assert got["b", 1] == ("alone", None, ("b", 1), 0, 1, 0)
    assert got["b", 3] == ("only a nested quote", a1, a1, 1, 1, 1)
    assert got["b", 4] == got["b", 4][:1] + (None, ("b", 4), 0, 0, 0) and got["b", 4][0] == ""
    assert got["b", 5][1:] == (None, ("b", 5), 0, 0, 0)
    assert got["b", 6][1:] == (None, ("b", 6), 0, 0, 0)
    assert got["c", None][1:] == (None, None, 0, 1, 0)


def test_long_chain_ties_and_repeats(spark):
    rows = [("a", 0, "message 0")]
    rows += [("a", i, f"> message {i - 1}\nmessage {i}") for i in range(1, 40)]
    rows += [("a", 5, "> message 4\nmessage 5"), ("z", 1, "message 3"), ("z", 2, "> message 3\nyes")]
    got, found = linked(spark, rows)
    assert len(found) == len(rows)
    assert all(got["a", i][1:4] == (("a", i - 1), ("a", 0), i) for i in range(1, 40))
    # The message before it, not the first of all that ever said so.
    assert got["z", 2][1:4] == (("z", 1), ("z", 1), 1)
    apart, _ = linked(spark, rows, n_box=0, hot_rows=1)
    assert apart["z", 2][1:4] == (("a", 3), ("a", 0), 4)


def test_copies_of_a_conversation_stay_apart(spark):
    rows = [(box, i, f"> message {i - 1}\nmessage {i}") for box in "abcde" for i in range(8)]
    rows += [(box, 20 + i, "> Thanks!\nThanks!") for box in "ab" for i in range(5)]
    rows += [("f", 3, "> message 5\nquotes what others wrote"), ("a", 30, "> message 2\nmessage 2")]
    for hot_rows in (1, 10**6):
        got, _ = linked(spark, rows, hot_rows=hot_rows)
        for box in "abcde":
            assert got[box, 0][1:4] == (None, (box, 0), 0)
            assert all(got[box, i][1:4] == ((box, i - 1), (box, 0), i) for i in range(1, 8))
        assert got["a", 20][1] is None and got["b", 20][1] == ("a", 20)
        assert all(got["a", 20 + i][1:4] == (("a", 19 + i), ("a", 20), i) for i in range(1, 5))
        assert all(got["b", 20 + i][1:4] == (("b", 19 + i), ("a", 20), i + 1) for i in range(1, 5))
        assert got["f", 3][1:4] == (("a", 5), ("a", 0), 6)
        # It wrote what it quotes: only the earlier message counts.
        assert got["a", 30][1] == ("a", 2)


def test_most_quoted_original_wins(spark):
    rows = [("a", 1, "one\n\ntwo"), ("a", 2, "three"), ("a", 3, "> three\n\n> one\n\n> two\nyes")]
    got, _ = linked(spark, rows)
    assert got["a", 3][1:] == (("a", 1), ("a", 1), 1, 3, 3)


def test_mailbox_and_order(spark):
    turns = spark.createDataFrame(
        [(c, t, f"text {c}\nof {t}") for c in range(4) for t in range(5)]
        + [(0, 1, "text 0\nof 1"), (None, 1, "x"), (7, None, "y"), (8, 0, None), (8, 1, "z")],
        "conv_id long, turn long, text string",
    )
    box = as_mailbox(turns)
    assert box.count() == 25
    found = conversations(link_quotes(box, ["conv_id", "turn"])).collect()
    by_id = {tuple(r["id"]): r for r in found}
    for c in range(4):
        for t in range(5):
            r = by_id[c, t]
            assert r["own_text"] == f"text {c}\nof {t}" and tuple(r["root"]) == (c, 0)
            assert r["depth"] == t and r["n_quoted"] == min(t, 2)
    order = [(r["root"], r["depth"]) for r in found if r["root"] is not None]
    assert order == sorted(order)


def test_very_long_message(spark):
    body = "\n".join(f"line {i}" for i in range(20_000))
    quote = "\n".join(f"> line {i}" for i in range(20_000))
    got, _ = linked(spark, [("a", 1, body), ("a", 2, quote + "\nyes"), ("a", 3, "> " * 300 + "x")])
    assert got["a", 2][1:] == (("a", 1), ("a", 1), 1, 1, 1)


def test_empty_table(spark):
    assert linked(spark, [])[1] == []
