"""The pipeline, stage by stage, on a small corpus with edge cases."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from syncflow.llm import golay, gumbel_pieces, line_runs, queries
from syncflow.llm.oracles import ORACLES

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "rank int, kept string, row string, component_id long, score double"
)
WORDS = {"en": "the cat sat on a mat and ran to the old man".split(), "de": "der hund und die katze im haus mit dem mann".split()}
FOOTER = "This line is found at the end of so many documents."


def corpus():
    rng, rows = random.Random(8), []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        body = " ".join(rng.choice(WORDS[lang]) + str(rng.randint(0, 99)) * (rng.random() < 0.3) for _ in range(80))
        rows.append((i, body + ("\n" + FOOTER if i % 5 == 0 else ""), lang, f"s{i % 3}"))
    rows += [(100 + i, rows[i][1].upper() if i % 2 else rows[i][1], "en", "s0") for i in range(6)]
    rows += [(200, None, "en", "s1"), (201, "", None, None), (202, "12 34 !!", "en", "s1")]
    rows += [(None, rows[2][1], "en", "s2"), (None, "the only one without an id but not alone in text", "en", None)]
    rows += [(3, rows[3][1], "en", "s0")]
    return [(*r, len(r[1] or ""), 1, "k", "r", 5, 0.5) for r in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.createDataFrame(corpus(), SCHEMA)
    out = {"raw": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["raw"].columns
        assert {r["kept"] for r in stages[name].collect()} == {"k"}


def test_language_drops_what_has_no_letters(stages):
    gone = [x for x in texts(stages["raw"]) if x not in texts(stages["language"])]
    assert sorted(x[0] for x in gone) == [200, 201, 202]


def test_lines_are_dropped(stages):
    want = line_runs.dedup_lines(stages["language"]).select("row.doc_id", F.col("kept").alias("text"))
    assert texts(stages["lines"]) == texts(want)
    assert sum(FOOTER.lower() in t.lower() for _, t in texts(stages["lines"])) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in stages["lines"].collect())


def test_one_document_of_each_group_stays(stages):
    rows = texts(stages["lines"])
    prints = {t: golay.fingerprint(t.encode()) for _, t in rows}
    kept = texts(stages["near_copies"])
    groups = []
    for text in prints:
        near = [g for g in groups if any((prints[text] ^ prints[t]).bit_count() <= 4 for t in g)]
        groups = [g for g in groups if g not in near] + [{text}.union(*near)]
    assert len(kept) == len(groups)
    for group in groups:
        members = [(i is None, i, t) for i, t in rows if t in group]
        (one,) = [(i, t) for i, t in kept if t in group]
        assert one[0] == min(members, key=lambda m: (m[0], m[1] or 0))[1]


def test_mix_repeats_or_leaves_out(stages):
    before, after = texts(stages["near_copies"]), texts(stages["mix"])
    assert all(after.count(x) <= 2 for x in before) and set(after) <= set(before)
    words = lambda rows: sum(len(t.split()) for _, t in rows)
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.1)


@pytest.mark.skipif(not os.path.exists(queries.VOCABULARY), reason="no vocabulary here")
def test_encoding_can_be_decoded(stages):
    vocabulary = gumbel_pieces.Vocabulary.load(queries.VOCABULARY)
    text_of = {}
    for i, t in texts(stages["mix"]):
        text_of.setdefault(i, set()).add(t)
    rows = stages["encode"].collect()
    assert all(vocabulary.decode(r["ids"]) in text_of[r["doc_id"]] for r in rows)
    assert len(rows) == 3 * stages["mix"].count()


def test_empty_corpus(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


def test_registered():
    names = entry_point.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(entry_point.oracle_sql()) <= set(names)


DATA = os.environ.get("SYNCFLOW_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are absent")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in os.listdir(DATA):
        connection.execute(f"create view {table.removesuffix('.parquet')} as select * from '{DATA}/{table}'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = connection.execute(ORACLES[name])
    places = [[c[0] for c in result.description].index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in places)) for r in result.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are absent")
def test_language_accuracy_on_held_out_documents(spark):
    found = queries.op1_ppm_language(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").where("lang is not null").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows if r["lang_pred"] != "und"]
    assert sum(right) / len(right) > 0.95 and len(right) > 0.9 * len(rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are absent")
@pytest.mark.parametrize("name", ["op4_risk_rules", "op5_gumbel_pieces", "op6_disclosure", "op8_golay_simhash"])
def test_queries_without_sql_keep_every_document(spark, name):
    got = queries.QUERIES[name](spark, DATA).select("doc_id").distinct().count()
    assert got == spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").distinct().count()


def test_a_corpus_without_languages_stays(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(kept.columns) == sorted(docs.columns)
    gone = [x for x in texts(docs) if x not in texts(kept)]
    assert sorted(x[0] for x in gone) == [200, 201, 202]


def test_a_source_of_one_long_document_stays(spark):
    long = "long " * 20_000
    rows = [(1, long, "en", "a"), (2, long.upper(), "en", "b"), (3, long + "x", "en", "c")]
    rows += [(10 + i, f"short {i}", "en", "d") for i in range(5)] + [(20, "", "en", "e")]
    docs = spark.createDataFrame([(*r, 1, 1, "k", "r", 5, 0.5) for r in rows], SCHEMA)
    kept = corpus_pipeline.mix(spark, docs, "")
    assert {r["source"] for r in kept.select("source").distinct().collect()} == {*"abcd"}
