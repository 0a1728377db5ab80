"""The pipeline's stages, and the queries against their SQL."""

from __future__ import annotations

import os
import random

import duckdb
import pytest

import corpus_pipeline
from rollbook.llm import queries

FOLDER = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(map(repr, rows))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    got = queries.RUN[name](spark, FOLDER)
    want = duck.sql(queries.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert ordered(map(tuple, got.select(*columns).collect())) == ordered(want.project(", ".join(columns)).fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
def test_stages_follow_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    kept = {r.doc_id for r in queries.op8(spark, FOLDER).where("kept").collect()}
    first = spark.read.parquet(str(tmp_path / "quality_rules"))
    assert {r.doc_id for r in first.collect()} == kept
    lined = spark.read.parquet(str(tmp_path / "line_dedup"))
    assert lined.count() == first.count() and all(r.n_chars == len(r.text) for r in lined.collect() if r.text is not None)
    last = spark.read.parquet(str(tmp_path / "packing"))
    near = spark.read.parquet(str(tmp_path / "ngram_join"))
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in near.collect()}
    assert corpus_pipeline.run(spark, FOLDER).count() == seen[-1]


def test_pipeline_of_hard_rows(spark):
    rows = [(i, t, None, s, 1, 2) for i, t, s in [(1, None, None), (2, "", "a"), (None, "w " * 40, "a"), (3, "one two three four five six seven eight nine ten eleven", "a")] * 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mark int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    # Of rows that repeat an id and a text one stays: one document of each group.
    assert [r.doc_id for r in docs.collect()] == [3] and docs.columns[-1] == "mark"


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    rng, rows = random.Random(12), []
    for _ in range(40):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 60, 150, 400]))]
        for _ in range(3):
            now = list(base)
            for k in rng.sample(range(len(now)), max(1, round(len(now) * rng.choice([0.006, 0.009, 0.012])))):
                now[k] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(now)))
    five = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    likeness = {(i, j): len(five[i] & five[j]) / len(five[i] | five[j]) for j in range(len(rows)) for i in range(j)}
    least = list(range(len(rows)))
    for _ in rows:
        for (i, j), x in likeness.items():
            if x >= 0.8:
                least[i] = least[j] = min(least[i], least[j])
    assert sum(0.8 <= x < 0.9 for x in likeness.values()) > 10
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == {i for i, k in enumerate(least) if i == k}
