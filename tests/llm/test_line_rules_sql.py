"""The line rules against their SQL on tables where an older rule, by families and a ratio, gave something else."""

from __future__ import annotations

import random

import duckdb
import pytest

from rollbook.llm import line_spread, quality_rules, queries


def tables():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    line = lambda n: " ".join(word() for _ in range(n))
    notice, banner, footer, copied = line(40), line(60), line(6), line(30)
    # A notice longer than any own line, on many sites.
    yield [(i, f"{notice}\n{line(4)}\n{line(5)}\n{line(4)}\n{line(6)}\n{line(30)}", f"site{i % 15}") for i in range(60)]
    # A host whose documents are a long banner and little else: all are one family.
    yield [(i, f"{banner}\n{line(3)}", "one") for i in range(60)] + [(100 + i, line(30), "one") for i in range(5)]
    # A footer on unlike pages, beside many near copies of one page that has it.
    yield [(i, f"{line(20)}\n{line(20)}\n{footer}", f"site{i % 12}") for i in range(40)] + [(200 + i, f"{copied}\n{line(2)}\n{footer}", f"site{i % 12}") for i in range(120)]
    yield [(i % 7, rng.choice([None, "", "a\n\nb", f"{footer}\n{line(12)}", f" {footer.upper()} \n{footer} 12\n{line(12)}"]), rng.choice([None, *(f"s{k}" for k in range(14))])) for i in range(150)]


@pytest.mark.parametrize("case", range(4))
def test_sql_states_the_rule(spark, case):
    rows = list(tables())[case]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = con.sql(queries.QUALITY).project(", ".join(columns)).fetchall()
    got = [tuple(r) for r in quality_rules.judge(docs).select(columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert (case != 1) or sum(not r[-1] for r in got) == 60
    want = con.sql(queries.SPREAD).project("doc_id, text, n_removed").fetchall()
    got = [tuple(r) for r in line_spread.without_spread(docs).select("doc_id", "text", "n_removed").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {0: 60, 1: 0}.get(case, sum(r[2] for r in got)) == sum(r[2] for r in got)
