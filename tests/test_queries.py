"""Registered queries against their SQL on the smallest tables.

A spread of queries and one of four shards of the rest run by default; ROLLBOOK_SHARD=0 to 3
picks the shard, and ROLLBOOK_ALL=1 runs every query. ``tools/check.py`` compares all of them as well.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tools.check import TABLES, rows

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "top_share", "pivot_counts_pct", "summary_stats_all", "describe_long", "one_to_one", "topk_ties", "json_map_long", "set_ops",
    "iti_enrollments", "iti_marks", "iti_vacancies", "deg_applications", "hss_priority_admission", "student_key", "dedupe_rejects",
    "iti_enrollment_institutes_over_time", "seats_by_type_year", "point_in_polygon", "fuzzy_join", "stream_landing", "density",
]
ALL = os.environ.get("ROLLBOOK_ALL") == "1"
EVERY = sorted(name for name in entry_point.oracle_sql() if name not in entry_point.TEXT_RUN)
SHARD = EVERY[int(os.environ.get("ROLLBOOK_SHARD", "0")) :: 4]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", EVERY if ALL else sorted({*SOME, *SHARD}))
def test_query_equals_sql(spark, duck, name):
    got = entry_point.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(entry_point.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
