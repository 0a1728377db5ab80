"""Generic operators on the order tables.

Stand-ins: order year = academic year, market segment = social category,
priority = trade, order status = admission status, part type = institute type.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from queries.base import Tables, query
from rollbook.functions import categories as C, values as V
from rollbook.operators import aggregate as A, columns as P, joins as J, reshape as R, sets as U, windows as W
from rollbook.operators.quantiles import quantiles

STATUSES = ["F", "O", "P"]
FLAGS = ["A", "N", "R"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def orders(t: Tables):
    return t.orders.withColumn("yr", F.year("o_orderdate"))


def orders_customers(t: Tables):
    return orders(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


@query("top_share", """
WITH n AS (SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS students FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT o_orderpriority, students, round_even(100.0::DOUBLE * students / SUM(students) OVER (), 1) AS share
FROM n ORDER BY students DESC, o_orderpriority LIMIT 10""")
def top_share(t):
    counts = A.count_distinct_by(orders_customers(t), ["o_orderpriority"], "o_custkey", "students")
    shares = A.share_of_total(counts, "students", None, "share", 100.0)
    rounded = shares.withColumn("share", V.round_half_even(F.col("share"), 1))
    return W.top_overall(rounded, [F.desc("students"), "o_orderpriority"], 10)


@query("nunique_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(DISTINCT o_custkey) AS customers FROM orders
WHERE year(o_orderdate) > 1996 GROUP BY 1""")
def nunique_by_year(t):
    return A.count_distinct_by(orders(t).where("yr > 1996"), ["yr"], "o_custkey", "customers")


@query("count_sum_mean", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity, ROUND(AVG(l_discount), 6) AS mean_discount,
 ROUND(STDDEV_SAMP(l_extendedprice), 4) AS std_price
FROM lineitem GROUP BY 1""")
def count_sum_mean(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("mean_discount"),
        F.round(F.stddev_samp("l_extendedprice"), 4).alias("std_price"))


@query("pivot_counts_pct", """
WITH p AS (SELECT c_mktsegment, COUNT(*) FILTER (o_orderpriority='1-URGENT') AS a, COUNT(*) FILTER (o_orderpriority='2-HIGH') AS b,
 COUNT(*) FILTER (o_orderpriority='3-MEDIUM') AS c, COUNT(*) FILTER (o_orderpriority='4-NOT SPECIFIED') AS d,
 COUNT(*) FILTER (o_orderpriority='5-LOW') AS e, COUNT(*) AS total
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT c_mktsegment, round_even(a::DOUBLE/total*100,1) AS "1-URGENT (%)", round_even(b::DOUBLE/total*100,1) AS "2-HIGH (%)",
 round_even(c::DOUBLE/total*100,1) AS "3-MEDIUM (%)", round_even(d::DOUBLE/total*100,1) AS "4-NOT SPECIFIED (%)",
 round_even(e::DOUBLE/total*100,1) AS "5-LOW (%)", total FROM p""")
def pivot_counts_pct(t):
    table = R.pivot_count(orders_customers(t), ["c_mktsegment"], "o_orderpriority", PRIORITIES)
    return R.row_percentages(table, PRIORITIES, "total", [f"{p} (%)" for p in PRIORITIES], [1] * 5)


@query("pivot_row_total", """
SELECT c_mktsegment, COUNT(*) AS "Total", COUNT(*) FILTER (o_orderstatus='F') AS "F", COUNT(*) FILTER (o_orderstatus='O') AS "O",
 COUNT(*) FILTER (o_orderstatus='P') AS "P" FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1""")
def pivot_row_total(t):
    return R.with_row_total(R.pivot_count(orders_customers(t), ["c_mktsegment"], "o_orderstatus", STATUSES), ["c_mktsegment"])


@query("pivot_distinct", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='F') AS "F",
 COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='O') AS "O", COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='P') AS "P",
 CAST(0 AS BIGINT) AS "X" FROM orders GROUP BY 1""")
def pivot_distinct(t):
    return R.pivot_distinct(orders(t), ["yr"], "o_orderstatus", "o_custkey", [*STATUSES, "X"])


@query("pivot_mean", """
SELECT l_linestatus, round_even(AVG(l_extendedprice) FILTER (l_returnflag='A'), 1) AS "A",
 round_even(AVG(l_extendedprice) FILTER (l_returnflag='N'), 1) AS "N", round_even(AVG(l_extendedprice) FILTER (l_returnflag='R'), 1) AS "R"
FROM lineitem GROUP BY 1""")
def pivot_mean(t):
    return R.pivot_mean(t.lineitem, ["l_linestatus"], "l_returnflag", "l_extendedprice", FLAGS)


@query("pivot_sum", """
SELECT l_returnflag, CAST(SUM(CAST(l_discount > 0.05 AS INTEGER)) FILTER (l_linestatus='F') AS BIGINT) AS "F",
 CAST(SUM(CAST(l_discount > 0.05 AS INTEGER)) FILTER (l_linestatus='O') AS BIGINT) AS "O" FROM lineitem GROUP BY 1""")
def pivot_sum(t):
    rows = t.lineitem.withColumn("high", F.col("l_discount") > 0.05)
    return R.pivot_sum(rows, ["l_returnflag"], "l_linestatus", "high", ["F", "O"])


@query("pivot_first", """
SELECT c_mktsegment, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus='F') AS "F",
 arg_min(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus='O') AS "O",
 arg_min(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus='P') AS "P"
FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1""")
def pivot_first(t):
    return R.pivot_first(orders_customers(t), ["c_mktsegment"], "o_orderstatus", "o_orderpriority", ["o_orderdate", "o_orderkey"], STATUSES)


@query("first_by_group", """
SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY 1""")
def first_by_group(t):
    return A.first_by(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"], "first_priority")


@query("two_measure_pivot", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr,
 COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='F') AS "F_customers", COUNT(*) FILTER (o_orderstatus='F') AS "F_orders",
 COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='O') AS "O_customers", COUNT(*) FILTER (o_orderstatus='O') AS "O_orders",
 COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='P') AS "P_customers", COUNT(*) FILTER (o_orderstatus='P') AS "P_orders"
FROM orders GROUP BY 1""")
def two_measure_pivot(t):
    measures = {"customers": F.count_distinct("o_custkey"), "orders": F.count(F.lit(1))}
    return R.pivot_measures(orders(t), ["yr"], "o_orderstatus", measures, STATUSES)


@query("pivot_dash", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COALESCE(NULLIF(CAST(COUNT(*) FILTER (o_orderstatus='F') AS VARCHAR), '0'), '-') AS "F",
 '-' AS "X" FROM orders GROUP BY 1""")
def pivot_dash(t):
    table = R.pivot_count(orders(t), ["yr"], "o_orderstatus", ["F", "X"])
    return R.dash_zero(table, ["F", "X"])


@query("two_key_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) FILTER (c_mktsegment='BUILDING' AND o_orderstatus='F') AS "BUILDING_F",
 COUNT(*) FILTER (c_mktsegment='BUILDING' AND o_orderstatus='O') AS "BUILDING_O",
 COUNT(*) FILTER (c_mktsegment='MACHINERY' AND o_orderstatus='F') AS "MACHINERY_F",
 COUNT(*) FILTER (c_mktsegment='MACHINERY' AND o_orderstatus='O') AS "MACHINERY_O", COUNT(*) AS total
FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1""")
def two_key_counts(t):
    cells = {f"{s}_{o}": (F.col("c_mktsegment") == s) & (F.col("o_orderstatus") == o) for s in ["BUILDING", "MACHINERY"] for o in ["F", "O"]}
    return orders_customers(t).groupBy("yr").agg(*A.count_where(**cells), F.count(F.lit(1)).alias("total"))


@query("unpivot_pivot", """
WITH m AS (SELECT r_name, COUNT(DISTINCT n_nationkey) AS nations, COUNT(c_custkey) AS customers FROM region
 JOIN nation ON n_regionkey=r_regionkey LEFT JOIN customer ON c_nationkey=n_nationkey GROUP BY 1)
SELECT r_name, 'nations' AS measure, nations AS amount FROM m UNION ALL SELECT r_name, 'customers', customers FROM m""")
def unpivot_pivot(t):
    placed = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).join(
        t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    wide = placed.groupBy("r_name").agg(F.count_distinct("n_nationkey").alias("nations"), F.count("c_custkey").alias("customers"))
    return R.wide_to_long(wide, ["r_name"], ["nations", "customers"], "measure", "amount")


STATS = """round_even(AVG(v),1) AS "Mean", round_even(STDDEV_SAMP(v),1) AS "Std", round_even(quantile_cont(v,0.25),1) AS "25th",
 round_even(quantile_cont(v,0.5),1) AS "Median", round_even(quantile_cont(v,0.75),1) AS "75th", COUNT(v) AS "Count" """


@query("summary_stats", f"""
SELECT c_mktsegment AS "Category", {STATS} FROM (SELECT c_mktsegment, o_totalprice AS v FROM orders JOIN customer ON o_custkey=c_custkey) GROUP BY 1""")
def summary_stats(t):
    return A.summary_stats(orders_customers(t), "o_totalprice", "c_mktsegment", "Category")


@query("summary_stats_all", f"""
WITH r AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem)
SELECT 'All' AS "Type", {STATS} FROM r UNION ALL SELECT l_returnflag, {STATS} FROM r GROUP BY 1""")
def summary_stats_all(t):
    return A.summary_stats_with_all(t.lineitem, "l_extendedprice", "l_returnflag", "Type")


@query("quantiles_by_group", """
SELECT l_partkey, ROUND(quantile_cont(l_extendedprice, 0.1), 4) AS p10, ROUND(quantile_cont(l_extendedprice, 0.9), 4) AS p90
FROM lineitem GROUP BY 1""")
def quantiles_by_group(t):
    q = quantiles(t.lineitem, "l_extendedprice", ["l_partkey"], {"p10": 0.1, "p90": 0.9})
    return q.select("l_partkey", F.round("p10", 4).alias("p10"), F.round("p90", 4).alias("p90"))


TWO_LEVEL = """ROUND(AVG(n),4) AS mean, ROUND(STDDEV_SAMP(n),4) AS std, MAX(n) AS "max", COUNT(*) AS units,
 quantile_cont(n,0.25) AS p25, quantile_cont(n,0.5) AS p50, quantile_cont(n,0.75) AS p75"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query("two_level_stats", f"""
SELECT yr, {TWO_LEVEL} FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_custkey, COUNT(*) AS n FROM orders GROUP BY 1,2) GROUP BY 1""")
def two_level_stats(t):
    return _rounded(A.two_level_stats(orders(t), "o_custkey", "yr"), "mean", "std")


@query("trimmed_stats", f"""
SELECT yr, {TWO_LEVEL} FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_custkey, COUNT(*) AS n FROM orders GROUP BY 1,2)
WHERE n > 1 AND n <= 4 GROUP BY 1""")
def trimmed_stats(t):
    return _rounded(A.two_level_stats(orders(t), "o_custkey", "yr", more_than=1, at_most=4), "mean", "std")


@query("count_frequency", "SELECT n, COUNT(*) AS units FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def count_frequency(t):
    return A.count_frequency(t.orders, ["o_custkey"])


@query("binned_counts", """
SELECT l_returnflag, CASE WHEN l_quantity >= 0 AND l_quantity <= 10 THEN '0-10' WHEN l_quantity <= 25 THEN '11-25'
 WHEN l_quantity <= 50 THEN '26-50' END AS bin, COUNT(*) AS n FROM lineitem GROUP BY 1,2""")
def binned_counts(t):
    return A.binned_counts(t.lineitem, "l_quantity", [0, 10, 25, 50], ["0-10", "11-25", "26-50"], ["l_returnflag"])


@query("histogram", "SELECT CAST(floor(l_quantity/5)*5 AS DOUBLE) AS bin, COUNT(*) AS n FROM lineitem GROUP BY 1")
def histogram(t):
    return A.histogram(t.lineitem, "l_quantity", 5)


@query("centred_histogram", """
SELECT l_linestatus, CAST(floor(l_extendedprice/1000+0.5)*1000 AS DOUBLE) AS bin, COUNT(*) AS n FROM lineitem GROUP BY 1,2""")
def centred_histogram(t):
    return A.centred_histogram(t.lineitem, "l_extendedprice", 1000, ["l_linestatus"])


@query("conditional_counts", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, COUNT(*) AS n, COUNT(*) FILTER (l_returnflag='R') AS returned,
 COUNT(*) FILTER (l_discount > 0.05 AND l_tax < 0.04) AS cheap, ROUND(COUNT(*) FILTER (l_returnflag='R')::DOUBLE / COUNT(*), 6) AS share
FROM lineitem GROUP BY 1""")
def conditional_counts(t):
    rows = t.lineitem.withColumn("yr", F.year("l_shipdate"))
    out = rows.groupBy("yr").agg(F.count(F.lit(1)).alias("n"), *A.count_where(
        returned=F.col("l_returnflag") == "R", cheap=(F.col("l_discount") > 0.05) & (F.col("l_tax") < 0.04)))
    return out.withColumn("share", F.round(F.col("returned") / F.col("n"), 6))


@query("share_where", """
SELECT l_suppkey, COUNT(*) AS n, ROUND(COUNT(*) FILTER (l_returnflag='R')::DOUBLE/COUNT(*), 6) AS share FROM lineitem GROUP BY 1""")
def share_where(t):
    return _share(A.share_where(t.lineitem, ["l_suppkey"], F.col("l_returnflag") == "R"))


def _share(df, column="share", digits=6):
    return df.withColumn(column, F.round(column, digits))


@query("any_flag", "SELECT o_custkey, bool_or(o_totalprice > 400000) AS big FROM orders GROUP BY 1")
def any_flag(t):
    return A.any_by(t.orders, ["o_custkey"], F.col("o_totalprice") > 400000, "big")


@query("group_filter", """
SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 10 AND MIN(o_totalprice) < 50000)""")
def group_filter(t):
    wanted = A.groups_where(t.orders, ["o_custkey"], (F.count(F.lit(1)) > 10) & (F.min("o_totalprice") < 50000))
    return J.rows_of_groups(t.orders, wanted, ["o_custkey"])


@query("value_counts", """
SELECT event_type, COUNT(*) AS n, ROUND(100.0::DOUBLE*COUNT(*)/SUM(COUNT(*)) OVER (), 6) AS pct FROM events GROUP BY 1""")
def value_counts(t):
    return _share(A.value_counts(t.events, "event_type"), "pct")


@query("mode_share", """
WITH v AS (SELECT 'p_type' AS variable, p_type AS mode FROM part UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_name', p_name FROM part),
c AS (SELECT variable, mode, COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY variable) AS total FROM v WHERE mode IS NOT NULL GROUP BY 1,2)
SELECT variable, mode, n, ROUND(100.0::DOUBLE*n/total, 6) AS share FROM c
QUALIFY ROW_NUMBER() OVER (PARTITION BY variable ORDER BY n DESC, mode)=1""")
def mode_share(t):
    return _share(A.mode_share(t.part, ["p_type", "p_brand", "p_name"]))


@query("describe_long", """
WITH v AS (SELECT 'l_quantity' AS variable, l_quantity AS v FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem
 UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem)
SELECT variable, COUNT(v) AS n, ROUND(AVG(v),4) AS mean, ROUND(STDDEV_SAMP(v),4) AS std, ROUND(quantile_cont(v,0.25),4) AS p25,
 ROUND(quantile_cont(v,0.5),4) AS p50, ROUND(quantile_cont(v,0.75),4) AS p75 FROM v GROUP BY 1""")
def describe_long(t):
    out = A.describe_long(t.lineitem, ["l_quantity", "l_discount", "l_extendedprice"])
    return _rounded(out, "mean", "std", "p25", "p50", "p75")


def parts_with_gaps(t: Tables):
    """Parts with nulls, blanks and NA tokens that follow from the values themselves."""
    return t.part.select(
        F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        F.when(F.col("p_size") > 40, "").when(F.col("p_size") > 30, "NA").otherwise(F.col("p_name")).alias("p_name"),
        F.when(F.col("p_retailprice") < 950, " ").otherwise(F.col("p_brand")).alias("p_brand"), "p_size")


GAPS = """SELECT NULLIF(p_type,'PROMO') AS p_type, CASE WHEN p_size>40 THEN '' WHEN p_size>30 THEN 'NA' ELSE p_name END AS p_name,
 CASE WHEN p_retailprice<950 THEN ' ' ELSE p_brand END AS p_brand, p_size FROM part"""


@query("null_profile", f"""
WITH g AS ({GAPS}), v AS (SELECT 'p_type' AS variable, p_type AS x FROM g UNION ALL SELECT 'p_name', p_name FROM g UNION ALL SELECT 'p_brand', p_brand FROM g)
SELECT variable, COUNT(*) FILTER (x IS NULL) AS nulls, COUNT(*) FILTER (trim(x)='') AS blanks,
 COUNT(*) FILTER (x IS NULL OR x IN ('',' ','NA')) AS missing, COUNT(*) AS rows,
 ROUND(100.0::DOUBLE*COUNT(*) FILTER (x IS NULL OR x IN ('',' ','NA'))/COUNT(*), 6) AS missing_pct FROM v GROUP BY 1""")
def null_profile(t):
    return _share(A.null_profile(parts_with_gaps(t), ["p_type", "p_name", "p_brand"]), "missing_pct")


@query("null_profile_by_group", f"""
WITH g AS ({GAPS}), v AS (SELECT p_size, 'p_type' AS variable, p_type AS x FROM g UNION ALL SELECT p_size, 'p_brand', p_brand FROM g)
SELECT p_size, variable, COUNT(*) FILTER (x IS NULL) AS nulls, COUNT(*) FILTER (trim(x)='') AS blanks,
 COUNT(*) FILTER (x IS NULL OR x IN ('',' ','NA')) AS missing, COUNT(*) AS rows,
 ROUND(100.0::DOUBLE*COUNT(*) FILTER (x IS NULL OR x IN ('',' ','NA'))/COUNT(*), 6) AS missing_pct FROM v GROUP BY 1,2""")
def null_profile_by_group(t):
    return _share(A.null_profile(parts_with_gaps(t), ["p_type", "p_brand"], ["p_size"]), "missing_pct")


@query("null_tokens", f"""
SELECT p_size, NULLIF(p_type,'PROMO') AS p_type, CASE WHEN trim(p_name) IN ('','NA') THEN NULL ELSE p_name END AS p_name,
 CASE WHEN p_brand IN ('',' ','NA') THEN NULL ELSE p_brand END AS p_brand FROM ({GAPS})""")
def null_tokens(t):
    from rollbook.functions.nulls import clean_strings, null_strict

    return clean_strings(parts_with_gaps(t), null_strict)


@query("drop_empty_columns", f"SELECT p_type, p_name, p_brand, p_size, CAST(NULL AS VARCHAR) AS phase FROM ({GAPS})")
def drop_empty_columns(t):
    empty = F.lit(None).cast("string")
    rows = parts_with_gaps(t).withColumns({"unused": F.nullif(F.col("p_name"), F.col("p_name")), "phase": empty})
    return P.drop_empty_columns(rows, protect=["phase"])


@query("multiplicity", """
WITH v AS (SELECT 'c_name' AS variable, c_name AS x FROM customer UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
 UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer), c AS (SELECT variable, x, COUNT(*) AS n FROM v WHERE x IS NOT NULL GROUP BY 1,2)
SELECT variable, CAST(SUM(CASE WHEN n=1 THEN n ELSE 0 END) AS BIGINT) AS rows_once,
 CAST(SUM(CASE WHEN n>1 THEN n ELSE 0 END) AS BIGINT) AS rows_repeated, COUNT(*) AS "values" FROM c GROUP BY 1""")
def multiplicity(t):
    return A.multiplicity(t.customer, ["c_name", "c_acctbal", "c_mktsegment"])


@query("dup_values", "SELECT c_nationkey, c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1,2 HAVING COUNT(*) > 1")
def dup_values(t):
    return A.duplicate_values(t.customer, ["c_nationkey", "c_mktsegment"])


@query("duplicated_groups", """
SELECT * FROM (SELECT l.*, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS group_size,
 (SELECT COUNT(DISTINCT l_suppkey) FROM lineitem m WHERE m.l_orderkey=l.l_orderkey AND m.l_linenumber=l.l_linenumber) AS group_distinct
 FROM lineitem l) WHERE group_size > 1""")
def duplicated_groups(t):
    return W.duplicated_groups(t.lineitem, ["l_orderkey", "l_linenumber"], "l_suppkey")


@query("identifier_diagnostics", """
WITH e AS (SELECT event_type, CASE WHEN value < 5 THEN ' ' WHEN value < 10 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS id FROM events),
c AS (SELECT event_type, NULLIF(TRIM(id),'') AS id FROM e)
SELECT event_type, COUNT(*) AS total, COUNT(*) FILTER (id IS NULL) AS missing, COUNT(DISTINCT id) AS "unique",
 COUNT(id)-COUNT(DISTINCT id) AS duplicates FROM c GROUP BY 1
ORDER BY CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END, 1""")
def identifier_diagnostics(t):
    ident = F.when(F.col("value") < 5, " ").when(F.col("value") >= 10, F.col("user_id").cast("string"))
    return A.identifier_diagnostics(t.events.withColumn("id", ident), "event_type", "id", {"signup": 1, "purchase": 2})


@query("one_to_one", """
WITH p AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS yr, l_partkey AS a, l_suppkey AS b FROM lineitem),
q AS (SELECT *, COUNT(*) OVER (PARTITION BY yr,a) AS na, COUNT(*) OVER (PARTITION BY yr,b) AS nb FROM p)
SELECT yr, COUNT(DISTINCT a) AS l_partkey_ids, COUNT(DISTINCT CASE WHEN na>1 THEN a END) AS l_partkey_many,
 COUNT(DISTINCT b) AS l_suppkey_ids, COUNT(DISTINCT CASE WHEN nb>1 THEN b END) AS l_suppkey_many,
 COUNT(*) FILTER (na=1 AND nb=1) AS one_to_one FROM q GROUP BY 1""")
def one_to_one(t):
    return A.one_to_one(t.lineitem.withColumn("yr", F.year("l_shipdate")), "l_partkey", "l_suppkey", "yr")


@query("collect_set_size", """
SELECT COUNT(*) FILTER (k > 0) AS with_any, COUNT(*) FILTER (k = 0) AS without_any
FROM (SELECT user_id, COUNT(DISTINCT CASE WHEN value > 450 THEN event_type END) AS k FROM events GROUP BY 1)""")
def collect_set_size(t):
    per_user = A.groups_with_several(t.events, "user_id", "event_type", F.col("value") > 450)
    return per_user.agg(*A.count_where(with_any=F.col("values") > 0, without_any=F.col("values") == 0))


@query("totals_row", """
WITH y AS (SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS yr, COUNT(DISTINCT o_custkey) AS customers, COUNT(*) AS orders FROM orders GROUP BY 1)
SELECT yr, customers, orders FROM y UNION ALL SELECT 'Total', CAST(SUM(customers) AS BIGINT), CAST(SUM(orders) AS BIGINT) FROM y""")
def totals_row(t):
    yearly = orders(t).groupBy("yr").agg(F.count_distinct("o_custkey").alias("customers"), F.count(F.lit(1)).alias("orders"))
    return A.with_total_row(yearly, "yr")


@query("repeat_entries", """
SELECT c_mktsegment, CAST(SUM(GREATEST(y-1,0)) AS BIGINT) AS repeats FROM (SELECT c_mktsegment, o_custkey, COUNT(DISTINCT year(o_orderdate)) AS y
 FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1,2) GROUP BY 1""")
def repeat_entries(t):
    return A.repeat_entries(orders_customers(t), "o_custkey", "yr", "c_mktsegment")


@query("text_list", """
SELECT o_orderstatus, string_agg(e, ', ' ORDER BY e) AS items FROM (SELECT o_orderstatus, o_orderpriority || ': ' || COUNT(*) AS e
 FROM orders GROUP BY o_orderstatus, o_orderpriority) GROUP BY 1""")
def text_list(t):
    counts = A.count_by(t.orders, ["o_orderstatus", "o_orderpriority"])
    return A.text_list(counts, ["o_orderstatus"], "o_orderpriority", "n")


@query("share_within_group", """
SELECT o_orderstatus, o_orderpriority, n, ROUND(n::DOUBLE/SUM(n) OVER (PARTITION BY o_orderstatus), 6) AS share
FROM (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1,2)""")
def share_within_group(t):
    counts = A.count_by(t.orders, ["o_orderstatus", "o_orderpriority"])
    return _share(A.share_of_total(counts, "n", ["o_orderstatus"]))


@query("lump_small", """
WITH n AS (SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1), s AS (SELECT *, 100.0::DOUBLE*n/SUM(n) OVER () AS pct FROM n)
SELECT CASE WHEN pct < 4 THEN 'Other' ELSE p_brand END AS p_brand, CAST(SUM(n) AS BIGINT) AS n FROM s GROUP BY 1""")
def lump_small(t):
    return A.lump_small(A.count_by(t.part, ["p_brand"]), "p_brand", "n", 4.0)


@query("collapse_share", """
WITH n AS (SELECT c_mktsegment, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'urgent' ELSE o_orderpriority END AS o_orderpriority,
 COUNT(*) AS n FROM orders JOIN customer ON o_custkey=c_custkey WHERE o_orderpriority <> '5-LOW' GROUP BY 1,2)
SELECT *, ROUND(100.0::DOUBLE*n/SUM(n) OVER (PARTITION BY c_mktsegment), 6) AS share FROM n""")
def collapse_share(t):
    counts = A.count_by(orders_customers(t), ["c_mktsegment", "o_orderpriority"])
    return _share(A.collapse_share(counts, "o_orderpriority", "n", {"urgent": ["1-URGENT", "2-HIGH"]}, ["5-LOW"], ["c_mktsegment"]))


@query("cond_distinct", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(DISTINCT CASE WHEN o_orderstatus='F' THEN o_custkey END) AS f,
 COUNT(DISTINCT CASE WHEN o_totalprice>250000 THEN o_custkey END) AS big FROM orders GROUP BY 1""")
def cond_distinct(t):
    return A.distinct_where_by(orders(t), ["yr"], "o_custkey", f=F.col("o_orderstatus") == "F", big=F.col("o_totalprice") > 250000)


@query("mean_of_shares", """
SELECT yr, ROUND(AVG(h::DOUBLE/n), 6) AS mean_of_shares, ROUND(SUM(h)::DOUBLE/SUM(n), 6) AS share_of_total FROM
 (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, l_suppkey, COUNT(*) FILTER (l_returnflag='R') AS h, COUNT(*) AS n FROM lineitem GROUP BY 1,2) GROUP BY 1""")
def mean_of_shares(t):
    out = A.mean_of_shares(t.lineitem.withColumn("yr", F.year("l_shipdate")), "l_suppkey", "yr", F.col("l_returnflag") == "R")
    return _share(_share(out, "mean_of_shares"), "share_of_total")


@query("base_year_class", """
WITH s AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr, ROUND(100.0::DOUBLE*COUNT(*) FILTER (l_returnflag='R')/COUNT(*), 6) AS pct FROM lineitem GROUP BY 1,2),
b AS (SELECT l_suppkey, CASE WHEN pct<=30 THEN 'low' WHEN pct<=36 THEN 'middle' ELSE 'high' END AS band FROM s WHERE yr=1998)
SELECT s.*, b.band FROM s LEFT JOIN b USING (l_suppkey)""")
def base_year_class(t):
    yearly = A.share_where(t.lineitem.withColumn("yr", F.year("l_shipdate")), ["l_suppkey", "yr"], F.col("l_returnflag") == "R", "pct")
    pct = yearly.drop("n").withColumn("pct", F.round(F.col("pct") * 100, 6))
    return J.classify_in_base_year(pct, "l_suppkey", "yr", 1998, "pct", [(30, "low"), (36, "middle")], "high")


@query("status_priority", """
WITH s AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CASE o_orderstatus WHEN 'F' THEN 'ADMITTED' WHEN 'O' THEN 'NOT SELECTED' ELSE 'TC TAKEN' END AS status FROM orders)
SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, yr ORDER BY CASE status WHEN 'ADMITTED' THEN 4 WHEN 'TC TAKEN' THEN 3 ELSE 1 END DESC, o_orderkey)=1""")
def status_priority(t):
    names = F.when(F.col("o_orderstatus") == "F", "ADMITTED").when(F.col("o_orderstatus") == "O", "NOT SELECTED").otherwise("TC TAKEN")
    rows = orders(t).select("o_orderkey", "o_custkey", "yr", names.alias("status"))
    return W.best_status_rows(rows, ["o_custkey", "yr"], C.status_rank(F.col("status")), ["o_orderkey"])


@query("topk_per_group", "SELECT * FROM part QUALIFY ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)<=3")
def topk_per_group(t):
    return W.top_rows(t.part, ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 3)


@query("topk_ties", """
SELECT *, CAST(RANK() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS INTEGER) AS place FROM part QUALIFY RANK() OVER (PARTITION BY p_brand ORDER BY p_size DESC)<=2""")
def topk_ties(t):
    return W.top_rows(t.part, ["p_brand"], [F.desc("p_size")], 2, ties=True, rank_as="place")


@query("rank_number", """
SELECT c_nationkey, c_custkey, c_acctbal, CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS place
FROM customer QUALIFY place <= 10""")
def rank_number(t):
    rows = t.customer.select("c_nationkey", "c_custkey", "c_acctbal")
    return W.top_rows(rows, ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 10, rank_as="place")


@query("top_with_ties", "SELECT * FROM (SELECT p_partkey, p_size FROM part) QUALIFY RANK() OVER (ORDER BY p_size DESC) <= 5")
def top_with_ties(t):
    return W.top_overall_with_ties(t.part.select("p_partkey", "p_size"), "p_size", 5)


@query("bottom_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def bottom_n(t):
    return W.top_overall(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 10)


@query("keep_first", """
SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice)=1""")
def keep_first(t):
    return W.first_rows(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice"])


@query("group_count_max", """
SELECT l_orderkey, l_linenumber, l_partkey, COUNT(l_linenumber) OVER (PARTITION BY l_orderkey) AS num_options,
 MAX(l_linenumber) OVER (PARTITION BY l_orderkey) AS highest FROM lineitem""")
def group_count_max(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return W.with_group_values(rows, ["l_orderkey"], {"num_options": F.count("l_linenumber"), "highest": F.max("l_linenumber")})


@query("yoy", """
WITH y AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(SUM(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1,2)
SELECT *, ROUND((quantity/LAG(quantity) OVER (PARTITION BY l_returnflag ORDER BY yr)-1)*100, 6) AS growth_pct FROM y""")
def yoy(t):
    yearly = t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("yr")).agg(F.sum("l_quantity").alias("quantity"))
    return _share(W.change_on_previous(yearly, ["l_returnflag"], "yr", "quantity"), "growth_pct")


@query("sequence_gap", """
WITH k AS (SELECT l_orderkey, CASE WHEN l_tax >= 0.02 THEN l_linenumber END AS n FROM lineitem WHERE l_returnflag <> 'R'),
g AS (SELECT l_orderkey, COUNT(*) AS rows, COUNT(n) AS filled, MAX(n) AS high, COUNT(DISTINCT n) AS "distinct" FROM k GROUP BY 1)
SELECT *, CASE WHEN COALESCE("distinct" < high, FALSE) AND filled = rows THEN 'Gap in sequence'
 WHEN filled < rows AND NOT COALESCE("distinct" < high, FALSE) THEN 'Ends with NaN' ELSE 'Complete sequence' END AS status,
 filled = COALESCE(high,0) AND "distinct" = filled AS exact FROM g""")
def sequence_gap(t):
    rows = t.lineitem.where("l_returnflag <> 'R'").select("l_orderkey", F.when(F.col("l_tax") >= 0.02, F.col("l_linenumber")).cast("string").alias("n"))
    return W.sequence_class(rows, ["l_orderkey"], "n")


@query("left_right_full", """
WITH o AS (SELECT o_custkey AS k, COUNT(*) AS orders FROM orders WHERE o_totalprice > 450000 GROUP BY 1),
c AS (SELECT c_custkey AS k, c_acctbal FROM customer WHERE c_acctbal > 5000)
SELECT k, COALESCE(orders, 0) AS orders, COALESCE(c_acctbal, 0) AS c_acctbal FROM o FULL OUTER JOIN c USING (k)""")
def left_right_full(t):
    o = t.orders.where("o_totalprice > 450000").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("orders"))
    c = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), "c_acctbal")
    return J.outer_fill([o, c], ["k"])


@query("left_lookup", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey=n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey")
def left_lookup(t):
    places = J.lookup(t.nation, t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return J.lookup(t.supplier, places.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").select("s_suppkey", "n_name", "r_name")


@query("right_join", """
SELECT n_name, v.s_nationkey, v.suppliers FROM (SELECT * FROM nation WHERE n_regionkey < 3) n
RIGHT JOIN (SELECT s_nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1) v ON n.n_nationkey=v.s_nationkey""")
def right_join(t):
    counts = A.count_by(t.supplier, ["s_nationkey"], "suppliers")
    return J.join_renamed(t.nation.where("n_regionkey < 3"), counts, {"n_nationkey": "s_nationkey"}, "right").select("n_name", "s_nationkey", "suppliers")


@query("semi_anti", """
SELECT c_custkey, 'with' AS kind FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_totalprice>490000)
UNION ALL SELECT c_custkey, 'without' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_totalprice>490000)""")
def semi_anti(t):
    big = t.orders.where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey"))
    part = lambda keep, name: J.rows_of_groups(t.customer.select("c_custkey"), big, ["c_custkey"], keep).withColumn("kind", F.lit(name))
    return U.stack([part(True, "with"), part(False, "without")])


@query("composite_left_filter", """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity, b.bound FROM lineitem l
JOIN (SELECT l_partkey, l_suppkey, l_returnflag, AVG(l_quantity) AS bound FROM lineitem GROUP BY 1,2,3) b
 ON l.l_partkey=b.l_partkey AND l.l_suppkey=b.l_suppkey AND l.l_returnflag=b.l_returnflag WHERE l.l_quantity > b.bound""")
def composite_left_filter(t):
    keys = {"l_partkey": "b_part", "l_suppkey": "b_supp", "l_returnflag": "b_flag"}
    bounds = t.lineitem.groupBy(*keys).agg(F.avg("l_quantity").alias("bound")).withColumnsRenamed(keys)
    joined = J.join_renamed(t.lineitem, bounds, keys)
    return joined.where("l_quantity > bound").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "bound")


@query("null_safe_join", f"""
WITH a AS (SELECT p_type, COUNT(*) AS n FROM ({GAPS}) GROUP BY 1), b AS (SELECT p_type, MAX(p_size) AS biggest FROM ({GAPS}) GROUP BY 1)
SELECT a.p_type, n, biggest FROM a JOIN b ON a.p_type IS NOT DISTINCT FROM b.p_type""")
def null_safe_join(t):
    parts = parts_with_gaps(t)
    a = parts.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    b = parts.groupBy("p_type").agg(F.max("p_size").alias("biggest"))
    return J.join_null_safe(a, b, ["p_type"])


@query("alias_join", """
SELECT CASE p_type WHEN 'PROMO' THEN 'OFFER' WHEN 'ECONOMY' THEN 'BUDGET' ELSE p_type END AS p_type, COUNT(*) AS n FROM part GROUP BY 1""")
def alias_join(t):
    named = F.when(F.col("p_type") == "PROMO", "OFFER").when(F.col("p_type") == "ECONOMY", "BUDGET")
    aliases = t.part.select(F.col("p_type").alias("alias"), named.alias("canonical")).distinct().where("canonical is not null")
    return A.count_by(J.with_alias(t.part, "p_type", aliases), ["p_type"])


@query("per_capita", """
WITH s AS (SELECT s_nationkey AS k, COUNT(*) AS suppliers FROM supplier GROUP BY 1), c AS (SELECT c_nationkey AS k, COUNT(*) AS population FROM customer GROUP BY 1)
SELECT k, suppliers, population, ROUND(1000.0::DOUBLE*suppliers/population, 6) AS per_capita FROM s LEFT JOIN c USING (k)""")
def per_capita(t):
    s = A.count_by(t.supplier.withColumnRenamed("s_nationkey", "k"), ["k"], "suppliers")
    c = A.count_by(t.customer.withColumnRenamed("c_nationkey", "k"), ["k"], "population")
    return _share(J.per_capita(s, c, ["k"], "suppliers", 1000.0), "per_capita")


@query("supply_demand", """
WITH s AS (SELECT p_brand, CAST(SUM(p_size) AS BIGINT) AS seats FROM part GROUP BY 1),
d AS (SELECT p_brand, COUNT(DISTINCT o_custkey) AS applicants FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey WHERE l_linenumber=1 GROUP BY 1),
j AS (SELECT p_brand, COALESCE(seats,0) AS seats, COALESCE(applicants,0) AS applicants FROM s FULL OUTER JOIN d USING (p_brand))
SELECT *, seats-applicants AS available_seats, GREATEST(seats-applicants,0) AS clipped,
 CASE WHEN applicants > seats*1.1 THEN 'Overutilized' WHEN applicants < seats*0.9 THEN 'Underutilized' ELSE 'Balanced' END AS utilisation FROM j""")
def supply_demand(t):
    seats = A.sum_by(t.part, ["p_brand"], ["p_size"]).withColumnRenamed("p_size", "seats")
    first = t.lineitem.where("l_linenumber = 1").join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    both = J.outer_fill([seats, A.count_distinct_by(first, ["p_brand"], "o_custkey", "applicants")], ["p_brand"])
    s, a = F.col("seats"), F.col("applicants")
    return both.withColumns({"available_seats": V.available_seats(s, a), "clipped": V.available_seats(s, a, True),
                             "utilisation": V.utilisation_class(a, s)})


@query("flow_matrix", """
WITH f AS (SELECT c.n_name AS home, s.n_name AS away, COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN nation c ON c_nationkey=c.n_nationkey JOIN supplier ON l_suppkey=s_suppkey JOIN nation s ON s_nationkey=s.n_nationkey GROUP BY 1,2)
SELECT *, ROUND(100.0::DOUBLE*n/SUM(n) OVER (PARTITION BY home), 6) AS leavers_pct, ROUND(100.0::DOUBLE*n/SUM(n) OVER (PARTITION BY away), 6) AS receivers_pct FROM f""")
def flow_matrix(t):
    return _share(_share(A.flow_matrix(moves(t), "home", "away"), "leavers_pct"), "receivers_pct")


def moves(t: Tables):
    home = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home"))
    away = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away"))
    people = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    places = t.supplier.select("s_suppkey", "s_nationkey")
    return t.lineitem.select("l_orderkey", "l_suppkey").join(people, F.col("l_orderkey") == F.col("o_orderkey")).join(
        places, F.col("l_suppkey") == F.col("s_suppkey")).join(home, "c_nationkey").join(away, "s_nationkey").select("home", "away")


@query("flow_net", """
WITH m AS (SELECT c.n_name AS home, s.n_name AS away FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN nation c ON c_nationkey=c.n_nationkey JOIN supplier ON l_suppkey=s_suppkey JOIN nation s ON s_nationkey=s.n_nationkey WHERE c.n_name<>s.n_name),
o AS (SELECT home AS place, COUNT(*) AS outgoing FROM m GROUP BY 1), i AS (SELECT away AS place, COUNT(*) AS incoming FROM m GROUP BY 1),
j AS (SELECT place, COALESCE(outgoing,0) AS outgoing, COALESCE(incoming,0) AS incoming FROM o FULL OUTER JOIN i USING (place))
SELECT *, outgoing-incoming AS net, CASE WHEN outgoing>incoming THEN 'loses' WHEN outgoing<incoming THEN 'gains' ELSE 'even' END AS direction FROM j""")
def flow_net(t):
    return A.net_flow(moves(t), "home", "away")


@query("funnel", """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS batch FROM orders GROUP BY 1),
f AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS admitted FROM orders WHERE o_orderstatus='F' GROUP BY 1),
p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS pending FROM orders WHERE o_orderstatus='P' AND o_totalprice>480000 GROUP BY 1)
SELECT yr, COALESCE(batch,0) AS batch, COALESCE(admitted,0) AS admitted, COALESCE(pending,0) AS pending,
 COALESCE(batch,0)-(COALESCE(admitted,0)+COALESCE(pending,0)) AS residual FROM o FULL OUTER JOIN f USING (yr) FULL OUTER JOIN p USING (yr)""")
def funnel(t):
    stage = lambda rows, name: A.count_by(rows, ["yr"], name)
    batch = stage(orders(t), "batch").withColumn("batch", F.format_number("batch", 0))
    stages = [batch, stage(orders(t).where("o_orderstatus = 'F'"), "admitted"),
              stage(orders(t).where("o_orderstatus = 'P' and o_totalprice > 480000"), "pending")]
    return A.funnel(stages, "yr", "batch", ["admitted", "pending"])


@query("set_ops", """
SELECT 'missing' AS kind, n FROM (SELECT replace(p_name,' ','') AS n FROM part WHERE p_size>48 EXCEPT SELECT replace(p_name,' ','') FROM part WHERE p_size<2)
UNION ALL SELECT 'any', n FROM (SELECT p_type AS n FROM part UNION SELECT p_brand FROM part)""")
def set_ops(t):
    missing = U.names_missing(t.part.where("p_size > 48"), t.part.where("p_size < 2"), "p_name").select(F.lit("missing").alias("kind"), F.col("p_name").alias("n"))
    anywhere = U.distinct_values([(t.part, "p_type"), (t.part, "p_brand")], "n", across=True).select(F.lit("any").alias("kind"), "n")
    return missing.unionByName(anywhere)


@query("union_by_name", """
SELECT c_custkey AS k, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def union_by_name(t):
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return U.stack([c, t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"))])


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("institute_mix", """
WITH c AS (SELECT l_orderkey, COUNT(*) FILTER (s_acctbal>=5000) AS g, COUNT(*) FILTER (s_acctbal<1000) AS p, COUNT(*) AS n
 FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1)
SELECT l_orderkey, CASE WHEN g=n THEN 'Govt' WHEN p=n THEN 'Pvt' WHEN g>0 AND p>0 THEN 'Mix' END AS mix FROM c""")
def institute_mix(t):
    kind = F.when(F.col("s_acctbal") >= 5000, "Govt.").when(F.col("s_acctbal") < 1000, "Pvt.")
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("kind", kind)
    return U.mix_by(rows, ["l_orderkey"], "s_name", "kind")


@query("predicates", """
SELECT p_partkey, p_name, p_type IN ('PROMO','SMALL') AS listed, contains(p_name,'widget') AS has_word, regexp_matches(p_name, '(?i)BOLT|gear') AS any_word,
 starts_with(p_brand,'Brand#1') AS starts, p_size BETWEEN 10 AND 20 AS middle, p_type IS NULL OR p_name IS NULL AS any_missing,
 regexp_matches(p_brand,'[[:space:][:punct:]]') AS marked
FROM part""")
def predicates(t):
    from rollbook.functions.text import has_blank_or_punctuation

    name = F.col("p_name")
    return t.part.select(
        "p_partkey", "p_name", F.col("p_type").isin("PROMO", "SMALL").alias("listed"), name.contains("widget").alias("has_word"),
        P.contains_any_case(name, ["bolt", "GEAR"]).alias("any_word"), F.col("p_brand").startswith("Brand#1").alias("starts"),
        F.col("p_size").between(10, 20).alias("middle"), P.any_null(["p_type", "p_name"]).alias("any_missing"),
        has_blank_or_punctuation(F.col("p_brand")).alias("marked"))


@query("denylist", """
SELECT * FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey=2)""")
def denylist(t):
    listed = t.nation.where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return J.rows_of_groups(t.supplier, listed, ["s_nationkey"], keep=False)


@query("marks_consistency", """
SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_discount FROM lineitem
WHERE abs(l_quantity/50*100 - l_discount*1000) > 1""")
def marks_consistency(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    bad = P.percentage_mismatch(F.col("l_discount") * 1000, F.col("l_quantity"), F.lit(50), 1.0)
    return rows.where(bad)


@query("required_fields", f"""
SELECT p_size, p_type IS NULL OR p_type IN ('',' ','NA') OR p_name IS NULL OR p_name IN ('',' ','NA') OR p_brand IN ('',' ','NA') AS lacking, COUNT(*) AS n
FROM ({GAPS}) GROUP BY 1,2""")
def required_fields(t):
    rows = parts_with_gaps(t).withColumn("lacking", P.lacks_required(["p_type", "p_name", "p_brand"]))
    return A.count_by(rows, ["p_size", "lacking"])


@query("conform_schema", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS dob FROM customer")
def conform_schema(t):
    rows = t.customer.withColumn("c_custkey", F.col("c_custkey").cast("string"))
    return P.conform(rows, ["id", "name", "dob"], {"c_custkey": "id", "c_name": "name"})


@query("column_choice", "SELECT c_mktsegment, c_custkey, c_name, c_acctbal FROM customer")
def column_choice(t):
    kept = P.keep_existing(t.customer, ["c_custkey", "c_name", "unknown", "c_acctbal", "c_mktsegment"])
    return P.order_columns(kept, ["c_mktsegment", "absent"])


@query("rename_columns", "SELECT n_nationkey AS nation_key, n_name AS nation_name FROM nation")
def rename_columns(t):
    return P.rename_all(t.nation.select(F.col("n_nationkey").alias("NationKey"), F.col("n_name").alias("NationName")))


@query("custom_order", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, 1""")
def custom_order(t):
    place = F.when(F.col("o_orderpriority") == "5-LOW", 1).when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(3)
    return A.count_by(t.orders, ["o_orderpriority"]).orderBy(place, "o_orderpriority")


@query("sql_view", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def sql_view(t):
    from rollbook.sources.catalog import sql_over

    return sql_over(t.spark, {"placed": t.orders}, "SELECT o_orderstatus, COUNT(*) AS n FROM placed GROUP BY 1")


@query("load_report", """
SELECT COUNT(*) AS rows, CAST(6 AS INTEGER) AS fields, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM orders)) AS distinct_rows, CAST(NULL AS BIGINT) AS expected FROM orders""")
def load_report(t):
    return A.load_report(t.orders)


@query("inventory", """
SELECT 'nation' AS dataset, COUNT(*) AS rows, 3 AS fields, 'n_nationkey, n_name, n_regionkey' AS columns FROM nation
UNION ALL SELECT 'orders', COUNT(*), 6, 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' FROM orders""")
def inventory(t):
    from rollbook.sources.catalog import inventory as listed

    return listed(t.spark, {"nation": t.nation, "orders": t.orders})


@query("row_sample", "SELECT * FROM orders WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT < 429496729")
def row_sample(t):
    """A sampling operator; a digest of the key decides."""
    return P.row_sample(t.orders, 0.1, by=["o_orderkey"])
