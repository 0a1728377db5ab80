"""Properties of the operators on small random frames."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollbook.operators import aggregate as A, payloads as PL, reshape as R, windows as W
from rollbook.operators import fuzzy as Z, sets as U
from rollbook.operators.quantiles import count_values, distribution, quantiles
from rollbook.operators.spatial import points_in_polygons, within_any
from rollbook.functions.similarity import indel_ratio, osa_distance


@pytest.mark.parametrize("shape", ["skewed", "equal", "even", "single"])
def test_quantiles_match_numpy(spark, shape):
    rng = np.random.default_rng(3)
    values = {"skewed": np.exp(rng.normal(0, 4, 500)), "equal": np.full(50, 7.5), "even": np.arange(400) / 3, "single": np.array([4.0])}[shape]
    pdf = pd.DataFrame({"g": ["a"] * len(values) + ["b"] * len(values), "v": np.concatenate([values, -values])})
    df = spark.createDataFrame(pdf)
    probs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q9": 0.99, "q10": 1.0}
    for row in quantiles(df, "v", ["g"], probs).collect():
        want = np.quantile(values if row["g"] == "a" else -values, list(probs.values()))
        assert np.allclose([row[k] for k in probs], want)
    assert not quantiles(df.withColumn("v", F.lit(None).cast("double")), "v", ["g"], probs).where("q2 is not null").count()
    total = quantiles(df, "v", [], probs).first()
    assert np.allclose([total[k] for k in probs], np.quantile(pdf.v, list(probs.values())))


def test_summary_matches_pandas(spark):
    rng = random.Random(1)
    pdf = pd.DataFrame({"g": [rng.choice("xyz") for _ in range(300)], "v": [round(rng.random() * 100, 2) for _ in range(300)]})
    got = A.summary_stats(spark.createDataFrame(pdf), "v", "g", "G").toPandas().set_index("G").sort_index()
    want = pdf.groupby("g")["v"].agg(["mean", "std", lambda x: x.quantile(0.25), "median", lambda x: x.quantile(0.75), "count"]).round(1)
    assert np.allclose(got[["Mean", "Std", "25th", "Median", "75th", "Count"]].to_numpy(float), want.to_numpy(float))


def test_distribution_is_stable_far_from_zero(spark):
    values = 1e9 + np.arange(1000) / 10
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "v": values}))
    row = distribution(count_values(df, "v", ["g"]), ["g"], {"m": 0.5}).first()
    assert row["n"] == 1000 and abs(row["mean"] - values.mean()) < 1e-5 and abs(row["std"] - values.std(ddof=1)) < 1e-4 and abs(row["m"] - np.median(values)) < 1e-6
    empty = df.withColumn("v", F.when(F.lit(False), F.col("v")))
    assert distribution(count_values(empty, "v", ["g"]), ["g"], {"m": 0.5}).first()["n"] == 0


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "k string, v int")
    assert [tuple(r) for r in A.count_by(df, ["k"]).collect()] == [("a", 2)]
    assert A.value_counts(df, "k").count() == 2


def test_pivot_total_is_ungrouped_total(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice("ab"), rng.choice(["Govt.", "Pvt."]), i) for i in range(100)], "k string, c string, v int")
    table = R.with_row_total(R.pivot_count(df, ["k"], "c"), ["k"])
    assert table.agg(F.sum("Total")).first()[0] == 100
    assert table.columns == ["k", "Total", "Govt.", "Pvt."]
    shares = R.row_percentages(R.pivot_count(df, ["k"], "c", ["Govt.", "Pvt."]), ["Govt.", "Pvt."], "n", ["g", "p"], [6, 6])
    assert all(abs(r["g"] + r["p"] - 100) < 1e-4 for r in shares.collect())
    with pytest.raises(ValueError):
        R.row_percentages(table, ["Govt."], "n", ["a", "b"], [1])


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([(k, v) for k in "abc" for v in range(1, 9)], "k string, v int")
    assert all(abs(r[1] - 1) < 1e-9 for r in A.share_of_total(df, "v", ["k"]).groupBy("k").agg(F.sum("share")).collect())
    assert abs(A.share_of_total(df, "v").agg(F.sum("share")).first()[0] - 1) < 1e-9


def test_explode_keeps_every_row(spark):
    texts = [None, "null", "[]", "", "junk", '[{"A":"1"},{"A":"2"}]', "[null]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    assert PL.explode_records(df, "j", ["A"], ["i"]).count() == 8
    assert PL.explode_records(df, "j", ["A"], ["i"], keep_empty=False).count() == 3


def test_map_keys_are_the_union(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":2}'), (2, '{"b":3,"c":null}'), (3, None)], "i int, j string")
    want = {(i, k, v) for i, vs in {1: ("1", "2", None), 2: (None, "3", None), 3: (None, None, None)}.items() for k, v in zip("abc", vs)}
    assert {tuple(r) for r in PL.map_to_long(df, "j", ["i"], "k", "v").collect()} == want
    assert {tuple(r) for r in PL.map_to_long(df, "j", ["i"], "k", "v", pieces=3).collect()} == want


def test_cutoff_list_is_unpivoted(spark):
    df = spark.createDataFrame([("S", '[{"SelectionStage":"1","x":"5","y":"6"}]')], "s string, j string")
    out = {tuple(r) for r in PL.list_to_long(df, "j", ["s"], "SelectionStage", "stage", "kind", "cut").collect()}
    assert out == {("S", "1", "x", "5"), ("S", "1", "y", "6")}


def test_first_row_plan_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.lit(1) * (F.col("id") > 10).cast("int"))
    plan = W.first_rows(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ties_are_kept(spark):
    df = spark.createDataFrame([(1, 9), (2, 8), (3, 8), (4, 1), (5, None)], "i int, v int")
    assert {r["i"] for r in W.top_overall_with_ties(df, "v", 2).collect()} == {1, 2, 3}


def test_sequences(spark):
    rows = [("a", "1"), ("a", "2"), ("b", "1"), ("b", "3"), ("c", "1"), ("c", None), ("d", "1"), ("d", "1"), ("e", "2"), ("e", None)]
    out = {r["k"]: (r["status"], r["exact"]) for r in W.sequence_class(spark.createDataFrame(rows, "k string, n string"), ["k"], "n").collect()}
    assert out == {"a": ("Complete sequence", True), "b": ("Gap in sequence", False), "c": ("Ends with NaN", True),
                   "d": ("Complete sequence", False), "e": ("Complete sequence", False)}


def test_institute_mix(spark):
    rows = [("a", "x", "Govt."), ("a", "y", "Govt."), ("b", "x", "Govt."), ("b", "z", "Pvt."), ("c", "z", "Pvt."), ("d", "q", None), ("e", "x", "Govt."), ("e", "q", None)]
    out = dict(U.mix_by(spark.createDataFrame(rows, "k string, n string, t string"), ["k"], "n", "t").collect())
    assert out == {"a": "Govt", "b": "Mix", "c": "Pvt", "d": None, "e": None}


def _words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(n)})


@pytest.mark.parametrize("threshold", [50, 70, 80, 95])
def test_similar_pairs_equal_brute_force(spark, threshold):
    left, right = _words(1, 60), _words(2, 60)
    df = lambda ws: spark.createDataFrame([(w,) for w in ws], "w string")
    got = {(r["text"], r["choice"]) for r in Z.similar_pairs(df(left), df(right), "w", [], Z.ratio_rule(threshold)).collect()}
    assert got == {(a, b) for a in left for b in right if indel_ratio(a, b) >= threshold}


@pytest.mark.parametrize("bound", [1, 3])
def test_osa_pairs_equal_brute_force(spark, bound):
    left, right = _words(3, 50), _words(4, 50)
    df = lambda ws: spark.createDataFrame([(w,) for w in ws], "w string")
    got = {(r["text"], r["choice"], r["score"]) for r in Z.similar_pairs(df(left), df(right), "w", [], Z.osa_rule(bound)).collect()}
    assert got == {(a, b, osa_distance(a, b)) for a in left for b in right if osa_distance(a, b) <= bound}


def test_best_match_equals_brute_force(spark):
    left, right = _words(5, 60), _words(6, 60)
    df = lambda ws: spark.createDataFrame([(w,) for w in ws], "w string")
    got = {r["w"]: r["found"] for r in Z.best_fuzzy_match(df(left), "w", df(right), 60, "found").collect()}
    for a in left:
        score, best = min((-indel_ratio(a, b), b) for b in right)
        assert got[a] == (best if -score >= 60 else None)


def test_best_match_literals(spark):
    choices = spark.createDataFrame([("apple",), ("banana",), ("grape",)], "w string")
    words = spark.createDataFrame([("appl",), ("bananas",), ("unknown",), ("",), (None,)], "w string")
    out = {r["w"]: r["m"] for r in Z.best_fuzzy_match(words, "w", choices, 80, "m").collect()}
    assert out == {"appl": "apple", "bananas": "banana", "unknown": None, "": None, None: None}
    assert Z.best_fuzzy_match(spark.createDataFrame([("grape",)], "w string"), "w", choices, 90, "m").first()["m"] == "grape"


def test_fuzzy_join_literals(spark):
    left = spark.createDataFrame([("A", "apple"), ("A", "banana"), ("B", "grape")], "g string, w string")
    right = spark.createDataFrame([("A", "appl", 10), ("A", "bananas", 20), ("B", "grapes", 30)], "g string, w string, v int")
    assert {r["v"] for r in Z.fuzzy_join(left, right, "w", ["g"]).collect()} == {10, 20, 30}
    apart = right.withColumn("g", F.lit("C"))
    assert [r["v"] for r in Z.fuzzy_join(left, apart, "w", ["g"]).collect()] == [None] * 3
    doubled = spark.createDataFrame([("A", "appl", 10), ("A", "appl", 20)], "g string, w string, v int")
    assert Z.fuzzy_join(left.where("w = 'apple'"), doubled, "w", ["g"]).count() == 2


def _inside(x, y, ring):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and (x2 - x1) * (y - y1) / (y2 - y1) + x1 > x:
            hit = not hit
    return hit


@pytest.mark.parametrize("cell", [None, 0.3, 1.0, 50.0])
def test_points_in_polygons_equal_brute_force(spark, cell):
    rng = random.Random(9)
    rings = {f"p{i}": [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(rng.randint(3, 7))] for i in range(6)}
    edges = [(p, 0, *a, *b) for p, ring in rings.items() for a, b in zip(ring, ring[1:] + ring[:1])]
    points = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(150)]
    edge_df = spark.createDataFrame(edges, "poly_id string, ring int, x1 double, y1 double, x2 double, y2 double")
    point_df = spark.createDataFrame(points, "i int, x double, y double")
    got = {(round(r["x"], 9), r["poly_id"]) for r in points_in_polygons(point_df, edge_df, "x", "y", cell).collect()}
    want = {(round(x, 9), p) for _, x, y in points for p, ring in rings.items() if _inside(x, y, ring)}
    assert got == want
    assert within_any(point_df, edge_df, "x", "y", cell).count() == len({x for x, _ in want})


def _wavy(n, seed=0, dense=0.0):
    """A closed ring of n edges around the origin; a part of ``dense`` of them runs back and forth in a small place."""
    rng = random.Random(seed)
    k = int(n * dense)
    angles = [2 * math.pi * i / (n - k) for i in range(n - k)]
    ring = [((5 + math.sin(40 * a) + rng.uniform(-10, 10) / n) * math.cos(a), (5 + math.sin(40 * a)) * math.sin(a)) for a in angles]
    x, y = ring[-1]
    return ring + [(x + 0.01 * math.cos(i * 2.4) * i / max(k, 1), y + 0.01 * math.sin(i * 2.4) * i / max(k, 1)) for i in range(k)]


def _edges(spark, rings):
    rows = [(p, n, *a, *b) for p, parts in rings.items() for n, ring in enumerate(parts) for a, b in zip(ring, ring[1:] + ring[:1])]
    return spark.createDataFrame(rows, "poly_id string, ring int, x1 double, y1 double, x2 double, y2 double")


def test_cover_grows_with_the_edges(spark):
    from rollbook.operators.spatial import cover

    for n in (1000, 100000):
        found = cover(_edges(spark, {"p": [_wavy(n)]}))
        assert found.edges.count() < 3 * n and found.inside.count() < n
        assert found.edges.groupBy("poly_id", "_k", "_cx", "_cy").count().agg(F.max("count")).first()[0] <= 8


def test_cover_of_dense_places_holes_and_straight_borders(spark):
    hole = [(x / 3, y / 3) for x, y in _wavy(60, 2)]
    grid = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]
    star = [p for i in range(40) for p in ((0.0, 0.0), (3 * math.cos(i), 3 * math.sin(i)), (3 * math.cos(i + 0.05), 3 * math.sin(i + 0.05)))]
    rings = {"wavy": [_wavy(400, 1, 0.5), hole], "grid": [grid], "star": [star], "far": [[(x + 900.5, y - 77.1) for x, y in grid]], "flat": [[(1.0, 1.0), (2.0, 1.0)]]}
    rng = random.Random(3)
    spots = [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(300)] + [(x / 2, y / 2) for x in range(-2, 10) for y in range(-2, 10)]
    spots += [(x + 900.5, y - 77.1) for x, y in spots[-144:]] + [(_x + 1e-4, _y) for _x, _y in rings["wavy"][0][200:400:5]] + [(1e9, 0.0), (float("nan"), 0.0)]
    got = {tuple(r) for r in points_in_polygons(spark.createDataFrame(spots, "x double, y double"), _edges(spark, rings), "x", "y").collect()}

    def inside(x, y, parts):
        odd = False
        for ring in parts:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > y) != (y2 > y) and (x2 - x1) * (y - y1) / (y2 - y1) + x1 > x:
                    odd = not odd
        return odd

    want = {(x, y, p) for x, y in spots for p, parts in rings.items() if inside(x, y, parts)}
    assert got == want and len({p for _, _, p in want}) == 4


def test_points_without_polygons(spark):
    points = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    edges = _edges(spark, {"p": [[(0.0, 0.0), (1.0, 0.0)]]})
    assert points_in_polygons(points, edges.limit(0), "x", "y").columns == ["x", "y", "poly_id"]
    assert points_in_polygons(points, edges.limit(0), "x", "y").count() == 0 == points_in_polygons(points.limit(0), edges, "x", "y").count()


def test_scores_equal_the_plain_functions(spark):
    from rollbook.functions.similarity import indel_ratio_column, osa_distance_column

    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcé漢🙂 d") for _ in range(n))
    sizes = [0, 1, 2, 3, 5, 20, 59, 60, 61, 130]
    rows = [(word(rng.choice(sizes)), word(rng.choice(sizes))) for _ in range(150)]
    for _ in range(200):
        a = word(rng.choice([1, 2, 3, 5, 9, 20, 70]))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k, kind = rng.randrange(len(b) + 1), rng.random()
            if kind < 0.4 and k + 1 < len(b):
                b[k], b[k + 1] = b[k + 1], b[k]
            elif kind < 0.7:
                b.insert(k, rng.choice("abx"))
            else:
                del b[k : k + 1]
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    for r in df.select("a", "b", indel_ratio_column(a, b).alias("r"), osa_distance_column(a, b, 3).alias("d"), osa_distance_column(a, b, 0).alias("e")).collect():
        assert abs(r.r - indel_ratio(r.a, r.b)) < 1e-9
        assert r.d == min(4, osa_distance(r.a, r.b)) and r.e == int(r.a != r.b)


def test_short_names_take_the_first_of_the_nearest(spark):
    rng = random.Random(8)
    names = sorted({"".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 3, 4, 7]))) for _ in range(250)})
    choices, asked = names[::2], [*names[1::2], "zzz", "y", "zzzzzzzz", "", None]
    left = spark.createDataFrame([(t,) for t in asked], "w string")
    out = Z.best_osa_match(left, "w", spark.createDataFrame([(t,) for t in choices], "w string"), 3, "found")
    want = {}
    for t in asked:
        near = [(osa_distance(t, c), c) for c in choices] if t else []
        want[t] = min((x for x in near if x[0] <= 3), default=(0, None))[1]
    assert {r.w: r.found for r in out.collect()} == want


def test_best_matches_run_without_python(spark):
    df = spark.createDataFrame([("abcd", "x"), ("abdc", "x")], "w string, k string")
    for out in (Z.best_fuzzy_match(df, "w", df.select("w")), Z.best_osa_match(df, "w", df.select("w")), Z.fuzzy_join(df, df, "w", ["k"])):
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_and_totals_read_their_rows_once(spark):
    rows = [("a", 1, 5), ("a", 1, 50), ("a", 2, 7), ("b", 2, 70), ("b", None, 90), ("c", 3, 1), (None, 4, 99)]
    df = spark.createDataFrame(rows, "k string, v int, x int")
    out = A.distinct_where_by(df, ["k"], "v", every="all", big=F.col("x") > 40, odd=F.col("x") % 2 == 1)
    assert {tuple(r) for r in out.select("k", "big", "odd", "all").collect() if r.k} == {("a", 1, 2, 2), ("b", 1, 0, 1), ("c", 0, 1, 1)}
    counted = df.where("k is not null").groupBy("k").agg(F.count("v").alias("n"), F.sum("x").alias("s"))
    table = A.with_total_row(counted, "k")
    assert {tuple(r) for r in table.collect()} == {("a", 3, 62), ("b", 1, 160), ("c", 1, 1), ("Total", 5, 223)}
    assert table._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert [tuple(r) for r in A.with_total_row(counted.limit(0), "k").collect()] == [("Total", None, None)]


def test_one_to_one(spark):
    rows = [(1, "a", "x"), (1, "b", "y"), (1, "b", "z"), (1, "c", "w"), (1, "d", "w"), (2, "a", "x"), (2, None, "x")]
    out = {r["g"]: r.asDict() for r in A.one_to_one(spark.createDataFrame(rows, "g int, p string, q string"), "p", "q", "g").collect()}
    assert out[1]["one_to_one"] == 1 and out[1]["p_many"] == 1 and out[1]["q_many"] == 1 and out[2]["one_to_one"] == 1


def test_bins_take_the_lowest_edge(spark):
    df = spark.createDataFrame([(1,), (5,), (6,), (0,)], "v int")
    label = lambda lowest: A.bin_label(F.col("v"), [1, 5, 10], ["1-5", "6-10"], lowest)
    assert [r[0] for r in df.select(label(True)).collect()] == ["1-5", "1-5", "6-10", None]
    assert [r[0] for r in df.select(label(False)).collect()] == [None, "1-5", "6-10", None]


def test_totals_count_values_outside_the_list(spark):
    rows = spark.createDataFrame([("a", "Female"), ("a", "Male"), ("a", "Transgender"), ("a", None)], "k string, g string")
    table = R.pivot_count(rows, ["k"], "g", ["Female", "Male"], rest=True)
    assert tuple(R.with_row_total(table, ["k"]).first()) == ("a", 3, 1, 1)
    shares = R.row_percentages(table, ["Female", "Male"], "n", ["f", "m"], [1, 1])
    assert shares.columns == ["k", "f", "m", "n"] and tuple(shares.first()) == ("a", 33.3, 33.3, 3)


def test_quantiles_take_infinity_and_skip_nan(spark):
    from rollbook.operators.quantiles import count_values, distribution

    rows = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, float("nan"), float("inf"), None, -float("inf"))], "x double")
    out = distribution(count_values(rows, "x", []), [], {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert (out["n"], out["low"], out["mid"], out["high"]) == (5, -float("inf"), 2.0, float("inf"))


@pytest.mark.parametrize("many", [0, 3, 10**6])
def test_buckets_of_many_values_are_cut(spark, many):
    rng = np.random.default_rng(5)
    rows = [(k, float(x)) for k, n in (("a", 400), ("b", 3), ("c", 90)) for x in rng.normal(1000 if k == "a" else 0, 1, n)] + [("d", None), ("e", 0.0), ("e", 0.0)]
    probs = {"p": 0.1, "q": 0.5, "r": 0.99}
    out = {r.g: r for r in distribution(count_values(spark.createDataFrame(rows, "g string, x double"), "x", ["g"]), ["g"], probs, many).collect()}
    for g in "abc":
        x = np.array([v for k, v in rows if k == g])
        assert np.allclose([out[g].p, out[g].q, out[g].r, out[g]["mean"], out[g]["std"]], [*np.quantile(x, [0.1, 0.5, 0.99]), x.mean(), x.std(ddof=1)], rtol=1e-9)
    assert (out["d"].n, out["d"].p, out["e"].n, out["e"].q, out["e"]["std"]) == (0, None, 2, 0.0, 0.0)


def test_moments_of_huge_and_tiny_values(spark):
    for x in ([1e300, 2e300, 4e300], [1e-300, 3e-300], [-1e308, 1e308, 0.0], [5e-324, 1e308]):
        out = distribution(count_values(spark.createDataFrame([(v,) for v in x], "x double"), "x", []), [], {"p": 0.5}).first()
        scaled = np.array(x) / max(abs(v) for v in x)
        assert np.isclose(out["std"] / max(abs(v) for v in x), scaled.std(ddof=1), rtol=1e-9) and np.isclose(out["mean"] / max(abs(v) for v in x), scaled.mean(), atol=1e-12)


def test_narrow_range_far_from_zero(spark):
    from rollbook.operators.quantiles import _bucket, _finer, count_values, distribution

    rows = spark.range(200000).select((F.lit(1.6e12) + F.col("id") * 4999).alias("x"))
    out = distribution(count_values(rows, "x", []), [], {"p": 0.25}).first()
    assert out["p"] == 1.6e12 + 49999.75 * 4999
    assert rows.groupBy(_bucket(F.col("x")), _finer(F.col("x"))).count().agg(F.max("count")).first()[0] < 10


def test_least_squares_of_many_levels(spark):
    from rollbook.operators.stats import ols

    units = spark.range(50000).select(F.concat(F.lit("u"), "id").alias("unit"), F.col("id"))
    rows = units.withColumn("year", F.explode(F.array(*[F.lit(str(y)) for y in (2020, 2021, 2022)])))
    noise = F.pmod(F.xxhash64("unit", "year"), F.lit(1000)) / 1000.0
    rows = rows.select("unit", "year", (F.pmod("id", F.lit(97)) + 5 * (F.col("year") == "2022").cast("int") + noise).alias("y"))
    out = ols(rows, "y", ["unit", "year"], {"unit": "u0", "year": "2020"}, errors_for=["year"])
    got = {r.term: r for r in out.where("term LIKE 'year=%' OR term IN ('unit=u1', 'unit=u49999', '(intercept)')").collect()}
    table = rows.where("unit IN ('u0', 'u1', 'u49999')").toPandas().pivot(index="unit", columns="year", values="y")
    means = {r.year: r.m for r in rows.groupBy("year").agg(F.avg("y").alias("m")).collect()}
    # All units have all years: differences of means are the solution.
    assert abs(got["year=2022"].coefficient - (means["2022"] - means["2020"])) < 1e-6
    assert abs(got["unit=u1"].coefficient - (table.loc["u1"].mean() - table.loc["u0"].mean())) < 1e-6
    n = 50000
    sse = rows.withColumn("u", F.avg("y").over(W.Window.partitionBy("unit"))).join(spark.createDataFrame(list(means.items()), "year string, m double"), "year")
    sse = sse.agg(F.sum(F.pow(F.col("y") - F.col("u") - F.col("m") + F.lit(sum(means.values()) / 3), 2))).first()[0]
    assert abs(got["year=2021"].std_error - (2 / n * sse / (3 * n - n - 2)) ** 0.5) < 1e-8
    assert got["unit=u1"].std_error is None and got["(intercept)"].p_value is None and got["year=2022"].p_value < 1e-12
    assert out.count() == 50000 - 1 + 2 + 1


def test_least_squares_at_its_ends(spark):
    from rollbook.operators.stats import ols

    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("a", "y", 2.0), (None, "y", 9.0), ("a", "x", None)], "f string, g string, y double")
    out = {r.term: r for r in ols(rows, "y", ["f", "g"], {"f": "a", "g": "x"}).collect()}
    assert {t: round(r.coefficient, 9) for t, r in out.items()} == {"(intercept)": 1.0, "f=b": 2.0, "g=y": 1.0}
    assert all(r.std_error is None and r.t is None and r.p_value is None for r in out.values())
    with pytest.raises(ValueError, match="f=z"):
        ols(rows, "y", ["f"], {"f": "z"})
    assert ols(rows.limit(0), "y", ["f"], {"f": "a"}).count() == 0


def test_tails_of_t_and_f(spark):
    from rollbook.functions.special import f_above, f_two_sided, t_two_sided

    # Published tables of the t and F distributions.
    table = [(12.706, 1.0, 0.05), (4.303, 2.0, 0.05), (2.228, 10.0, 0.05), (3.169, 10.0, 0.01), (1.984, 100.0, 0.05), (1.96, 1e7, 0.05), (0.0, 5.0, 1.0)]
    df = spark.createDataFrame(table, "t double, n double, p double")
    for r in df.select("p", t_two_sided(F.col("t"), F.col("n")).alias("q"), t_two_sided(-F.col("t"), F.col("n")).alias("r")).collect():
        assert abs(r.q - r.p) < 6e-5 and r.q == r.r
    one = spark.range(1).select(
        f_above(F.lit(4.96), F.lit(1), F.lit(10)).alias("a"), f_above(F.lit(3.33), F.lit(5), F.lit(10)).alias("b"), f_two_sided(F.lit(1.0), F.lit(9), F.lit(9)).alias("c"),
        t_two_sided(F.lit(None).cast("double"), F.lit(3)).alias("d"), t_two_sided(F.lit(1.0), F.lit(0)).alias("e"), t_two_sided(F.lit(float("inf")), F.lit(3)).alias("f"),
    ).first()
    assert abs(one.a - 0.05) < 2e-4 and abs(one.b - 0.05) < 2e-4 and abs(one.c - 1) < 1e-12 and one.d is None and one.e is None and one.f == 0


def test_welch_t_without_variance(spark):
    from rollbook.operators.stats import welch_t

    out = welch_t(spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)], "g string, v double"), "g", "v", "a", "b").first()
    assert out["t"] is None and out["mean_2"] == 2.0
