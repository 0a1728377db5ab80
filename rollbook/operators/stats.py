"""Regressions, tests and density tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.special import f_two_sided, t_two_sided
from rollbook.operators.aggregate import with_keys
from rollbook.operators.quantiles import count_values, distribution
from rollbook.session import written


def welch_t(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Welch's t with its degrees of freedom, the variance ratio, and both two-sided p-values, in one pass.

    What would divide by zero, such as t for two groups without variance, is null, and so is its p-value.
    """
    def moments(name):
        x = F.when(F.col(group) == name, F.col(value))
        return F.avg(x), F.var_samp(x), F.count(x)

    (m1, v1, n1), (m2, v2, n2) = moments(first), moments(second)
    rows = df.where(F.col(group).isin(first, second)).agg(
        m1.alias("mean_1"), v1.alias("var_1"), n1.alias("n_1"),
        m2.alias("mean_2"), v2.alias("var_2"), n2.alias("n_2"),
    )
    a, b = F.try_divide("var_1", "n_1"), F.try_divide("var_2", "n_2")
    t = F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt(a + b))
    freedom = F.try_divide(
        F.pow(a + b, 2), F.try_divide(F.pow(a, 2), F.col("n_1") - 1) + F.try_divide(F.pow(b, 2), F.col("n_2") - 1)
    )
    tested = rows.select("*", t.alias("t"), freedom.alias("df"), F.try_divide("var_1", "var_2").alias("f_ratio"))
    return tested.withColumns({
        "p_value": t_two_sided(F.col("t"), F.col("df")),
        "f_p_value": f_two_sided(F.col("f_ratio"), F.col("n_1") - 1, F.col("n_2") - 1),
    })


def trend(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x per group."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return with_keys(df, by).groupBy(*by).agg(
        F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_count(ys, xs).alias("n"),
    )


#: Right-hand sides that are solved together, rounds of a solution, and how small a residual ends it.
TOGETHER, ROUNDS, SMALL = 48, 1000, 1e-12
INTERCEPT = "(intercept)"
TERM = ["factor", "level"]


def _cells(df: DataFrame, target: str, factors: list[str]) -> DataFrame:
    """Rows with equal levels as one: their number, sum and squared deviations."""
    y = F.col(target).cast("double")
    rows = df.where(y.isNotNull() & ~F.isnan(y))
    for f in factors:
        rows = rows.where(F.col(f).isNotNull())
    named = rows.select(*[F.col(f).cast("string").alias(f"_f{i}") for i, f in enumerate(factors)], y.alias("y"))
    return named.groupBy(*[f"_f{i}" for i in range(len(factors))]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), (F.var_pop("y") * F.count(F.lit(1))).alias("within")
    )


def _together(cells: DataFrame, k: int) -> DataFrame:
    """How often two levels of different factors occur together, once from either side."""
    pairs = [F.struct(F.lit(i).alias("factor"), F.col(f"_f{i}").alias("level"), F.lit(j).alias("g"), F.col(f"_f{j}").alias("m")) for i in range(k) for j in range(k) if i != j]
    if not pairs:
        return cells.select(F.lit(0).alias("factor"), F.col("_f0").alias("level"), F.lit(0).alias("g"), F.col("_f0").alias("m"), F.lit(0.0).alias("w")).where("false")
    listed = cells.select(F.explode(F.array(*pairs)).alias("p"), "n").select("p.*", "n")
    return listed.groupBy(*TERM, "g", "m").agg(F.sum("n").cast("double").alias("w"))


def _solve(terms: DataFrame, pairs: DataFrame, sides: int) -> DataFrame:
    """``x`` with A x = ``b`` for each of ``sides`` right-hand sides, by conjugate gradients over tables.

    A has the counts of terms on its diagonal and ``pairs`` beside it. Each round is one join of the pairs with the
    terms, written once; only a few sums per right-hand side reach the driver.
    """
    each = range(sides)
    numbers = lambda body: F.array(*[body(k) for k in each])
    value = lambda c, k: F.col(c)[k]
    zero = numbers(lambda k: F.lit(0.0))
    now = terms.select(*TERM, "ref", "d", zero.alias("x"), F.col("b").alias("r"), numbers(lambda k: value("b", k) / F.col("d")).alias("p"))
    first = None
    for _ in range(ROUNDS):
        now = written(now, "ols-round")
        beside = pairs.join(now.select(F.col("factor").alias("g"), F.col("level").alias("m"), "p"), ["g", "m"])
        summed = beside.groupBy(*TERM).agg(numbers(lambda k: F.sum(F.col("w") * value("p", k))).alias("_q"))
        q = numbers(lambda k: F.col("d") * value("p", k) + F.coalesce(value("_q", k), F.lit(0.0)))
        step = written(now.join(summed, TERM, "left").withColumn("q", q).drop("_q"), "ols-step")
        sums = step.agg(
            numbers(lambda k: F.sum(value("p", k) * value("q", k))).alias("pq"), numbers(lambda k: F.sum(value("r", k) * value("r", k) / F.col("d"))).alias("rr"),
            numbers(lambda k: F.sum(value("r", k) * value("q", k) / F.col("d"))).alias("rq"), numbers(lambda k: F.sum(value("q", k) * value("q", k) / F.col("d"))).alias("qq"),
        ).first()
        if sums.rr[0] is None:  # no term at all
            return now
        first = first or list(sums.rr)
        open_ = [rr > SMALL * SMALL * start and pq > 0 for rr, pq, start in zip(sums.rr, sums.pq, first)]
        if not any(open_):
            return now
        alpha = [rr / pq if go else 0.0 for go, rr, pq in zip(open_, sums.rr, sums.pq)]
        after = [max(rr - 2 * a * rq + a * a * qq, 0.0) for rr, rq, qq, a in zip(sums.rr, sums.rq, sums.qq, alpha)]
        beta = [new / rr if go else 0.0 for go, new, rr in zip(open_, after, sums.rr)]
        now = step.select(
            *TERM, "ref", "d", numbers(lambda k: value("x", k) + alpha[k] * value("p", k)).alias("x"),
            numbers(lambda k: value("r", k) - alpha[k] * value("q", k)).alias("r"), "p",
        ).select(*TERM, "ref", "d", "x", "r", numbers(lambda k: value("r", k) / F.col("d") + beta[k] * value("p", k)).alias("p"))
    raise ValueError("least squares did not settle")


def ols(
    df: DataFrame, target: str, factors: list[str], reference: dict[str, str], ridge: float = 0.0, errors_for: list[str] | None = None
) -> DataFrame:
    """Least squares on categorical factors against chosen reference levels.

    Returns term, coefficient, std_error, t and p_value, for every level but the reference ones and for
    ``(intercept)``. Rows with a missing target or level are left out. A reference level that no row has is an error.
    ``ridge`` adds so many rows with target 0 to each level.

    Rows of equal levels are summed first; from these cells come the counts of single levels and of pairs of
    levels, which are the normal equations as a sparse table. They are solved by conjugate gradients over tables,
    so a factor may have any number of levels. Every standard error is a further right-hand side, so with
    thousands of levels ``errors_for`` names the factors (and ``(intercept)``) whose errors are wanted; others are
    null. A model with as many terms as rows has null errors. Factors should connect: effects that the data do not
    tell apart get one of the possible solutions.
    """
    k, wanted = len(factors), [*factors, INTERCEPT] if errors_for is None else errors_for
    cells = written(_cells(df, target, factors), "ols-cells")
    refs = F.array(*[F.struct(F.lit(i).alias("factor"), F.lit(str(reference[f])).alias("level")) for i, f in enumerate(factors)])
    one = F.explode(F.array(*[F.struct(F.lit(i).alias("factor"), F.col(f"_f{i}").alias("level")) for i in range(k)]))
    terms = written(
        cells.select(one.alias("t"), "n", "s").groupBy("t.factor", "t.level").agg((F.sum("n") + F.lit(float(ridge))).alias("d"), F.sum("s").alias("s"))
        .withColumn("ref", F.array_contains(refs, F.struct("factor", "level"))), "ols-terms",
    )
    held = {r[0] for r in terms.where("ref").select("factor").collect()}
    missing = [f"{f}={reference[f]}" for i, f in enumerate(factors) if i not in held]
    if missing and not terms.isEmpty():
        raise ValueError(f"no row has the reference level {', '.join(missing)}")
    pairs = written(_together(cells, k), "ols-pairs")
    # One right-hand side for the target, one for each term whose error is wanted.
    asked_factors = [i for i, f in enumerate(factors) if f in wanted]
    asked = [(r.factor, r.level) for r in terms.where(~F.col("ref") & F.col("factor").isin(asked_factors)).select(*TERM).orderBy(*TERM).collect()]
    asked += [(-1, "")] if INTERCEPT in wanted else []

    def contrast(factor: int, level: str) -> Column:
        is_ref = F.col("ref").cast("double")
        if factor < 0:
            return is_ref
        return F.when(F.col("factor") == factor, (F.col("level") == level).cast("double") - is_ref).otherwise(0.0)

    solved, variances = None, []
    for lo in range(0, max(1, len(asked)), TOGETHER):
        some = asked[lo : lo + TOGETHER]
        sides = ([F.col("s")] if lo == 0 else []) + [contrast(*a) for a in some]
        x = _solve(terms.withColumn("b", F.array(*sides)), pairs, len(sides))
        shift = len(sides) - len(some)
        solved = x.select(*TERM, "ref", F.col("x")[0].alias("u")) if lo == 0 else solved
        if some:
            spread = [F.sum(contrast(*a) * F.col("x")[i + shift]) for i, a in enumerate(some)]
            named = [F.struct(F.lit(a[0]).alias("factor"), F.lit(a[1]).alias("level"), v.alias("v")) for a, v in zip(some, spread)]
            variances.append(x.agg(F.array(*named).alias("vs")).select(F.inline("vs")))
    solved = written(solved, "ols-solved")
    return _report(cells, solved, variances, factors)


def _report(cells: DataFrame, solved: DataFrame, variances: list[DataFrame], factors: list[str]) -> DataFrame:
    k = len(factors)
    base = solved.where("ref").select("factor", F.col("u").alias("base"))
    names = F.array(*[F.lit(f) for f in factors])
    levels = solved.where("NOT ref").join(base, "factor").select(
        *TERM, F.concat(F.get(names, F.col("factor")), F.lit("="), "level").alias("term"), (F.col("u") - F.col("base")).alias("coefficient")
    )
    intercept = base.agg(F.sum("base").alias("coefficient")).select(
        F.lit(-1).alias("factor"), F.lit("").alias("level"), F.lit(INTERCEPT).alias("term"), "coefficient"
    ).where("coefficient IS NOT NULL")
    # Squared deviations within cells, and of cells from what the model says.
    fitted = cells
    for i in range(k):
        fitted = fitted.join(solved.where(F.col("factor") == i).select(F.col("level").alias(f"_f{i}"), F.col("u").alias(f"_u{i}")), f"_f{i}")
    off = F.col("s") / F.col("n") - sum((F.col(f"_u{i}") for i in range(k)), F.lit(0.0))
    rest = fitted.agg(F.sum(F.col("within") + F.col("n") * off * off).alias("rss"), F.sum("n").alias("n")).select(F.struct("rss", "n")).scalar()
    free = solved.agg(F.count(F.lit(1)) - (k - 1)).scalar()
    table = levels.unionByName(intercept).withColumns({"_rest": rest, "_terms": free})
    freedom = F.col("_rest.n") - F.col("_terms")
    if variances:
        table = table.join(reduce(DataFrame.unionByName, variances), TERM, "left")
    else:
        table = table.withColumn("v", F.lit(None).cast("double"))
    spread = F.when(F.col("v") < 0, 0.0).otherwise(F.col("v"))
    error = F.when(freedom > 0, F.sqrt(spread * F.col("_rest.rss") / F.nullif(freedom, F.lit(0))))
    out = table.select("term", "coefficient", error.alias("std_error"), freedom.alias("_df"))
    out = out.withColumn("t", F.try_divide("coefficient", "std_error"))
    return out.select("term", "coefficient", "std_error", "t", t_two_sided(F.col("t"), F.col("_df")).alias("p_value"))


def did_columns(df: DataFrame, year: str, since: int, unit: str, treated: list[str]) -> DataFrame:
    """Indicators after, treated and their product."""
    after = (F.col(year) >= since).cast("int")
    hit = F.col(unit).isin(treated).cast("int")
    return df.withColumns({"post": after, "treatment": hit, "post_treatment": after * hit})


def histogram_density(df: DataFrame, column: str, width: float) -> DataFrame:
    """Share of rows per unit of the value in equal-width bins."""
    present = df.where(F.col(column).isNotNull())
    total = present.agg(F.count(F.lit(1))).scalar()
    bins = present.groupBy((F.floor(F.col(column) / width) * width).cast("double").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return bins.withColumn("density", F.col("n") / (total * width))


def kernel_density(df: DataFrame, column: str, by: list[str] | None = None, points: int = 512, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, with the usual rule-of-thumb bandwidth.

    Values are first counted per grid cell of their group, so the smoothing
    works on at most ``points`` weights per group however many rows there are.
    """
    keys = by or []
    rows = with_keys(df, keys).where(F.col(column).isNotNull()).select(
        *keys, F.col(column).cast("double").alias("_v")
    )
    counted = count_values(rows, "_v", keys)
    corners = {"_low": 0.0, "_q1": 0.25, "_q3": 0.75, "_high": 1.0}
    shape = distribution(counted, keys, corners).withColumnsRenamed({"n": "_n", "std": "_sd"})
    spread = (F.col("_q3") - F.col("_q1")) / 1.34
    scale = F.coalesce(F.nullif(F.least("_sd", spread), F.lit(0.0)), F.nullif(F.col("_sd"), F.lit(0.0)), F.lit(1.0))
    shape = shape.withColumn("_h", scale * 0.9 * F.pow(F.col("_n"), -0.2))
    shape = shape.withColumn("_from", F.col("_low") - cut * F.col("_h")).withColumn(
        "_step", (F.col("_high") - F.col("_low") + 2 * cut * F.col("_h")) / (points - 1)
    ).select(*keys, "_n", "_h", "_from", "_step")
    if keys:
        placed = counted.join(shape, keys)
    else:
        placed = counted.withColumn("_s", shape.select(F.struct("*")).scalar()).select("_v", "_c", "_s.*")
    cell = F.round((F.col("_v") - F.col("_from")) / F.col("_step")).cast("int")
    weights = placed.groupBy(*keys, "_n", "_h", "_from", "_step", cell.alias("_cell")).agg(
        F.sum("_c").alias("_w")
    )
    packed = weights.groupBy(*keys, "_n", "_h", "_from", "_step").agg(
        F.array_sort(F.collect_list(F.struct("_cell", "_w"))).alias("_cells")
    )
    grid = packed.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    bump = lambda acc, c: acc + c["_w"] * F.exp(
        -0.5 * F.pow((F.col("_g") - c["_cell"]) * F.col("_step") / F.col("_h"), 2)
    )
    height = F.aggregate("_cells", F.lit(0.0), bump) / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))
    return grid.select(
        *keys, (F.col("_from") + F.col("_g") * F.col("_step")).alias("x"), height.alias("density")
    )
