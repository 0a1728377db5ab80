"""Best approximate matches between text columns, without comparing all pairs.

Both scores bound how many letter runs (of one, two or three letters) two texts
must share. Every text is cut into runs, ordered from rare to common; two texts
that share enough runs must then share one of their first few. Those are the
join key, together with the exact keys. A text uses the longest runs its length
allows, and the other side offers all three sizes. What the join returns is a
superset of all qualifying pairs, so no match is lost; lengths and run counts
thin it out, and only the rest is scored. All of it runs in the JVM.

Edit distances are looked for in rounds, the least first, so a text with a close
choice never meets the many that are further away.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.similarity import indel_ratio_column, osa_distance_column
from rollbook.session import written

# Stands for "no run": lets very short texts meet when nothing need be shared.
NO_RUN = 0
# A run that more choices than this have is split into several join keys.
SPLIT_AT = 2000
# Sizes of the letter runs, the most selective first.
RUN_SIZES = [3, 2, 1]
SLACK = 1e-9


@dataclass(frozen=True)
class Rule:
    """A score, and the runs of size q that two texts of given lengths must share.

    ``least_shared`` is the smallest such number over all lengths of the other
    text, ``at_least`` a cheap lower bound of it that picks the run size.
    ``near`` is a bound by plain edit distance, computed in the JVM, that every
    accepted pair meets.
    """

    shared: Callable[[Column, Column, Column], Column]
    least_shared: Callable[[Column, Column], Column]
    at_least: Callable[[Column, Column], Column]
    feasible: Callable[[Column, Column], Column]
    near: Callable[[Column, Column], Column]
    score: Callable[[Column, Column], Column]
    accept: Callable[[Column], Column]
    badness: Callable[[Column], Column]
    perfect: float
    # Within so many letters both texts may differ in all of them.
    anything: int = 0


def ratio_rule(threshold: float) -> Rule:
    """Similarity ratio of at least ``threshold`` (0 < threshold <= 100).

    The texts then have a common subsequence of ``threshold`` percent of their
    mean length. A letter missing from it breaks at most q runs of its own text
    and q - 1 runs of the other.
    """
    if not 0 < threshold <= 100:
        raise ValueError("threshold must be above 0 and at most 100")

    def shared(la: Column, lb: Column, q: Column) -> Column:
        common = F.ceil((la + lb) * (threshold / 200.0) - SLACK).cast("int")
        return la - q + 1 - q * (la - common) - (q - 1) * (lb - common)

    def least(la: Column, q: Column) -> Column:
        shortest = F.ceil(la * (threshold / (200.0 - threshold)) - SLACK).cast("int")
        longest = F.floor(la * ((200.0 - threshold) / threshold) + SLACK).cast("int")
        return F.array_min(F.transform(F.sequence(shortest, longest), lambda lb: shared(la, lb, q)))

    def linear(la: Column, q: Column) -> Column:
        # Without rounding the bound is linear in the other length: an end of its range is the least.
        ends = []
        for lb in (la * (threshold / (200.0 - threshold)), la * ((200.0 - threshold) / threshold)):
            common = (la + lb) * (threshold / 200.0)
            ends.append(la - q + 1 - q * (la - common) - (q - 1) * (lb - common))
        return F.least(*ends)

    return Rule(
        shared=shared,
        least_shared=least,
        at_least=linear,
        feasible=lambda la, lb: F.least(la, lb) * 200 >= (la + lb) * threshold - SLACK,
        # The ratio allows (la + lb)(1 - threshold / 100) letters put in or taken out, each an edit.
        near=lambda a, b: F.levenshtein(a, b) <= (F.length(a) + F.length(b)) * (1 - threshold / 100.0) + SLACK,
        score=indel_ratio_column,
        accept=lambda s: s >= threshold,
        badness=lambda s: -s,
        perfect=100.0,
    )


def osa_rule(at_most: int) -> Rule:
    """Edit distance with adjacent swaps of at most ``at_most``.

    An edit breaks at most q + 1 runs; single letters survive a swap.
    """
    broken = lambda q: F.when(q == 1, 1).otherwise(q + 1) * at_most
    return Rule(
        shared=lambda la, lb, q: F.greatest(la, lb) - q + 1 - broken(q),
        least_shared=lambda la, q: la - q + 1 - broken(q),
        at_least=lambda la, q: la - q + 1 - broken(q),
        feasible=lambda la, lb: F.abs(la - lb) <= at_most,
        # A swap is two edits.
        near=lambda a, b: F.levenshtein(a, b, 2 * at_most) >= 0,
        score=lambda a, b: osa_distance_column(a, b, at_most),
        accept=lambda s: s <= at_most,
        badness=lambda s: s.cast("double"),
        perfect=0,
        anything=at_most,
    )


def _with_runs(texts: DataFrame) -> DataFrame:
    """Each text with its runs of size ``_q`` as hashes, repeated runs numbered.

    Two runs with the same hash only add a candidate, which scoring removes.
    """
    starts = F.sequence(F.lit(1), F.col("_len") - F.col("_q") + 1)
    runs = F.array_sort(F.transform(starts, lambda i: F.substr(F.col("_t"), i, F.col("_q"))))
    # Equal runs stand together; the place of the first of them is found from the places where runs change.
    changes = lambda x, i: (i == 0) | (x != F.get(F.col("_runs"), i - 1))
    firsts = F.filter(F.transform("_runs", lambda x, i: F.when(changes(x, i), i)), lambda i: i.isNotNull())
    sizes = F.transform(firsts, lambda i, k: F.coalesce(F.get(F.col("_firsts"), k + 1), F.size("_runs")) - i)
    numbers = F.flatten(F.transform("_sizes", lambda n: F.sequence(F.lit(0), n - 1)))
    hashed = F.transform(F.arrays_zip(F.col("_runs").alias("x"), F.col("_nth").alias("n")), lambda p: F.xxhash64(p["x"], p["n"], F.col("_q")))
    texts = texts.withColumn("_runs", runs).withColumn("_firsts", firsts).withColumn("_sizes", sizes).withColumn("_nth", numbers)
    return texts.withColumn("_bag", hashed).drop("_runs", "_firsts", "_sizes", "_nth")


def _loose(rule: Rule) -> Column:
    """Whether a text is so short that it need not share a letter."""
    return (F.col("_q") == 1) & (rule.least_shared(F.col("_len"), F.col("_q")) <= 0)


def _rare_first(texts: DataFrame, frequency: DataFrame, keys: list[str]) -> DataFrame:
    """Order every text's runs by how many choices have them, which is kept beside each.

    Every text has a run; the outer explode only keeps Spark from testing that
    with a second evaluation of the runs.
    """
    fixed = [*keys, "_t", "_len", "_q"]
    counted = texts.select(*fixed, F.explode_outer("_bag").alias("_run")).join(frequency, "_run", "left")
    ranked = F.struct(F.coalesce("_f", F.lit(0)).alias("f"), F.col("_run").alias("run"))
    return counted.groupBy(*fixed).agg(F.array_sort(F.collect_list(ranked)).alias("_bag"))


def _signatures(texts: DataFrame, rule: Rule, keys: list[str], side: str, loose_choices: Column | None) -> DataFrame:
    """The first runs of each text, one row each, with all runs beside them.

    ``loose_choices`` is how many choices stand at ``NO_RUN``, which is split like any common run; without it none does.
    """
    need = rule.least_shared(F.col("_len"), F.col("_q"))
    count = F.size("_bag")
    prefix = F.slice("_bag", 1, F.greatest(F.least(count - need + 1, count), F.lit(1)))
    keyed = prefix
    if loose_choices is not None:
        none = F.struct(loose_choices.alias("f"), F.lit(NO_RUN).cast("long").alias("run"))
        keyed = F.when(_loose(rule), F.array_append(prefix, none)).otherwise(prefix)
    rows = texts.select(
        *keys, F.col("_t").alias(f"_t{side}"), F.col("_len").alias(f"_l{side}"),
        F.transform("_bag", lambda r: r["run"]).alias(f"_b{side}"), "_q",
        F.posexplode_outer(keyed).alias(f"_at{side}", "_x"),
    )
    # A common run is spread over several keys: each choice takes one of them,
    # the texts looking for choices take all.
    parts = F.ceil((F.col("_x.f") + 1) / SPLIT_AT)
    part = F.pmod(F.xxhash64(f"_t{side}"), parts)
    if side == "a":
        part = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    return rows.select("*", F.col("_x.run").alias("_run"), part.alias("_part")).drop("_x")


def similar_pairs(left: DataFrame, right: DataFrame, column: str, exact: list[str], rule: Rule, unlike: bool = True) -> DataFrame:
    """All pairs of distinct texts (within equal exact keys) that the rule accepts.

    Returns the exact keys, ``text``, ``choice`` and ``score``. Without ``unlike``, pairs are left out that need
    not share a letter because both texts are short; there may be as many of them as pairs of short texts.
    """
    def texts(df: DataFrame) -> DataFrame:
        filled = df.where(F.col(column).isNotNull() & (F.col(column) != ""))
        for k in exact:
            filled = filled.where(F.col(k).isNotNull())
        return filled.select(*exact, F.col(column).alias("_t")).distinct().withColumn("_len", F.length("_t"))

    length = F.col("_len")
    size = F.lit(RUN_SIZES[-1])
    for q in reversed(RUN_SIZES[:-1]):
        size = F.when((length >= q) & (rule.at_least(length, F.lit(q)) >= 1), q).otherwise(size)
    a = _with_runs(texts(left).withColumn("_q", size))
    sizes = F.explode(F.array(*[F.lit(q) for q in RUN_SIZES]))
    b = _with_runs(texts(right).withColumn("_q", sizes).where(F.col("_len") >= F.col("_q")))
    frequency = b.select(F.explode_outer("_bag").alias("_run")).groupBy("_run").agg(
        F.count(F.lit(1)).alias("_f")
    )
    short = b.where(_loose(rule)).agg(F.count(F.lit(1))).scalar() if unlike and rule.anything else None
    sa = _signatures(_rare_first(a, frequency, exact), rule, exact, "a", short)
    sb = _signatures(_rare_first(b, frequency, exact), rule, exact, "b", short)
    la, lb = F.col("_la"), F.col("_lb")
    need = rule.shared(la, lb, F.col("_q"))
    # From the place where a pair first meets, enough runs must be left on both sides.
    left_over = F.least(F.size("_ba") - F.col("_ata"), F.size("_bb") - F.col("_atb"))
    candidates = (
        sa.join(sb, [*exact, "_q", "_run", "_part"]).where(rule.feasible(la, lb))
        .where(left_over >= need).where(F.size(F.array_intersect("_ba", "_bb")) >= need)
    )
    # A pair may meet at several runs.
    once = candidates.groupBy(*exact, "_ta", "_tb").agg(F.lit(1).alias("_one")).where(rule.near(F.col("_ta"), F.col("_tb")))
    scored = once.withColumn("score", rule.score(F.col("_ta"), F.col("_tb")))
    return scored.where(rule.accept(F.col("score"))).select(
        *exact, F.col("_ta").alias("text"), F.col("_tb").alias("choice"), "score"
    )


def best_matches(
    left: DataFrame, right: DataFrame, column: str, exact: list[str], rules: list[Rule], order: str | None = None
) -> DataFrame:
    """The best choice per distinct text: exact keys, ``text``, ``match``, ``score``.

    Texts equal to a choice take it without scoring. Ties go to the choice with
    the lowest ``order`` value, or to the smallest text when no order is given.
    ``rules`` go from strict to wide; a text that one of them matches is not looked for again.
    """
    def texts(df: DataFrame) -> DataFrame:
        filled = F.col(column).isNotNull() & (F.col(column) != "")
        return df.where(filled).select(*exact, F.col(column).alias("text")).distinct()

    wanted, choices = texts(left), texts(right)
    same = wanted.join(choices, [*exact, "text"], "left_semi")
    rest = wanted.join(choices, [*exact, "text"], "left_anti")
    place = F.min(order) if order else F.lit(0)
    placed = right.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(*exact, F.col(column).alias("choice")).agg(place.alias("_place"))
    found, parts = None, []
    for n, rule in enumerate(rules):
        if n:
            rest = rest.join(parts[-1], [*exact, "text"], "left_anti")
        if len(rules) > 1:
            rest = written(rest, "fuzzy-rest")
        found = _best_of(rest, right, placed, column, exact, rule, bool(order))
        parts.append(written(found, "fuzzy-found") if len(rules) > 1 else found)
    kind = found.schema["score"].dataType
    equal = same.select(*exact, "text", F.col("text").alias("match"), F.lit(rules[0].perfect).cast(kind).alias("score"))
    return reduce(DataFrame.unionByName, parts).unionByName(equal)


def _best_of(rest: DataFrame, right: DataFrame, placed: DataFrame, column: str, exact: list[str], rule: Rule, ordered: bool) -> DataFrame:
    """The best choice by one rule for texts that no stricter rule matches."""
    pairs = similar_pairs(rest.withColumnRenamed("text", column), right, column, exact, rule, unlike=False)
    pairs = pairs.join(placed, [*exact, "choice"]) if ordered else pairs.withColumn("_place", F.lit(0))
    if rule.anything:
        # Two texts of few letters are this far apart whatever they are, and not nearer, or a stricter rule had matched:
        # of all such choices the first in order is as good as any.
        short = placed.where(F.length("choice") <= rule.anything)
        first = F.min(F.struct("_place", "choice")).alias("_first")
        asked = rest.where(F.length("text") <= rule.anything)
        if exact:
            asked = asked.join(short.groupBy(*exact).agg(first), exact)
        else:
            asked = asked.withColumn("_first", short.agg(first).scalar()).where("_first IS NOT NULL")
        pairs = pairs.unionByName(
            asked.select(*exact, "text", F.col("_first.choice").alias("choice"), F.lit(rule.anything).cast(pairs.schema["score"].dataType).alias("score"), F.col("_first._place").alias("_place"))
        )
    rank = F.struct(rule.badness(F.col("score")).alias("a"), F.col("_place").alias("b"), F.col("choice").alias("c"))
    best = pairs.groupBy(*exact, "text").agg(F.min_by(F.struct("choice", "score"), rank).alias("_m"))
    return best.select(*exact, "text", F.col("_m.choice").alias("match"), F.col("_m.score").alias("score"))


def best_fuzzy_match(df: DataFrame, column: str, choices: DataFrame, threshold: float = 80.0, out: str | None = None) -> DataFrame:
    """Add the best choice by similarity ratio, null below the threshold."""
    found = best_matches(df, choices, column, [], [ratio_rule(threshold)])
    renamed = found.select(F.col("text").alias(column), F.col("match").alias(out or f"{column}_match"))
    return df.join(renamed, column, "left")


def best_osa_match(df: DataFrame, column: str, choices: DataFrame, at_most: int = 3, out: str | None = None) -> DataFrame:
    """Add the best choice by edit distance with swaps, null beyond the bound."""
    rules = [osa_rule(n) for n in range(1, at_most + 1)] or [osa_rule(0)]
    found = best_matches(df, choices, column, [], rules)
    renamed = found.select(F.col("text").alias(column), F.col("match").alias(out or f"{column}_match"))
    return df.join(renamed, column, "left")


def fuzzy_join(
    left: DataFrame, right: DataFrame, fuzzy_on: str, exact_on: list[str] | None = None,
    how: str = "left", threshold: float = 70.0,
) -> DataFrame:
    """Join on exact keys and the best approximate match of one text column.

    The left text is replaced by its match; unmatched left rows keep null.
    """
    exact = exact_on or []
    found = best_matches(left, right, fuzzy_on, exact, [ratio_rule(threshold)]).select(
        *exact, F.col("text").alias(fuzzy_on), F.col("match").alias(f"{fuzzy_on}_match")
    )
    matched = left.join(found, [*exact, fuzzy_on], "left").drop(fuzzy_on)
    other = right.withColumn(f"{fuzzy_on}_match", F.col(fuzzy_on))
    return matched.join(other, [*exact, f"{fuzzy_on}_match"], how)
