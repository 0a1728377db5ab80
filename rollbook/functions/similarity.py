"""Two text similarity scores Spark lacks, as column expressions, and the same for a single pair."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollbook.functions.folds import let

#: Letters that one whole number stands for; a sum of two such numbers fits in 64 bits.
WORD = 60


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step per letter."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & where.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 for equal texts, down to 0 for texts without a common letter."""
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * common_subsequence(a, b) / total


def osa_distance(a: str, b: str) -> int:
    """Edits with adjacent swaps counted once (optimal string alignment)."""
    before, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, prev = prev, row
    return prev[-1]


def letters(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(1)))
    )


def _bits(pattern: Column) -> Column:
    """The letters of a text, each with its place as a bit of its word."""
    return F.transform(letters(pattern), lambda c, i: F.struct(c.alias("c"), F.call_function("shiftleft", F.lit(1).cast("long"), i % WORD).alias("bit"), F.floor(i / WORD).alias("w")))


def _short_subsequence(pattern: Column, text: Column) -> Column:
    """Common subsequence where ``pattern`` fits in one word: a bit stays 1 until its letter is used."""
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(pattern)) - 1
    def place(bits: Column) -> Column:
        return F.transform(letters(text), lambda c: F.aggregate(bits, F.lit(0).cast("long"), lambda m, p: F.when(p["c"] == c, m + p["bit"]).otherwise(m)))

    places = let(_bits(pattern), place)
    row = F.aggregate(places, full, lambda v, m: ((v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))).bitwiseAND(full))
    return F.length(pattern) - F.bit_count(row)


def _long_subsequence(pattern: Column, text: Column) -> Column:
    """The same over several words; the sum carries from one word to the next."""
    words = F.sequence(F.lit(0), F.floor((F.length(pattern) - 1) / WORD).cast("int"))
    zero, full = F.lit(0).cast("long"), F.lit((1 << WORD) - 1)

    def place(bits: Column) -> Column:
        return F.transform(letters(text), lambda c: F.aggregate(
            bits, F.transform(words, lambda w: zero),
            lambda m, p: F.when(p["c"] == c, F.transform(m, lambda x, w: F.when(w == p["w"], x + p["bit"]).otherwise(x))).otherwise(m),
        ))

    places = let(_bits(pattern), place)

    def step(v: Column, m: Column) -> Column:
        def word(state: Column, w: Column) -> Column:
            old, hit = F.get(v, w), F.get(m, w)
            total = old + old.bitwiseAND(hit) + state["carry"]
            new = total.bitwiseOR(old.bitwiseAND(F.bitwise_not(hit))).bitwiseAND(full)
            return F.struct(F.shiftright(total, WORD).alias("carry"), F.array_append(state["out"], new).alias("out"))

        return F.aggregate(words, F.struct(zero.alias("carry"), F.array().cast("array<long>").alias("out")), word, lambda s: s["out"])

    row = F.aggregate(places, F.transform(words, lambda w: full), step)
    # Bits beyond the pattern match no letter and stay 1.
    ones = F.aggregate(row, F.lit(0), lambda n, x: n + F.bit_count(x))
    return F.size(words) * WORD - ones


def indel_ratio_column(a: Column, b: Column) -> Column:
    """As ``indel_ratio``, in the JVM."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    common = F.when(F.length(short) == 0, 0).when(F.length(short) <= WORD, _short_subsequence(short, long)).otherwise(_long_subsequence(short, long))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * common / F.nullif(total, F.lit(0)))


def osa_distance_column(a: Column, b: Column, at_most: int) -> Column:
    """As ``osa_distance`` up to ``at_most``, and ``at_most`` + 1 beyond, in the JVM.

    Only cells that far from the diagonal are kept: row i has the places i - at_most to i + at_most.
    """
    far = F.lit(at_most + 1)
    la, lb = F.length(a), F.length(b)
    band = F.sequence(F.lit(-at_most), F.lit(at_most))
    first = F.transform(band, lambda d: F.when((d >= 0) & (d <= lb), d).otherwise(far))
    back = lambda values, k: F.coalesce(F.get(values, k), far)

    def folded(t: Column) -> Column:
        def row(state: Column, i: Column) -> Column:
            def cell(done: Column, d: Column) -> Column:
                j, at = i + d, d + at_most
                x, y = F.get(t["a"], i - 1), F.get(t["b"], j - 1)
                swapped = (i > 1) & (j > 1) & (x == F.get(t["b"], j - 2)) & (F.get(t["a"], i - 2) == y)
                best = F.least(
                    back(state["now"], at + 1) + 1, back(done, at - 1) + 1, back(state["now"], at) + F.when(x == y, 0).otherwise(1),
                    F.when(F.coalesce(swapped, F.lit(False)), back(state["before"], at) + 1).otherwise(far), far,
                )
                return F.array_append(done, F.when((j < 0) | (j > lb), far).when(j == 0, F.least(i, far)).otherwise(best))

            return F.struct(state["now"].alias("before"), F.aggregate(band, F.array().cast("array<int>"), cell).alias("now"))

        start = F.struct(F.transform(band, lambda d: far).alias("before"), first.alias("now"))
        rows = F.when(la == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), la))
        return F.aggregate(rows, start, row, lambda s: F.get(s["now"], lb - la + at_most))

    end = let(F.struct(letters(a).alias("a"), letters(b).alias("b")), folded)
    return F.when(F.abs(la - lb) > at_most, far).otherwise(F.coalesce(end, far))
