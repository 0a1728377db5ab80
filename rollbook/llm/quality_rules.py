"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one text. The method's rule looks at all texts of a host: normalised lines are
hashed, the distinct documents that hold a line are counted per host, lines above the limits are taken
away, and a document of which too little remains is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import SPACE, free_name, let, normal_lines, words, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5


def repeated_words(tokens: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text.

    Windows are hashed and sorted with their places; equal neighbours are repeats, and the places of
    repeats, in order, cover ``min(size, distance to the next)`` words each. n log n in the text length.
    """
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    def covered(w: Column) -> Column:
        def places(pairs: Column) -> Column:
            n = F.size(pairs)
            again = F.filter(
                pairs,
                lambda p, k: ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"])) | ((k + 1 < n) & (F.get(pairs, k + 1)["h"] == p["h"])),
            )
            return F.sort_array(F.transform(again, lambda p: p["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(let(pairs, places), total)

    return F.when(F.size(tokens) < size + 1, F.lit(0).cast("long")).otherwise(
        let(let(hashed, windows), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))
    )


def base_metrics(text: Column) -> Column:
    """A struct of longs: counts of words, their code points, symbols, repeated lines and words."""
    whole = F.coalesce(text, F.lit(""))
    plain = whole
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    with_word = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return let(
        words(text),
        lambda t: F.struct(
            F.size(t).cast("long").alias("n_words"),
            F.length(F.array_join(t, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(plain)).cast("long").alias("n_symbols"),
            let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(t).alias("n_repeat_words"),
        ),
    )


def judge(
    docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", line_limit: int = 20,
    least_words: int = 10, repeat_percent: int = 20, least_left: int = 5, least_percent: int = 25,
) -> DataFrame:
    """One row per document: base metrics, ``base_failed``, ``lines_over``, ``words_left`` and ``kept``.

    A document fails the base rules with fewer than ``least_words`` words or with more than
    ``repeat_percent`` of them in repeated windows. A line is over the limit of its host when more than
    ``line_limit`` distinct texts there hold it; exact copies of a text count once. A document is rejected
    when fewer than ``least_left`` words remain, or less than ``least_percent`` percent.

    Null text counts as empty, a null host as a host of its own; repeated rows are judged alike, each on
    its own; an empty table gives an empty result. Text is read once, and only hashes are shuffled: counts
    are aggregated by line and document before by line, and a hot line meets the table of frequent lines
    in a join that adaptive execution splits.
    """
    def hashed(lines: Column) -> Column:
        return F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.struct(F.xxhash64(x).alias("h"), F.size(words(x)).alias("w")))

    measured = written(
        docs.select(
            F.col(id), F.col(host).alias("host"), F.xxhash64(text).alias("copy"), _mark(id, text, host).alias("mark"),
            base_metrics(F.col(text)).alias("base"),
            hashed(normal_lines(F.col(text))).alias("lines"),
        ).select(id, "host", "copy", "mark", "base.*", "lines").withColumn("row", F.monotonically_increasing_id()),
        "quality-measured",
    )
    # A line and its host are one 64-bit hash from here on; null hosts hash like any value.
    line = measured.select("row", "copy", "host", F.explode("lines").alias("x")).select(
        "row", "copy", F.xxhash64(F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")), "x.h").alias("line"), F.col("x.w").alias("w")
    )
    over = written(
        line.groupBy("line", "copy").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("*").alias("texts")).where(F.col("texts") > line_limit).select("line"),
        "quality-lines",
    )
    lost = line.join(over, "line").groupBy("row").agg(F.sum("w").alias("lost"), F.count("*").alias("lines_over"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    return measured.join(lost, "row", "left").select(
        F.col(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= least_left) & (100 * left >= least_percent * F.col("n_words"))).alias("kept"),
        F.coalesce("lines_over", F.lit(0)).cast("long").alias("lines_over"), left.alias("words_left"), "mark",
    )


def _mark(id: str, text: str, host: str) -> Column:
    """Equal for rows that are judged alike."""
    return F.xxhash64(F.xxhash64(id), F.xxhash64(text), F.xxhash64(host))


def keep_good(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns as they are."""
    mark = free_name(docs, "mark")
    bad = judge(docs, id, text, host, **limits).where(~F.col("kept")).select(F.col("mark").alias(mark)).distinct()
    return docs.withColumn(mark, _mark(id, text, host)).join(written(bad, "quality-rejects").hint("merge"), mark, "left_anti").drop(mark)
