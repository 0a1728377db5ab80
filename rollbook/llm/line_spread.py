"""Removal of lines that spread over many sites, in DataFrame functions only.

A HyperLogLog sketch of sites per line hash is built before the shuffle and merged after it. Sketches
settle the lines far below the threshold; the others get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import free_name, let, normal_lines, written


def _mark(id: str, text: str) -> Column:
    return F.xxhash64(F.xxhash64(id), F.xxhash64(text))


def spread_lines(measured: DataFrame, least_sites: int, least_chars: int = 1, log_k: int = 10, band: float = 0.25) -> DataFrame:
    """Hashes of the lines to remove, from ``measured`` (row, site, lines as distinct structs of hash h and length n).

    ``log_k`` is the log2 of the sketch's registers (3.3 percent standard error at 10); an estimate below
    the threshold by more than ``band`` of it decides alone, over seven standard errors away.
    """
    line = measured.select("row", "site", F.explode("lines").alias("x")).where(F.col("x.n") >= least_chars).select("row", "site", F.col("x.h").alias("line"))
    near = written(
        line.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(log_k)).alias("sites"))
        .where(F.hll_sketch_estimate("sites") >= least_sites * (1 - band)).select("line"),
        "spread-near",
    )
    exact = line.join(near, "line").groupBy("line").agg(F.countDistinct("site").alias("sites"))
    wide = written(exact.where(F.col("sites") >= least_sites).select("line"), "spread-wide")
    held = written(line.join(wide, "line").groupBy("row").agg(F.collect_set("line").alias("wide")), "spread-held")
    # Without the line judged, a text is known by its longest own line, or by a wide one if it is little else.
    by_length = lambda lines: F.sort_array(F.transform(lines, lambda x: F.struct(x["n"], x["h"])), asc=False)
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    parts = measured.join(held.hint("merge"), "row").select(
        by_length(F.filter("lines", lambda x: ~F.array_contains("wide", x["h"]))).alias("own"),
        by_length(F.filter("lines", lambda x: F.array_contains("wide", x["h"]))).alias("shared"),
    ).select(
        "shared", F.get("own", F.lit(0))["h"].alias("own"), chars(F.col("own")).alias("own_chars"), chars(F.col("shared")).alias("shared_chars")
    )
    judged = parts.select("*", F.get("shared", F.lit(0))["h"].alias("first"), F.get("shared", F.lit(1))["h"].alias("second"), F.explode("shared").alias("x"))
    unlike = 4 * F.col("own_chars") >= F.col("shared_chars") - F.col("x.n")
    other = F.when(F.col("x.h") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    family = F.coalesce(F.when(unlike, F.col("own")), other, "own", F.lit(0).cast("long"))
    families = judged.select(F.col("x.h").alias("line"), family.alias("family")).groupBy("line").agg(F.countDistinct("family").alias("families"))
    return families.where(F.col("families") >= least_sites).select("line")


def without_spread(
    docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source", least_sites: int = 10, least_chars: int = 1
) -> DataFrame:
    """All documents and their columns; ``text`` without its spread lines, and a new last column ``n_removed``.

    Lines are equal after normalising (letter case A-Z, digits, white space). A line is spread when at
    least ``least_sites`` distinct sites hold it, in at least as many families of texts, so a text copied
    to many sites keeps its lines, and copies beside unlike texts change nothing. A family has one longest
    line beside the line judged: of the lines that fewer sites hold, if these are a fifth of the rest of
    the text, and else of the others. Lines shorter than ``least_chars`` stay, as do empty ones.

    Null text stays null, a null site counts as one site, repeated rows are treated alike. Only hashes are
    aggregated; the texts move once, to meet the lines that their own document loses.
    """
    mark, drops, out = free_name(docs, "mark"), free_name(docs, "drops"), "n_removed"
    def found(lines: Column) -> Column:
        return F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n"))))

    measured = written(
        docs.select(_mark(id, text).alias("row"), F.xxhash64(site).alias("site"), found(normal_lines(F.col(text))).alias("lines")),
        "spread-measured",
    )
    spread = written(spread_lines(measured, least_sites, least_chars), "spread-lines")
    lost = written(
        measured.select("row", F.explode("lines.h").alias("line")).join(spread, "line")
        .groupBy(F.col("row").alias(mark)).agg(F.collect_set("line").alias(drops)),
        "spread-drops",
    )
    # What documents lose grows with the input, so it is never broadcast.
    joined = docs.withColumn(mark, _mark(id, text)).join(lost.hint("merge"), mark, "left")
    raw = F.split(F.col(text), "\n")

    def stay(normal: Column) -> Column:
        return F.filter(raw, lambda x, i: (F.get(normal, i) == "") | ~F.array_contains(F.col(drops), F.xxhash64(F.get(normal, i))))

    kept = F.when(F.col(drops).isNotNull(), let(normal_lines(F.col(text)), stay))
    kept_name = free_name(joined, "kept_lines")
    before = F.when(F.col(drops).isNull(), F.lit(0)).otherwise(F.size(raw) - F.size(kept_name))
    result = joined.withColumn(kept_name, kept).withColumn(free_name(joined, out), before.cast("long"))
    return result.withColumn(text, F.when(F.col(drops).isNull(), F.col(text)).otherwise(F.array_join(kept_name, "\n"))).drop(mark, drops, kept_name)
