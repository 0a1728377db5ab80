"""Merkle fingerprints of texts over paragraphs and sections, in DataFrame functions only.

A paragraph is a line with its line end, a section ends with a blank line. A paragraph's node is a digest of
its text, a section's of its paragraphs' digests, the root's of the sections' digests; so equal roots mean
equal texts, and where roots differ, the branches that differ lead to the paragraphs that were edited. Below
each paragraph stand short hashes of its pieces of a few words, which measure how alike two texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.shared import free_name, let

#: Words in a piece.
PIECE = 4
#: A paragraph of so many pieces or fewer is cut into single words.
SHORT = 4
_DIGEST = 16


def _digest(value: Column) -> Column:
    return F.substring(F.sha2(value, 256), 1, _DIGEST)


def tree(text: Column) -> Column:
    """struct<root, sections: array<struct<digest, paragraphs: array<struct<digest, pieces: array<int>>>>>>; null is empty."""

    def cut(x: Column, most: int) -> Column:
        return F.regexp_extract_all(x, F.lit(f"(?:\\s*+\\S++){{1,{most}}}+\\s*+|\\s++"), F.lit(0))

    def paragraph(x: Column) -> Column:
        # Short paragraphs by the word, else an edit leaves nothing to see.
        fine = let(cut(x, PIECE), lambda y: F.when(F.size(y) > SHORT, y).otherwise(cut(x, 1)))
        return F.struct(_digest(x).alias("digest"), F.transform(fine, lambda p: F.hash(p)).alias("pieces"))

    def section(x: Column) -> Column:
        lines = F.transform(F.filter(F.split(x, "(?<=\\n)"), lambda y: y != ""), paragraph)
        return let(lines, lambda y: F.struct(_digest(_joined(y)).alias("digest"), y.alias("paragraphs")))

    sections = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), "(?<=\\n\\n)"), lambda x: x != ""), section)
    return let(sections, lambda x: F.struct(F.sha2(_joined(x), 256).alias("root"), x.alias("sections")))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda n: n["digest"]), "")


def fingerprint(tree_: Column) -> Column:
    """The tree as text: ``root=digest(digest:pieces,digest:pieces);digest(...)``, pieces as eight hexadecimal digits."""

    def paragraph(p: Column) -> Column:
        pieces = F.transform(p["pieces"], lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
        return F.concat(p["digest"], F.lit(":"), F.array_join(pieces, ""))

    def section(s: Column) -> Column:
        return F.concat(s["digest"], F.lit("("), F.array_join(F.transform(s["paragraphs"], paragraph), ","), F.lit(")"))

    return F.concat(tree_["root"], F.lit("="), F.array_join(F.transform(tree_["sections"], section), ";"))


def pieces(tree_: Column) -> Column:
    """The piece hashes of a tree, in order."""
    return F.flatten(F.transform(tree_["sections"], lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["pieces"]))))


def likeness(a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
    """0 to 1: 1 for equal roots, below 1 else: twice the shared pieces by the pieces of both.

    The larger of two counts: distinct pieces shared wherever they stand, and pieces equal at the same place
    (which is right for texts that repeat themselves). Texts without pieces share nothing.
    """

    def part(shared: Column, x: Column, y: Column) -> Column:
        both = F.size(x) + F.size(y)
        return F.when(both == 0, F.lit(0.0)).otherwise(2.0 * shared / both)

    in_place = F.size(F.filter(F.zip_with(of_a, of_b, lambda x, y: x == y), lambda e: e))
    anywhere = let(
        F.struct(F.array_distinct(of_a).alias("a"), F.array_distinct(of_b).alias("b")),
        lambda d: part(F.size(F.array_intersect(d["a"], d["b"])), d["a"], d["b"]),
    )
    most = F.greatest(part(in_place, of_a, of_b), anywhere)
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.least(most, F.lit(0.999999)))


def edited_paragraphs(a: Column, b: Column) -> Column:
    """(section, paragraph) numbers of ``b``, from 0, whose nodes differ from those of ``a`` at the same place.

    Only branches with differing digests are entered; equal roots give an empty array.
    """

    def differing(s: Column, i: Column) -> Column:
        old = F.get(a["sections"], i)
        changed = F.filter(
            F.transform(s["paragraphs"], lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), (~p["digest"].eqNullSafe(F.get(old["paragraphs"], j)["digest"])).alias("x"))),
            lambda x: x["x"],
        )
        none = F.array().cast("array<struct<section:int,paragraph:int>>")
        found = F.transform(changed, lambda x: F.struct(x["section"], x["paragraph"]))
        return F.when(s["digest"].eqNullSafe(old["digest"]), none).otherwise(found)

    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    return F.when(a["root"] == b["root"], none).otherwise(F.flatten(F.transform(b["sections"], differing)))


def with_next_text(docs: DataFrame, id: str, text: str, name: str, rows: int = 2000, most: int = 4096) -> DataFrame:
    """``docs`` with the text of the next document by id; the first follows the last.

    Ids are cut into ranges of about ``rows`` rows (``most`` ranges at most) at values of the id, found by
    approximate quantiles. The document at which a range begins is also sent to the range before, so every
    document meets its successor in its own range and no task sees more than a range. Null ids come first,
    equal ids in the order of their texts.
    """
    facts = docs.agg(F.count("*").alias("n"), F.min(id).alias("first"), F.count(id).alias("with_id")).first()
    ranges = max(1, min(most, facts["n"] // rows))
    cuts = docs.agg(F.percentile_approx(id, [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges)).first()[0]
    cuts = sorted(set(cuts or [])) if ranges > 1 else []
    cuts = [c for c in cuts if c != facts["first"] or facts["with_id"] < facts["n"]]
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    place, last = free_name(docs, "range"), free_name(docs, "wraps")
    halo = free_name(docs, "halo")

    def step(at: Column, s: Column) -> Column:
        return F.when((at + s <= len(cuts)) & (F.get(bounds, at + s - 1) <= F.col(id)), at + s).otherwise(at)

    own = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step) if cuts else F.lit(0)
    here = docs.withColumn(place, F.coalesce(own, F.lit(0))).withColumn(last, F.lit(0)).withColumn(halo, F.lit(False))
    again = F.col(id).isNull() if facts["with_id"] < facts["n"] else F.col(id) == F.lit(facts["first"])
    begins = here.where(F.col(id).isin(cuts)).withColumn(place, F.col(place) - 1).withColumn(halo, F.lit(True)) if cuts else None
    first = docs.where(again).withColumn(place, F.lit(len(cuts))).withColumn(last, F.lit(1)).withColumn(halo, F.lit(True))
    every = here.union(begins).union(first) if begins is not None else here.union(first)
    order = Window.partitionBy(place).orderBy(last, F.col(id).asc_nulls_first(), F.col(text).asc_nulls_first(), halo)
    return every.withColumn(name, F.lead(text).over(order)).where(~F.col(halo)).drop(place, last, halo)


def compare_with_edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of an edited text, and how alike both, and the next one's, are.

    The edited text has its last floor(n / 4) code points replaced by as many first ones (or all) of the next
    document by id. Null text counts as empty, whose tree has no sections; repeated rows stay, each with the
    next row as its next document (ids that repeat are ordered by text); an empty table gives no rows.
    """
    plain = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    near = with_next_text(plain, "id", "text", "next").withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - cut), F.col("next").substr(F.lit(1), cut))
    found = (
        near.withColumn("edited", edited)
        .select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[tree(F.col(c)).alias(c) for c in ("text", "edited", "next")])
        .select("*", *[pieces(F.col(c)).alias(f"of_{c}") for c in ("text", "edited", "next")])
    )
    return found.select(
        F.col("id").alias(id), "n_chars", "edited_sha256",
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited"), F.col("of_text"), F.col("of_edited")).alias("near_edited"),
        likeness(F.col("text"), F.col("next"), F.col("of_text"), F.col("of_next")).alias("near_next"),
        edited_paragraphs(F.col("text"), F.col("edited")).alias("edited_paragraphs"),
    )
