"""Recodes of qualification, income, social category and cutoff labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from rollbook.functions.text import title

# Degree names as they appear once lowered and without dots.
DEGREE_NAMES = [
    "ba", "ba passed", "ma", "bped", "mtech", "graduate", "btech", "bsc", "msc", "llb", "mca",
    "pgdca", "blib", "mlib", "bca", "bba", "mba", "bcom", "b com", "mcom", "bed", "med",
    "graduation", "bcam", "pg", "post graduate", "graduate and above",
]
DIPLOMA_NAMES = ["diploma", "jbt/ett", "cped"]
# Fixed values: (label, fragments), tried from top to bottom.
QUALIFICATION_FRAGMENTS = [
    ("Graduate and above", ["graduation", "degree"]),
    ("Diploma", ["diploma", "dped"]),
    ("ITI", ["iti"]),
    ("COE", ["coe"]),
    ("10th", ["10", "matric", "bse"]),
    ("12th", ["hsc", "chse", "12", "intermediate", "intermedia", "plus two", "plus 2"]),
]
# Documented order of examinations, lowest first.
EXAM_ORDER = {"10th": 0, "ITI": 1, "COE": 1, "12th": 2, "Diploma": 3}
# Income labels that differ from the published ones, per module.
INCOME_LABELS = {
    "ITI": {"More than 8,00,000": "Above 6,00,000"},
    "Diploma": {
        "Upto 2.5 lakh": "0-2,50,000",
        "Between 2.5 To 8 lakh": "2,50,000-8,00,000",
        "Above 8 lakh": "Above 8,00,000",
        "--": "OTHER",
    },
}
# Admission statuses, best first, for one application per person and year.
STATUS_PRIORITY = {"ADMITTED": 4, "TC TAKEN": 3, "SELECTED BUT NOT ADMITTED": 2, "NOT SELECTED": 1}
# Order in which the school listing picks an option.
OPTION_PREFERENCE = ["ADMITTED", "SELECTED BUT NOT ADMITTED", "TC TAKEN", "NOT SELECTED"]


def _any_fragment(text: Column, fragments: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(f) for f in fragments])


def standard_qualification(col: Column) -> Column:
    """One of six standard levels; unknown names stay as cleaned text."""
    text = F.trim(F.regexp_replace(F.replace(F.lower(col), F.lit("."), F.lit("")), r"\(.*?\)", ""))
    out = F.when(text.isin(DEGREE_NAMES), "Graduate and above").when(
        text.isin(DIPLOMA_NAMES), "Diploma"
    )
    for label, fragments in QUALIFICATION_FRAGMENTS:
        out = out.when(_any_fragment(text, fragments), label)
    return out.otherwise(text)


def titled_qualification(col: Column) -> Column:
    """Title case, with a leading "+2 " kept as it is."""
    text = F.upper(F.trim(col))
    return F.when(
        text.startswith("+2 "), F.concat(F.lit("+2 "), title(F.substr(text, F.lit(4))))
    ).otherwise(title(text))


def highest_exam(names: Column, compat: bool = False) -> Column:
    """Highest examination among an array of names; the first wins a tie.

    ``compat`` ranks every name other than 10th alike, so the first of those wins.
    """
    short = F.transform(
        names, lambda n: F.replace(F.split(F.trim(n), " ").getItem(0), F.lit("+2"), F.lit("12th"))
    )
    if compat:
        rank = lambda n: F.when(n == "10th", 0).otherwise(1)
    else:
        order = F.create_map(*[F.lit(x) for pair in EXAM_ORDER.items() for x in pair])
        rank = lambda n: F.coalesce(F.try_element_at(order, n), F.lit(-1))
    ranked = F.transform(
        F.filter(short, lambda n: n.isNotNull()),
        lambda n, i: F.struct(rank(n).alias("rank"), (-i).alias("early"), n.alias("name")),
    )
    return F.array_max(ranked).getField("name")


def income_label(col: Column, module: str) -> Column:
    out = col
    for old, new in INCOME_LABELS.get(module, {}).items():
        out = F.when(col == old, new).otherwise(out)
    return out


def reservation_category(
    category: Column, orphan: Column, gc: Column, ph: Column, es: Column, ews: Column
) -> Column:
    """Category from flags first, then UR, SC or ST; a null flag counts as no."""
    yes = lambda flag: F.coalesce(flag, F.lit(False))
    disabled = F.coalesce(~F.lower(F.trim(ph.cast("string"))).isin("no", "false"), F.lit(False))
    return (
        F.when(yes(orphan), "ORPHAN")
        .when(yes(gc), "GC")
        .when(disabled, "PWD")
        .when(yes(es), "ES")
        .when(yes(ews), "EWS")
        .when(category.isin("General", "OBC/SEBC"), "UR")
        .when(category.contains("SC"), "SC")
        .when(category.contains("ST"), "ST")
    )


def coarse_category(col: Column) -> Column:
    return F.when(col.isin("SC", "ST", "UR"), col).otherwise("Other")


def coarse_board(col: Column) -> Column:
    text = F.upper(col)
    odisha = (text.contains("BSE") & text.contains("ODISHA") & ~text.contains("CBSE")) | (
        text.contains("BOARD OF SECONDARY EDUCATION") & text.contains("ODISHA")
    )
    cbse = text.contains("CBSE") | text.contains("CENTRAL BOARD")
    return F.when(odisha, "BSE Odisha").when(cbse, "CBSE").otherwise("Other")


def status_rank(status: Column) -> Column:
    text = F.upper(F.trim(status))
    out = F.lit(0)
    for name, value in STATUS_PRIORITY.items():
        out = F.when(text == name, value).otherwise(out)
    return out


def cutoff_is_local(label: Column) -> Column:
    return label.contains("Loc")


def cutoff_qualification(label: Column) -> Column:
    """ "8th Pass", "10th Fail" and so on; null without Pass or Fail."""
    level = F.when(label.contains("8th"), "8th").when(label.contains("10th"), "10th").otherwise("")
    result = F.when(label.contains("Pass"), " Pass").when(label.contains("Fail"), " Fail")
    return F.concat(level, result)


def cutoff_category(label: Column) -> Column:
    """Text between Pass or Fail and the next underscore; EWS and IMC stand alone."""
    after = lambda word: F.split(F.split(label, word).getItem(1), "_").getItem(0)
    return (
        F.when(label.isin("EWS", "IMC"), label)
        .when(label.contains("Pass"), after("Pass"))
        .when(label.contains("Fail"), after("Fail"))
    )


def cutoff_gender(label: Column) -> Column:
    return F.when(label.contains("_F"), "Female").when(label.contains("_M"), "Male")


def strength_category(col: Column) -> Column:
    """Category name without "Strength" and leading underscores."""
    return F.ltrim(F.replace(col, F.lit("Strength"), F.lit("")), F.lit("_"))


def same_place(a: Column, b: Column, loose: bool = False) -> Column:
    """Whether two district names agree; loose trims and ignores case."""
    if not loose:
        return F.coalesce(a == b, F.lit(False))
    tidy = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return tidy(a) == tidy(b)
