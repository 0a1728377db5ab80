"""Dates, flags, numbers and small numeric classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The six accepted date layouts, in order of trial.
DATE_LAYOUTS = [
    "yyyy-M-d",
    "d-M-yyyy",
    "M/d/yyyy",
    "d MMM yyyy",
    "MMMM d, yyyy",
    "yyyy-M-d H:m:s",
]
# Day-first layouts, ISO before them and month-first as last resort.
DAY_FIRST_LAYOUTS = [
    "yyyy-M-d",
    "yyyy-M-d H:m:s",
    "d-M-yyyy",
    "d/M/yyyy",
    "d.M.yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMMM d, yyyy",
    "M/d/yyyy",
    "M-d-yyyy",
]


def _first_parse(col: Column, layouts: list[str]) -> Column:
    text = F.initcap(F.trim(col))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts])


def to_timestamp_or_null(col: Column) -> Column:
    """Timestamp from text; anything unreadable becomes null."""
    text = F.trim(col)
    return F.coalesce(F.try_to_timestamp(text), _first_parse(col, DATE_LAYOUTS))


def checked_date(col: Column) -> Column:
    """Struct (ok, value): whether the text has one of the six layouts."""
    value = _first_parse(col, DATE_LAYOUTS)
    return F.struct(value.isNotNull().alias("ok"), value.alias("value"))


def to_date_day_first(col: Column, allow_year_only: bool = True) -> Column:
    """Date from text, day before month; a bare year 1900-2100 means Jan 1."""
    parsed = _first_parse(col, DAY_FIRST_LAYOUTS).cast("date")
    if not allow_year_only:
        return parsed
    year = F.trim(col).try_cast("int")
    january = F.make_date(year, F.lit(1), F.lit(1))
    return F.when(year.between(1900, 2100), january).otherwise(parsed)


def yes_no(col: Column, true_val: str = "Yes", false_val: str = "No") -> Column:
    """Boolean from two exact spellings, else null."""
    return F.when(col == true_val, True).when(col == false_val, False)


def yes_no_any_case(col: Column) -> Column:
    """Boolean from yes/no in any case and with blanks around, else null."""
    return yes_no(F.lower(F.trim(col)), "yes", "no")


# Digits with at most one point, an optional sign and exponent, blanks around.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(col: Column) -> Column:
    """Double from a decimal number; any other text becomes null.

    Suffixes ("5d"), hexadecimal numbers, NaN and Infinity are not numbers
    here, also not those that a double column holds.
    """
    return F.when(col.cast("string").rlike(DECIMAL), col.try_cast("double"))


def within(col: Column, low: float | None, high: float | None) -> Column:
    """The number when inside the closed range, else null."""
    value = number(col)
    keep = F.lit(True)
    if low is not None:
        keep = keep & (value >= low)
    if high is not None:
        keep = keep & (value <= high)
    return F.when(keep, value)


def passing_year(col: Column) -> Column:
    return within(col, 1970, 2025)


def percentage_in_range(col: Column) -> Column:
    return within(col, 0, 100)


def marks_percentage(secured: Column, total: Column) -> Column:
    """Secured over total in percent; null above 100 or for a zero total."""
    pct = F.try_divide(number(secured), number(total)) * 100
    return F.when(~(pct > 100), pct)


def grade_point_percentage(secured: Column, total: Column) -> Column:
    """Percent, reading a total of 10 as a grade point average times 9.5."""
    s, t = number(secured), number(total)
    return F.when(t == 10, s * 9.5).otherwise(F.try_divide(s, t) * 100)


def round_half_even(col: Column, digits: int = 0) -> Column:
    """Round ties to the even neighbour, scaling as array libraries do."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def fixed_decimals(col: Column, digits: int = 1) -> Column:
    """Number as text with a fixed count of decimals, for published tables."""
    return F.format_string(f"%.{digits}f", col.cast("double"))


def utilisation_class(applicants: Column, seats: Column) -> Column:
    """Demand above 1.1 or below 0.9 of the seats; the rest is balanced."""
    return (
        F.when(applicants > seats * 1.1, "Overutilized")
        .when(applicants < seats * 0.9, "Underutilized")
        .otherwise("Balanced")
    )


def available_seats(seats: Column, applicants: Column, clip: bool = False) -> Column:
    left = seats - applicants
    return F.greatest(left, F.lit(0)) if clip else left


def vacancy_ratio(vacancies: Column, strength: Column, percent: bool = False) -> Column:
    ratio = F.try_divide(vacancies, strength)
    return ratio * 100 if percent else ratio


def gap_class(years: Column) -> Column:
    return (
        F.when(years == 0, "Fresh graduate").when(years <= 3, "1-3 years").otherwise("> 3 years")
    )


def dropped_out(result_y1: Column, result_y2: Column, period: Column) -> Column:
    """True when the final-year result of the course is missing."""
    one_year = (period == "1 Year") & result_y1.isNull()
    two_years = (period == "2 Years") & result_y2.isNull()
    return F.coalesce(one_year, F.lit(False)) | F.coalesce(two_years, F.lit(False))


def passed(result_y1: Column, result_y2: Column, period: Column) -> Column:
    """True when the result of the course's final year is a pass."""
    one_year = (period == "1 Year") & (result_y1 == "pass")
    two_years = (period == "2 Years") & (result_y2 == "pass")
    return F.coalesce(one_year, F.lit(False)) | F.coalesce(two_years, F.lit(False))
