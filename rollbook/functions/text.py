"""Names, addresses and other text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Spellings that sources get wrong, with the stored spelling.
SPELLING = {"Tength": "Tenth", "tength": "tenth", "OR": "Or"}
WHOLE_WORD_SPELLING = {"TypeofInstitute": "type_of_institute", "cuttoff": "cutoff"}
# Fixed pattern: a capital that begins a word inside a name.
INNER_WORD = r"(?<=[^_])(?=[A-Z][a-z])"


def fix_spelling(text: str) -> str:
    for wrong, right in SPELLING.items():
        text = text.replace(wrong, right)
    return WHOLE_WORD_SPELLING.get(text, text)


def snake_name(text: str) -> str:
    """Camel case to snake case for column names (driver side, names only)."""
    fixed = fix_spelling(text.lower() if text.isupper() else text)
    return re.sub(INNER_WORD, "_", fixed).lower()


def snake(col: Column) -> Column:
    """The same conversion for column values."""
    all_caps = (F.upper(col) == col) & (F.lower(col) != col)
    text = F.when(all_caps, F.lower(col)).otherwise(col)
    for wrong, right in SPELLING.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    fixed = text
    for wrong, right in WHOLE_WORD_SPELLING.items():
        fixed = F.when(text == wrong, right).otherwise(fixed)
    return F.lower(F.regexp_replace(fixed, INNER_WORD, "_"))


def normalise_text(col: Column, split_words: bool = True) -> Column:
    """Lower snake text: blanks and hyphens to single underscores; "" is null."""
    text = F.regexp_replace(F.trim(col), r"\s+", " ")
    text = snake(text) if split_words else F.lower(text)
    text = F.regexp_replace(F.regexp_replace(text, r"[ \-]", "_"), r"_{2,}", "_")
    return F.when(text != "", text)


def title(col: Column) -> Column:
    """Every letter after a non-letter is upper, all others lower."""
    pieces = F.split(F.lower(col), r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def address_line(
    address: Column, block: Column, district: Column, state: Column, pin: Column
) -> Column:
    """First comma part of the address, then block, district, state and pin."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rest = F.concat(part(block), F.lit(", "), part(district), F.lit(", "), part(state), F.lit(" "), part(pin))
    first = F.split(address, ", ").getItem(0)
    return F.when(address.isNull(), rest).otherwise(F.concat(first, F.lit(", "), rest))


def tidy_address(col: Column) -> Column:
    """Even out blanks, commas and hyphens and set title case; "" is null."""
    text = F.regexp_replace(F.trim(col), r"\s+", " ")
    text = F.regexp_replace(text, r"\s*,\s*", ", ")
    text = F.regexp_replace(text, r"(?<=\w)\s*-\s*(?=\w)", " - ")
    text = F.regexp_replace(text, r"(,\s*){2,}", ", ")
    return F.when(F.trim(col) != "", title(text))


def tidy_address_or_parts(address: Column, parts: list[Column]) -> Column:
    """The tidied address; without one, the tidied list of known parts."""
    joined = F.concat_ws(", ", *[p.cast("string") for p in parts])
    return F.coalesce(tidy_address(address), tidy_address(joined))


def institute_address(address: Column, district: Column, state: Column) -> Column:
    return F.concat_ws(", ", address, district, state)


def tidy_name(col: Column, titled: bool = False) -> Column:
    """Unescape "&amp;", squeeze blanks and trim; optionally title case."""
    text = F.trim(F.regexp_replace(F.regexp_replace(col, "&amp;", "&"), r"\s{2,}", " "))
    return title(text) if titled else text


def block_name(col: Column) -> Column:
    """Block name without bracketed parts and the word sadar, lowered."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(col, r"\(.*?\)", "")), "sadar", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def alias_name(col: Column, aliases: dict[str, str]) -> Column:
    """Replace known aliases (for example renamed districts), keep the rest."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col), col)


def roll_tail(col: Column) -> Column:
    """ "00" and everything after the first character of the number."""
    return F.concat(F.lit("00"), F.substr(col.cast("string"), F.lit(2)))


def strip_quote(col: Column) -> Column:
    return F.btrim(col.cast("string"), F.lit("'"))


def first_word_lower(col: Column) -> Column:
    return F.lower(F.split(col, " ").getItem(0))


def has_blank_or_punctuation(col: Column) -> Column:
    return col.rlike(r"[\s\p{Punct}]")
