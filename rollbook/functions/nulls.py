"""Turning null-like text into real nulls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# The tokens each source family writes for "no value".
STRICT_TOKENS = ["", " ", "NA"]
SCHOOL_TOKENS = ["", " ", "NA", "na", "N/A", "n/a", "NULL", "null"]
DEGREE_TOKENS = ["", "na", "null", "none", "nan", "-", "--"]
# Fixed value: base64 of the SHA-256 of the empty string, a missing id that was hashed.
HASHED_EMPTY_ID = "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU="


def null_strict(col: Column) -> Column:
    """Null for exactly "", " " and "NA"."""
    return F.when(~col.isin(STRICT_TOKENS), col)


def null_school(col: Column) -> Column:
    """Null for blank text of any length and the usual spellings of NA."""
    return F.when(~(col.rlike(r"^\s*$") | col.isin(SCHOOL_TOKENS)), col)


def null_tokens(col: Column, tokens: Iterable[str] = DEGREE_TOKENS) -> Column:
    """Null when the trimmed, lowered text is one of the tokens."""
    return F.when(~F.lower(F.trim(col)).isin([t.lower() for t in tokens]), col)


def real_id(col: Column) -> Column:
    """A person id, or null when it is blank or the hash of the empty string."""
    return F.when(~F.trim(col).isin("", HASHED_EMPTY_ID), col)


def is_missing(col: Column) -> Column:
    """True for null, "", " " and "NA"."""
    return col.isNull() | col.isin(STRICT_TOKENS)


def clean_strings(df: DataFrame, rule) -> DataFrame:
    """Apply one null rule to every string column in a single projection."""
    return df.select(
        *[
            rule(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
