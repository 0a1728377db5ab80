"""Reading JSON payload columns. Each payload is parsed once."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_records(col: Column, fields: list[str]) -> Column:
    """Array of structs with the named text fields; null unless the text is a list."""
    body = ", ".join(f"`{f}` string" for f in fields)
    parsed = F.from_json(col, f"array<struct<{body}>>")
    return F.when(F.ltrim(col).startswith("["), parsed)


def json_maps(col: Column) -> Column:
    """Array of text maps, for lists whose keys are not known."""
    parsed = F.from_json(col, "array<map<string,string>>")
    return F.when(F.ltrim(col).startswith("["), parsed)


def json_object(col: Column) -> Column:
    """Text map of one JSON object; null for anything else."""
    return F.when(F.ltrim(col).startswith("{"), F.from_json(col, "map<string,string>"))


def json_path(col: Column, path: str, to: str = "string") -> Column:
    """One value by path, cast without failing."""
    return F.get_json_object(col, path).try_cast(to)


def first_value(records: Column, field: str) -> Column:
    """Field of the first element, null for an empty or missing list."""
    return F.get(records, 0).getField(field)


def value_where(records: Column, key: str, equals: str, field: str) -> Column:
    """Field of the first element whose key has the value."""
    return F.get(F.filter(records, lambda r: r.getField(key) == equals), 0).getField(field)


def any_equal(records: Column, field: str, value: str) -> Column:
    """ "Yes" when some element has the value, else "No"; a missing list is "No"."""
    hit = F.exists(records, lambda r: F.coalesce(r.getField(field) == value, F.lit(False)))
    return F.when(F.coalesce(hit, F.lit(False)), "Yes").otherwise("No")


def preferred_record(records: Column, field: str, preference: list[str]) -> Column:
    """First element having the most preferred value; null when none is listed."""
    order = F.array(*[F.lit(p) for p in preference])
    place = lambda r: F.array_position(order, r.getField(field))
    listed = F.filter(records, lambda r: F.coalesce(place(r), F.lit(0)) > 0)
    ranked = F.transform(
        listed, lambda r, i: F.struct(place(r).alias("p"), i.alias("i"), r.alias("r"))
    )
    return F.array_min(ranked).getField("r")


def list_size(records: Column) -> Column:
    """Number of elements; 0 for a missing list."""
    return F.coalesce(F.size(records), F.lit(0))


def rename_keys(mapping: Column, rename: Column | None = None) -> Column:
    """Map with its keys in snake case."""
    from rollbook.functions.text import snake

    return F.transform_keys(mapping, lambda k, _: snake(k))
