"""Named datasets, readers, writers and published result sets."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

FORMATS = ("parquet", "csv", "json")


@dataclass(frozen=True)
class Dataset:
    name: str
    fmt: str
    path: str
    layer: str


# The datasets of the pipelines, with format, folder and layer.
INTERIM = [
    "geocodes",
    "iti_enrollments", "iti_marks", "iti_applications",
    "diploma_enrollments", "diploma_marks", "diploma_applications",
    "pdis_enrollments", "pdis_marks",
    "iti_institutes_strength", "iti_institutes_cutoffs", "iti_institutes_enrollments",
    "diploma_institutes_strength", "diploma_institutes_cutoffs", "diploma_institutes_enrollments",
    "hss_enrollments", "hss_applications", "hss_marks", "hss_first_choice_admissions",
    "hss_admission_options",
    "deg_enrollments", "deg_applications", "deg_marks",
]
PROCESSED = [
    "iti_marks_and_cutoffs", "iti_vacancies", "diploma_marks_and_cutoffs", "diploma_vacancies",
]
EXTERNAL = {
    "iti_addresses": ("csv", "external/iti_addresses.csv"),
    "village_populations": ("csv", "external/all_districts_villages.csv"),
    "block_shapefiles": ("parquet", "external/block_edges"),
    "district_shapefiles": ("parquet", "external/district_edges"),
    "state_shapefiles": ("parquet", "external/state_edges"),
    "india_border_shapefiles": ("parquet", "external/country_edges"),
}


def default_registry(root: str = "data") -> dict[str, Dataset]:
    """All datasets below a root folder; polygons are edge tables."""
    base = root.rstrip("/")
    found = [Dataset("students", "parquet", f"{base}/raw/students", "raw"),
             Dataset("institutes", "parquet", f"{base}/raw/institutes", "raw")]
    found += [Dataset(n, "parquet", f"{base}/interim/{n}", "interim") for n in INTERIM]
    found += [Dataset(n, "parquet", f"{base}/processed/{n}", "processed") for n in PROCESSED]
    found += [Dataset(n, f, f"{base}/{p}", "external") for n, (f, p) in EXTERNAL.items()]
    return {d.name: d for d in found}


def read_registry(path: str) -> dict[str, Dataset]:
    """Datasets from a YAML file of name → {type, path, layer}."""
    import yaml

    with open(path, encoding="utf-8") as f:
        entries = yaml.safe_load(f)["datasets"]
    return {
        name: Dataset(name, e["type"].lower(), e["path"], e.get("layer", "")) for name, e in entries.items()
    }


def load(spark: SparkSession, dataset: Dataset, schema=None) -> DataFrame:
    """Read a dataset; unknown formats are an error."""
    if dataset.fmt not in FORMATS:
        raise ValueError(f"unsupported format {dataset.fmt!r} of {dataset.name}")
    reader = spark.read.format(dataset.fmt)
    if dataset.fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(dataset.path)


def save(df: DataFrame, dataset: Dataset, partition_by: Iterable[str] = ()) -> None:
    """Write a dataset; unknown formats are an error."""
    if dataset.fmt not in FORMATS:
        raise ValueError(f"unsupported format {dataset.fmt!r} of {dataset.name}")
    keys = list(partition_by)
    spread = df.hint("rebalance", *keys) if keys else df
    writer = spread.write.mode("overwrite").format(dataset.fmt)
    if dataset.fmt == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(*keys).save(dataset.path)


def scan_module(df: DataFrame, module: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Rows of one module, optionally of a closed range of years; prunes partitions."""
    rows = df.where(F.col("module") == module)
    return rows.where(F.col("academic_year").between(*years)) if years else rows


def read_tagged_files(spark: SparkSession, glob: str, tags: dict[str, str], schema=None, whole_path: bool = False) -> DataFrame:
    """All CSV files of a pattern, with integers taken from their names (or paths) by regex.

    ``tags`` maps a new column to a pattern with one group; a name that does
    not match gives null.
    """
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader).csv(glob)
    name = F.col("_metadata.file_path" if whole_path else "_metadata.file_name")
    return df.select(
        "*",
        *[
            F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("int").alias(column)
            for column, pattern in tags.items()
        ],
    )


def write_by_year(df: DataFrame, path: str, year: str = "academic_year") -> None:
    """One folder per year; reading the parent folder gives all years.

    Rebalancing lets a large year be written by several tasks and keeps a small
    one from leaving a file per task.
    """
    df.hint("rebalance", year).write.mode("overwrite").partitionBy(year).parquet(path)


def publish(tables: dict[str, DataFrame] | tuple[list[DataFrame], list[str]], folder: str, fmt: str = "parquet") -> list[str]:
    """Write a named set of result tables, one folder per table."""
    if not isinstance(tables, dict):
        frames, names = tables
        if len(frames) != len(names):
            raise ValueError("as many names as tables are needed")
        if len(set(names)) != len(names):
            raise ValueError("table names must differ")
        tables = dict(zip(names, frames))
    written = []
    for name, df in tables.items():
        target = Dataset(name, fmt, f"{folder.rstrip('/')}/{name}", "output")
        save(df, target)
        written.append(target.path)
    return written


def sql_over(spark: SparkSession, views: dict[str, DataFrame], query: str, functions: dict[str, str] | None = None) -> DataFrame:
    """Run SQL over frames and functions registered under names that are gone afterwards.

    ``functions`` maps a signature such as ``f(x STRING)`` to a SQL expression,
    so a registered function stays inside the JVM like any other expression.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    names = []
    for signature, body in (functions or {}).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        names.append(signature.split("(")[0].strip())
    try:
        return spark.sql(query)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name in names:
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")


def inventory(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Row count and columns of each dataset."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("fields"),
            F.lit(", ".join(df.columns)).alias("columns"),
        )
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def at(dataset: Dataset, path: str) -> Dataset:
    return replace(dataset, path=path)
