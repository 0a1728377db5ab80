"""Resumable landing of record files into a deduplicated Parquet table.

Each micro-batch writes below ``batch=<id>`` and is committed last, by one empty file, so readers see whole
batches only and a batch that runs again after a failure overwrites what nobody has seen.

    rows      accepted records, by batch and the partition columns
    rejects   the others, with a reason
    log       records of each batch, and the last page of each source that it read
    counts    accepted records of each batch by the partition columns
    keys      a Bloom filter of each batch's keys, by the partition columns that are part of the key
    commits   a file for each batch that is complete

A batch compares its keys with the filters and reads only the landed partitions that may hold one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rollbook.sources.landing import split_new

#: Bits of a block of a filter, bits spent on a key, and how many of them a key sets.
BLOCK_BITS, KEY_BITS, SET_BITS = 32768, 12, 5


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def committed(spark: SparkSession, table: str) -> list[int]:
    """Batches that are complete."""
    files, folder = _files(spark, f"{table}/commits")
    return sorted(int(f.getPath().getName()) for f in files.listStatus(folder)) if files.exists(folder) else []


def _commit(spark: SparkSession, table: str, batch_id: int) -> None:
    files, path = _files(spark, f"{table}/commits/{batch_id}")
    files.create(path, True).close()


def _part(spark: SparkSession, table: str, part: str, before: int | None = None) -> DataFrame:
    """A part of the table, of the batches that are complete (and earlier than ``before``)."""
    batches = [b for b in committed(spark, table) if before is None or b < before]
    return spark.read.option("basePath", f"{table}/{part}").parquet(f"{table}/{part}").where(F.col("batch").isin(batches))


def _hash(key: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in key])


def _place(h: Column, n: int) -> Column:
    """The n-th bit that a key sets in its block."""
    return F.pmod(F.xxhash64(h, F.lit(n)), F.lit(BLOCK_BITS))


def _whole(key: list[str]) -> Column:
    return F.concat(*[F.col(k).cast("string") for k in key]).isNotNull()


def key_filters(rows: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Bloom filters of the keys in each group of ``by``: blocks of 4 KB, of which a key sets bits in one.

    A group has as many blocks as its keys need; nothing is gathered but the bits of a block.
    """
    hashed = rows.where(_whole(key)).select(*by, _hash(key).alias("_h"))
    group = F.struct(F.lit(0), *by)
    sizes = hashed.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) * KEY_BITS / BLOCK_BITS).alias("blocks"))
    placed = hashed.withColumn("_g", F.xxhash64(group)).join(sizes.select(F.xxhash64(group).alias("_g"), "blocks"), "_g").drop("_g")
    bits = F.explode(F.array(*[_place(F.col("_h"), n) for n in range(SET_BITS)]))
    return placed.select(*by, "blocks", F.pmod("_h", F.col("blocks")).alias("block"), bits.alias("_bit")).groupBy(*by, "blocks", "block").agg(
        F.bitmap_construct_agg("_bit").alias("bits")
    )


def may_hold(rows: DataFrame, key: list[str], by: list[str], filters: DataFrame) -> DataFrame:
    """(batch, by): the landed groups whose filter has all bits of some key of ``rows``."""
    asked = rows.where(_whole(key)).select(*by, _hash(key).alias("_h")).distinct()
    sizes = filters.select("batch", *by, "blocks").distinct()
    pairs = asked.join(sizes, by) if by else asked.join(sizes.withColumn("_one", F.lit(1)), F.lit(1) == F.col("_one")).drop("_one")
    placed = pairs.withColumn("block", F.pmod("_h", F.col("blocks")))
    found = placed.join(filters.drop("blocks"), ["batch", *by, "block"])

    def is_set(n: int) -> Column:
        bit = _place(F.col("_h"), n)
        byte = F.conv(F.hex(F.substr("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) > 0

    hit = is_set(0)
    for n in range(1, SET_BITS):
        hit = hit & is_set(n)
    return found.where(hit).select("batch", *by).distinct()


def _existing(spark: SparkSession, rows: DataFrame, table: str, batch_id: int, key: list[str], by: list[str]) -> DataFrame | None:
    """Landed rows that may share a key with the batch; None where no filter says so."""
    if not [b for b in committed(spark, table) if b < batch_id]:
        return None
    near = may_hold(rows, key, by, _part(spark, table, "keys", batch_id))
    if near.isEmpty():
        return None
    # Partition columns on both sides: Spark skips the folders that are not listed.
    return _part(spark, table, "rows", batch_id).join(near, ["batch", *by], "left_semi")


def land_batch(
    batch: DataFrame, batch_id: int, table: str, key: list[str], required: list[str], order: str,
    partition_by: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None, position: list[str] | None = None,
) -> None:
    """Append the new rows of one batch with its rejects, log, counts and key filters; nothing if it is there already.

    The prepared batch is evaluated once, into the table's staging folder; everything else comes from
    there, and the folder goes when it is written. ``position`` names columns of the batch that are no part of its
    records, the last of which is a page number: the highest one for each value of the others is logged.
    """
    spark = batch.sparkSession
    if batch_id in committed(spark, table):
        return
    raw = batch.drop(*position) if position else batch
    prepared = prepare(raw) if prepare else raw
    staging = f"{table}/staging/batch={batch_id}"
    prepared.write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(prepared.schema).parquet(staging)
    by = [c for c in partition_by if c in key]
    accepted, rejected = split_new(rows, key, required, order, _existing(spark, rows, table, batch_id, key, by))
    out = lambda part: f"{table}/{part}/batch={batch_id}"
    accepted.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(out("rows"))
    rejected.write.mode("overwrite").parquet(out("rejects"))
    written = spark.read.schema(accepted.schema).parquet(out("rows"))
    written.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("count")).write.mode("overwrite").parquet(out("counts"))
    key_filters(written, key, by).write.mode("overwrite").parquet(out("keys"))
    rows.agg(F.count(F.lit(1)).alias("records"), F.current_timestamp().alias("at")).write.mode("overwrite").parquet(out("log"))
    if position:
        *source, page = position
        batch.groupBy(*source).agg(F.max(page).alias(page)).write.mode("overwrite").parquet(out("pages"))
    _commit(spark, table, batch_id)
    files, folder = _files(spark, staging)
    files.delete(folder, True)


def land_files(
    spark: SparkSession, source: str, schema: StructType | str, table: str, checkpoint: str, key: list[str],
    required: list[str], order: str, partition_by: list[str], fmt: str = "json",
    files_per_batch: int | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, position: dict[str, Column] | None = None,
) -> StreamingQuery:
    """Start landing all files that arrived since the last run; ends by itself.

    Raw records are read as lines (``fmt="text"``, schema "value string") and prepared with
    ``normalise_lines``, which knows every spelling of a field. A file is a page: which ones are done is in the
    checkpoint, so a run that was killed goes on with the next, and ``next_pages`` tells a fetcher where to go on
    when ``position`` finds module, year and page (in this order) in ``_metadata.file_path``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.load(source)
    if position:  # a batch no longer knows its files
        pages = pages.select("*", *[c.alias(name) for name, c in position.items()])
    return (
        pages.writeStream
        .foreachBatch(lambda df, i: land_batch(df, i, table, key, required, order, partition_by, prepare, list(position) if position else None))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def landed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all complete batches."""
    return _part(spark, table, "rows").drop("batch")


def landed_counts(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Landed rows by partition columns, added up from what each batch has counted; no row is read."""
    return _part(spark, table, "counts").groupBy(*keys).agg(F.sum("count").alias("count"))


def next_pages(spark: SparkSession, table: str, source: list[str], page: str) -> DataFrame:
    """For each source the page after the last one that a complete batch has read."""
    return _part(spark, table, "pages").groupBy(*source).agg((F.max(page) + 1).alias(page))


def load_log(spark: SparkSession, table: str) -> DataFrame:
    """Records per batch with the running total (one row per batch)."""
    from pyspark.sql import Window

    return _part(spark, table, "log").withColumn("total", F.sum("records").over(Window.orderBy("batch")))
