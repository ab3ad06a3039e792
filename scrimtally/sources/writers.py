"""Sinks. Write errors surface; nothing is skipped silently."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .readers import SourceMissing

# smaller files than the default codec, for tables that later stages read again
CODEC = "zstd"


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> DataFrame:
    """Write and return the written table.

    ``cluster_by`` range-partitions and sorts on the given columns, so that
    later look-ups skip row groups. A hash of the whole row is the last range
    column: a key that holds a large share of all rows is cut over many tasks.
    """
    out = df
    if cluster_by:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        out = out.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)
    writer = out.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # the declared schema keeps partition values as text and the column types as written
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_bucketed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int,
    partition_by: Sequence[str] = (),
    laid_out: bool = False,
) -> DataFrame:
    """Write rows hashed into ``buckets`` files by ``keys``; returns the table with that layout known.

    Tables with the same keys and number of buckets join and group on the keys
    without a shuffle. ``laid_out`` says that ``df`` comes from such a table, so
    its tasks hold one bucket each already. The catalog entry lasts as long as
    the session; ``read_bucketed`` makes one for files of an earlier session.
    """
    out = df if laid_out else df.repartition(buckets, *keys)
    writer = out.write.mode("overwrite").format("parquet").option("compression", CODEC).bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    name = f"bucketed_{uuid.uuid4().hex}"
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name).select(*df.columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_table(
    df: DataFrame,
    base: str,
    formats: Iterable[str] = ("parquet", "csv"),
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``base.parquet`` and/or ``base.csv``.

    The CSV form is copied from the Parquet form, so the plan runs once.
    """
    formats = list(formats)
    unknown = set(formats) - {"parquet", "csv"}
    if unknown:
        raise ValueError(f"unknown formats: {sorted(unknown)}")
    result = df
    if "parquet" in formats:
        result = write_parquet(df, f"{base}.parquet", partition_by, cluster_by)
    if "csv" in formats:
        write_csv(result, f"{base}.csv")
    return result


def export_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    formats: Iterable[str] = ("parquet", "csv"),
) -> dict[str, int]:
    """Write every table in every format; returns rows per table.

    The counts come from the written Parquet footers where there are any.
    """
    counts = {}
    for name, df in tables.items():
        counts[name] = write_table(df, f"{folder}/{name}", formats).count()
    return counts


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to an append-only log."""
    df.write.mode("append").parquet(path)


def schema_columns(spark: SparkSession, schema: StructType) -> DataFrame:
    """The published column list of a schema, in order."""
    return spark.createDataFrame(
        [(i, f.name) for i, f in enumerate(schema.fields)], "position int, column string"
    ).orderBy("position").select("column")


def load_jdbc(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    url: str,
    skip: Iterable[str] = (),
    required: Iterable[str] | None = None,
    verify: str | None = "fact_participant",
    batch_size: int = 1000,
    connections: int = 8,
    properties: Mapping[str, str] | None = None,
) -> list[str]:
    """Replace tables in a relational database and check one of them by count.

    Executors write in parallel over at most ``connections`` connections per
    table; a repeated load replaces the tables, it never adds to them.
    """
    skipped = {t.strip() for t in skip if t.strip()}
    names = [t for t in (required or tables) if t not in skipped]
    absent = [t for t in names if t not in tables]
    if absent:
        raise SourceMissing(f"tables to load are missing: {absent}")
    props = dict(properties or {})
    for name in names:
        (
            tables[name]
            .write.mode("overwrite")
            .option("batchsize", batch_size)
            .option("numPartitions", connections)
            .jdbc(url, name, properties=props)
        )
    if verify in names:
        stored = spark.read.jdbc(url, verify, properties=props).count()
        expected = tables[verify].count()
        if stored != expected:
            raise RuntimeError(f"{verify}: {stored} rows stored, {expected} expected")
    return names
