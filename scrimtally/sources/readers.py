"""Scans. CSV schemas are always declared, never inferred."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# the list of bucketed tables of a star folder: name, keys, buckets, parts
LAYOUT = "_layout.parquet"


class SourceMissing(FileNotFoundError):
    """A required table has neither a Parquet nor a CSV form."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a path or glob matches something on the path's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, on its own file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_parquet(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Parquet file, folder or glob, optionally narrowed to some columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def read_bucketed(
    spark: SparkSession, path: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Files that ``write_bucketed`` wrote, with their layout known to the planner."""
    found = read_parquet(spark, path)
    name = f"bucketed_{uuid.uuid4().hex}"
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    parts = f"PARTITIONED BY ({quoted(partition_by)})" if partition_by else ""
    place = path.replace("'", "\\'")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields]
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(kinds)}) USING parquet {parts} "
        f"CLUSTERED BY ({quoted(keys)}) SORTED BY ({quoted(keys)}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*found.columns)


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; quotes inside quoted text are doubled.

    The declared types decide how ids are read, so long ids stay text. Keep
    ``multi_line`` off where no text holds line breaks: files then split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_csv_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if path_exists(spark, path):
        return read_csv(spark, path, schema)
    return spark.createDataFrame([], schema)


def resolve_source(
    spark: SparkSession, base: str, schema: StructType | None = None
) -> DataFrame:
    """Parquet form of a table if there is one, else its CSV form, else an error."""
    if path_exists(spark, f"{base}.parquet"):
        return read_parquet(spark, f"{base}.parquet", schema=schema)
    if path_exists(spark, f"{base}.csv"):
        if schema is None:
            raise ValueError(f"{base}.csv needs a declared schema")
        return read_csv(spark, f"{base}.csv", schema)
    raise SourceMissing(f"neither {base}.parquet nor {base}.csv exists")


def read_columns(
    df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Keep some columns of a tabular source and rename a few of them."""
    return df.select(*columns).withColumnsRenamed(dict(renames or {}))


def read_optional(
    spark: SparkSession, base: str, schema: StructType | None = None
) -> DataFrame | None:
    try:
        return resolve_source(spark, base, schema)
    except SourceMissing:
        return None


def present(frames: Iterable[DataFrame | None]) -> list[DataFrame]:
    """The frames of the sources that exist."""
    return [df for df in frames if df is not None]


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> None:
    """Make tables (frames or Parquet paths) visible to ``spark.sql``."""
    for name, table in tables.items():
        df = read_parquet(spark, table) if isinstance(table, str) else table
        df.createOrReplaceTempView(name)


def missing_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> list[str]:
    """Names with neither a Parquet nor a CSV form in the folder."""
    return [
        n
        for n in names
        if not path_exists(spark, f"{folder}/{n}.parquet")
        and not path_exists(spark, f"{folder}/{n}.csv")
    ]


def read_star(
    spark: SparkSession,
    folder: str,
    names: Iterable[str],
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """Named star tables of a folder; raises with the list of missing ones.

    Tables in the folder's layout list (a row each) come back with their buckets.
    """
    names = list(names)
    absent = missing_tables(spark, folder, names)
    if absent:
        raise SourceMissing(f"star tables missing in {folder}: {absent}")
    schemas = schemas or {}
    if path_exists(spark, f"{folder}/{LAYOUT}"):
        layout = {r["name"]: r for r in read_parquet(spark, f"{folder}/{LAYOUT}").collect()}
        return {
            n: read_bucketed(spark, f"{folder}/{n}.parquet", layout[n]["keys"], layout[n]["buckets"], layout[n]["parts"])
            if n in layout
            else resolve_source(spark, f"{folder}/{n}", schemas.get(n))
            for n in names
        }
    return {n: resolve_source(spark, f"{folder}/{n}", schemas.get(n)) for n in names}
