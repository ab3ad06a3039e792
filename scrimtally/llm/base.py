"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimtally.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    Cuts the lineage: executors that are lost later repeat from these files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Written:
    """Written tables of one run, by name; one that no later step reads can be dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = self.paths[name] = scratch_dir(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables; only after everything that is made of them has been written."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def columns(df: DataFrame, types: Sequence[tuple[str, str]]) -> DataFrame:
    """Only the named columns, with fixed types; other columns never take part."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types])


def documents(df: DataFrame) -> DataFrame:
    return columns(df, (("doc_id", "bigint"), ("text", "string")))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, UPPER.lower())


# values a bounded filter can tell apart
FILTER = 1 << 19


def passing(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` (a hash) may be among the ``key`` values of ``wanted``.

    Both sides fall into ``FILTER`` buckets, and the buckets in use are broadcast:
    at most that many integers, on any input. Rows that cannot match go before
    they are shuffled; the exact join comes after it.
    """
    bucket = F.pmod(F.col(key), F.lit(FILTER)).cast("int")
    used = wanted.select(bucket.alias("__bucket")).distinct()
    kept = rows.withColumn("__bucket", bucket)
    return kept.join(F.broadcast(used), "__bucket", "left_semi").drop("__bucket")
