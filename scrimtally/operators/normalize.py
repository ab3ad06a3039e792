"""Several sources to one common table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import add_metrics, clean_role, millis_to_utc, normalize_id, to_long, to_utc
from ..sources import read_columns
from .flatten import flatten_matches


def _typed(df: DataFrame, field: T.StructField) -> Column:
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.TimestampNTZType):
        return to_utc(c)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return to_long(c).try_cast(kind.simpleString())
    if isinstance(kind, T.DoubleType):
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number)
    return c.try_cast(kind.simpleString())


def conform(df: DataFrame, schema: T.StructType = S.COMMON) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Absent columns are null, others are dropped, unreadable values and NaN
    become null.
    """
    return df.select(
        *[
            (_typed(df, f) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def normalize(
    df: DataFrame,
    source: str,
    tier: str | None = None,
    rename: Mapping[str, str] | None = None,
    queue: int | None = None,
    clean_roles: bool = False,
    role_fallback: str | None = None,
    metrics: bool = False,
    start_millis: str | None = None,
    schema: T.StructType = S.COMMON,
) -> DataFrame:
    """One source in the common schema.

    ``queue`` keeps one game mode, ``role_fallback`` names the column that
    replaces a missing position, ``start_millis`` the epoch-millisecond column
    that replaces a missing start time.
    """
    out = df.withColumnsRenamed(dict(rename or {}))
    if queue is not None:
        out = out.filter(F.col("queue_id") == queue)
    added = {
        "data_source": F.lit(source),
        "match_id": normalize_id("match_id"),
    }
    if tier is not None:
        added["source_tier"] = F.lit(tier)
    if clean_roles:
        fallback = F.col(role_fallback) if role_fallback else None
        added["team_position"] = clean_role("team_position", fallback)
    if start_millis in out.columns and "game_start_utc" not in out.columns:
        added["game_start_utc"] = millis_to_utc(start_millis)
    out = out.withColumns(added)
    if metrics:
        out = add_metrics(out)
    return conform(out, schema)


def normalize_collected(df: DataFrame, source: str = "riot_api") -> DataFrame:
    """The incrementally collected source: already enriched, roles kept as they are."""
    return normalize(df, source, start_millis="game_start_timestamp")


def normalize_tabular(df: DataFrame, source: str = "kaggle") -> DataFrame:
    """The second source: fixed columns, ranked queue only, roles with a fallback."""
    narrow = read_columns(df, S.TABULAR_COLUMNS, S.TABULAR_RENAMES)
    return normalize(
        narrow,
        source,
        tier=source,
        queue=S.RANKED_QUEUE,
        clean_roles=True,
        role_fallback="individual_position",
        metrics=True,
    )


def normalize_documents(
    raw: DataFrame, source: str = "riot_full", json_col: str = "_raw_json"
) -> DataFrame:
    """The bulk source: raw match documents, ranked queue only."""
    return normalize(
        flatten_matches(raw, json_col, source_tier=source, queue=S.RANKED_QUEUE),
        source,
        clean_roles=True,
        metrics=True,
        start_millis="game_start_timestamp",
    )


def start_text(df: DataFrame, millis: str = "game_start_timestamp") -> DataFrame:
    """Add the start time as formatted text if the source lacks it."""
    if "game_start_utc" in df.columns:
        return df
    text = F.date_format(millis_to_utc(millis), "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("game_start_utc", text)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack sources by column name, keeping every row."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def started_between(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "game_start_utc"
) -> DataFrame:
    """Matches that started within [start, end]; ISO text, either side open."""
    out = df
    if start:
        out = out.filter(F.col(column) >= to_utc(F.lit(start)))
    if end:
        out = out.filter(F.col(column) <= to_utc(F.lit(end)))
    return out
