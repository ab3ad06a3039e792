"""Batch stages from raw sources to a loaded star, as plain functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..functions import RU, Labels
from ..operators.normalize import (
    normalize_collected,
    normalize_documents,
    normalize_tabular,
    union_sources,
)
from ..operators.quality import Rules, has_errors, run_checks
from ..sources import present, schema_columns, write_csv, write_table
from .star import integrity, write_star


class QualityError(RuntimeError):
    """The quality gate or the star integrity check failed."""


def build_common(
    collected: DataFrame | None = None,
    tabular: DataFrame | None = None,
    documents: DataFrame | None = None,
) -> DataFrame:
    """All present sources in one common table."""
    steps = (
        (collected, normalize_collected),
        (tabular, normalize_tabular),
        (documents, normalize_documents),
    )
    frames = present(None if df is None else step(df) for df, step in steps)
    if not frames:
        raise ValueError("no source given")
    return union_sources(frames)


def write_common(spark: SparkSession, common: DataFrame, folder: str, formats=("parquet",)) -> DataFrame:
    """Store the common table, laid out by source, and its column list."""
    written = write_table(
        common, f"{folder}/all_matches_common", formats, partition_by=["data_source"]
    )
    write_csv(schema_columns(spark, S.COMMON).coalesce(1), f"{folder}/common_schema_columns.csv")
    return written


def gate(
    common: DataFrame, folder: str, rules: Rules = Rules(), strict: bool = False
) -> DataFrame:
    """Store the quality report; raise if a check failed."""
    report = write_table(run_checks(common, rules), f"{folder}/data_quality_report")
    if has_errors(report, strict):
        raise QualityError(f"quality checks failed, see {folder}/data_quality_report.parquet")
    return report


def run_all(
    spark: SparkSession,
    folder: str,
    champions: DataFrame,
    items: DataFrame,
    collected: DataFrame | None = None,
    tabular: DataFrame | None = None,
    documents: DataFrame | None = None,
    rules: Rules = Rules(),
    strict: bool = False,
    labels: Labels = RU,
) -> dict[str, DataFrame]:
    """Normalise, check, build the star and verify it. Each stage reads written tables."""
    common = write_common(spark, build_common(collected, tabular, documents), f"{folder}/normalized")
    gate(common, f"{folder}/data_quality", rules, strict)
    star = write_star(spark, common, champions, items, f"{folder}/star", rules.group_size, labels)
    check = integrity(star["fact_participant"], star["dim_match"], rules.group_size).first()
    if not check["ok"]:
        raise QualityError(
            f"{check['fact_rows']} fact rows do not fit {check['dim_matches']} matches"
        )
    return star
