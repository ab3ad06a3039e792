"""Data-quality gate over the common table.

Row-level checks share one aggregation; duplicates and match sizes share one
grouping. The result is a DataFrame ``check, passed, severity, detail``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import UNDEFINED_ROLE

ERROR, WARN = "ERROR", "WARN"
_REPORT = "check string, passed boolean, severity string, detail string"


@dataclass(frozen=True)
class Rules:
    group_size: int = 10
    queue: int = S.RANKED_QUEUE
    teams: tuple[int, ...] = (100, 200)
    win_tolerance: float = 0.01
    undefined_share: float = 0.05
    roles: tuple[str, ...] = (*S.STANDARD_POSITIONS, UNDEFINED_ROLE)
    # Columns that must exist, must be filled, must not be negative.
    critical: tuple[str, ...] = (
        "data_source", "match_id", "participant_id", "puuid", "champion_id",
        "champion_name", "team_id", "win", "team_position", "queue_id", "kills",
        "deaths", "assists", "kda", "gold_per_min", "damage_per_min",
    )
    filled: tuple[str, ...] = ("match_id", "puuid", "champion_id")
    non_negative: tuple[str, ...] = (
        "kills", "deaths", "assists", "gold_earned", "gold_spent",
        "total_damage_dealt_to_champions", "total_damage_taken", "vision_score",
        "wards_placed", "wards_killed", "dragon_kills", "baron_kills",
        "game_duration_sec", "game_duration_min",
    )


def _entry(check: str | Column, passed: Column, detail: Column, severity: str = ERROR) -> Column:
    name = F.lit(check) if isinstance(check, str) else check
    return F.struct(
        name.alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
    )


def _zero(check: str, n: Column, what: str, severity: str = ERROR) -> Column:
    n = F.coalesce(n, F.lit(0))
    return _entry(check, n == 0, F.concat(n.cast("string"), F.lit(f" {what}")), severity)


def _skipped(check: str, missing: Sequence[str], severity: str = ERROR) -> Column:
    text = f"not evaluated, columns missing: {', '.join(missing)}"
    return _entry(check, F.lit(False), F.lit(text), severity)


def _rows(df: DataFrame, entries: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*entries)))


def _listed(flags: dict[str, Column]) -> Column:
    """Names of the flags that are set, joined by commas."""
    parts = [F.when(flag, F.lit(name)) for name, flag in flags.items()]
    return F.array_join(F.array_compact(F.array(*parts)), ", ")


def is_blank(c: str) -> Column:
    """Null, or the empty text a missing id turns into on normalisation."""
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


def is_not_finite(c: str) -> Column:
    v = F.col(c)
    return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))


def unexpected_roles(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every role outside the allowed set, with its number of rows."""
    role = F.col("team_position")
    return (
        df.filter(role.isNotNull() & ~role.isin(*rules.roles))
        .groupBy("team_position")
        .agg(F.count("*").alias("rows"))
    )


def duplicate_participants(df: DataFrame) -> DataFrame:
    """Participant keys held by more than one row (null keys count as equal)."""
    return (
        df.groupBy(*S.PARTICIPANT_KEY)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def _row_counters(df: DataFrame, rules: Rules) -> dict[str, Column]:
    """What the checks of single rows count."""
    has = set(df.columns)
    aggs: dict[str, Column] = {"total": F.count("*")}
    for c in rules.filled:
        if c in has:
            aggs[f"blank_{c}"] = F.count_if(is_blank(c))
    for c in rules.non_negative:
        if c in has:
            aggs[f"negative_{c}"] = F.count_if(F.col(c) < 0)
    if "team_id" in has:
        valid = F.coalesce(F.col("team_id").isin(*rules.teams), F.lit(False))
        aggs["bad_team"] = F.count_if(~valid)
    if "queue_id" in has:
        aggs["bad_queue"] = F.count_if(~F.col("queue_id").eqNullSafe(rules.queue))
    if "kda" in has:
        aggs["bad_kda"] = F.count_if(is_not_finite("kda"))
    if "team_position" in has:
        role = F.col("team_position")
        aggs["undefined"] = F.count_if(role == UNDEFINED_ROLE)
        aggs["unexpected"] = F.count_if(role.isNotNull() & ~role.isin(*rules.roles))
    return aggs


def _row_level(df: DataFrame, rules: Rules) -> DataFrame:
    """One scan for every check that looks at single rows, and the balance of every source.

    Rows are counted per source; the sources' counts then add up in one row,
    which also lists the mean outcome of each source.
    """
    has = set(df.columns)
    aggs = _row_counters(df, rules)
    absent = [c for c in ("data_source", "win") if c not in has]
    if absent:
        stats = df.agg(*[a.alias(n) for n, a in aggs.items()])
    else:
        rate = F.avg(F.col("win").cast("int").cast("double")).alias("rate")
        by_source = df.groupBy("data_source").agg(rate, *[a.alias(n) for n, a in aggs.items()])
        listed = F.when(F.col("data_source").isNotNull(), F.struct(F.col("data_source").alias("source"), "rate"))
        # no source at all: a table without rows
        stats = by_source.agg(
            F.collect_list(listed).alias("rates"),
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in aggs],
        )

    missing = [c for c in rules.critical if c not in has]
    total = F.col("total")
    schema_text = "all critical columns present" if not missing else f"missing: {', '.join(missing)}"
    out = [
        _entry("not_empty", total > 0, F.concat(total.cast("string"), F.lit(" rows"))),
        _entry("schema_columns", F.lit(not missing), F.lit(schema_text)),
    ]

    blanks = {c: F.col(f"blank_{c}") > 0 for c in rules.filled if c in has}
    negatives = {c: F.col(f"negative_{c}") > 0 for c in rules.non_negative if c in has}
    for check, flags, fine in (
        ("keys_not_null", blanks, "no missing keys"),
        ("non_negative_metrics", negatives, "no negative values"),
    ):
        names = _listed(flags)
        out.append(
            _entry(check, names == "", F.when(names == "", fine).otherwise(names))
        )
    for check, column, counter, what in (
        ("team_id_values", "team_id", "bad_team", "rows with another team_id"),
        ("queue_is_ranked_solo", "queue_id", "bad_queue", "rows of other queues"),
        ("kda_finite", "kda", "bad_kda", "rows without a finite kda"),
    ):
        out.append(
            _zero(check, F.col(counter), what) if column in has else _skipped(check, [column])
        )
    if "team_position" in has:
        share = F.try_divide(F.col("undefined").cast("double"), total.cast("double"))
        passed = (F.col("unexpected") == 0) & (share <= rules.undefined_share)
        detail = F.when(
            F.col("unexpected") > 0,
            F.concat(F.col("unexpected").cast("string"), F.lit(" rows with unexpected roles")),
        ).otherwise(F.concat(F.lit("undefined share "), F.round(share, 4).cast("string")))
        out.append(_entry("team_position_values", passed, detail, WARN))
    else:
        out.append(_skipped("team_position_values", ["team_position"], WARN))
    if absent:
        return _rows(stats, [*out, _skipped("win_balance", absent)])
    return stats.select(F.inline(F.concat(F.array(*out), F.transform("rates", lambda x: _balance(x, rules)))))


def _balance(x: Column, rules: Rules) -> Column:
    """Is a source's mean outcome close to one half?"""
    passed = F.abs(x["rate"] - 0.5) <= rules.win_tolerance
    detail = F.concat(F.lit("winrate "), F.round(x["rate"], 4).cast("string"))
    return _entry(F.concat(F.lit("win_balance["), x["source"], F.lit("]")), passed, detail)


def _grouped(df: DataFrame, rules: Rules) -> DataFrame:
    """Duplicates and match sizes from one scan: keys are counted, their counts meet per match."""
    absent = [c for c in S.PARTICIPANT_KEY if c not in df.columns]
    if absent:
        one = df.sparkSession.range(1)
        return _rows(one, [_skipped("unique_participant_key", absent), _skipped("ten_participants_per_match", absent)])
    per_key = df.groupBy(*S.PARTICIPANT_KEY).agg(F.count("*").alias("copies"))
    per_match = per_key.groupBy(*S.MATCH_KEY).agg(
        F.sum("copies").alias("size"), F.sum(F.col("copies") - 1).alias("surplus")
    )
    keyed = F.col("data_source").isNotNull() & F.col("match_id").isNotNull()
    found = per_match.agg(
        F.sum("surplus").alias("surplus"), F.count_if(keyed & (F.col("size") != rules.group_size)).alias("wrong")
    )
    return _rows(
        found,
        [
            _zero("unique_participant_key", F.col("surplus"), "surplus rows"),
            _zero("ten_participants_per_match", F.col("wrong"), f"matches without {rules.group_size} rows"),
        ],
    )


def run_checks(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The quality report: ten fixed checks and one balance check per source.

    Two scans: one for all checks of single rows, one for those of keys.
    A check whose columns are absent is reported as failed and not evaluated.
    """
    return _row_level(df, rules).unionByName(_grouped(df, rules))


def has_errors(report: DataFrame, strict: bool = False) -> bool:
    """Did the gate fail? Warnings count only when strict."""
    fatal = [ERROR, WARN] if strict else [ERROR]
    return not report.filter(~F.col("passed") & F.col("severity").isin(*fatal)).isEmpty()
