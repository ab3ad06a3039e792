"""Pure Column functions. No Python UDFs: everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import RU, Labels

Z_95 = 1.96
INVALID_ROLES = ("", "Invalid")
UNDEFINED_ROLE = "UNDEFINED"
# Milliseconds that still fit a 64-bit nanosecond clock; other values are no dates.
MAX_EPOCH_MILLIS = 9_223_372_036_854


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, on_zero: str = "inf") -> Column:
    """``num / den`` in double, without ANSI errors.

    ``x / 0`` is an infinity with the sign of ``x`` and ``0 / 0`` is null;
    ``on_zero="null"`` gives null for every zero denominator.
    """
    if on_zero not in ("inf", "null"):
        raise ValueError(f"on_zero must be 'inf' or 'null', got {on_zero!r}")
    n, d = _col(num).cast("double"), _col(den).cast("double")
    safe = F.try_divide(n, d)
    if on_zero == "null":
        return safe
    infinite = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
    return F.when(d == 0, infinite).otherwise(safe)


def kda(kills: Column | str, deaths: Column | str, assists: Column | str) -> Column:
    """(kills + assists) / max(deaths, 1); null if any input is null.

    ``greatest`` would skip a null ``deaths``, so the lower clip is a CASE.
    """
    d = _col(deaths)
    clipped = F.when(d < 1, F.lit(1)).otherwise(d)
    return ratio(_col(kills) + _col(assists), clipped, on_zero="null")


def per_minute(amount: Column | str, minutes: Column | str) -> Column:
    return ratio(amount, minutes)


def add_metrics(df: DataFrame) -> DataFrame:
    """Add the derived measures; ``cs_per_min`` only if minions are present.

    Minutes are their own step: the measures then refer to the column, and the
    generated code stays in pieces small enough for the JIT compiler.
    """
    timed = df.withColumn("game_duration_min", ratio("game_duration_sec", F.lit(60), "null"))
    amounts = {
        "damage_per_min": "total_damage_dealt_to_champions",
        "gold_per_min": "gold_earned",
        "vision_per_min": "vision_score",
        "cs_per_min": "total_minions_killed",
    }
    return timed.withColumns(
        {"kda": kda("kills", "deaths", "assists")}
        | {
            name: per_minute(amount, "game_duration_min")
            for name, amount in amounts.items()
            if amount != "total_minions_killed" or amount in df.columns
        }
    )


def share_of_wins(win: Column | str) -> Column:
    """Aggregate: share of won rows; a null outcome counts as a loss."""
    return F.avg(F.when(_col(win), F.lit(1.0)).otherwise(F.lit(0.0)))


def count_wins(win: Column | str) -> Column:
    """Aggregate: number of won rows, 0 if there are none."""
    return F.sum(F.when(_col(win), F.lit(1)).otherwise(F.lit(0)))


def wilson_bounds(
    rate: Column | str, n: Column | str, z: float = Z_95
) -> tuple[Column, Column]:
    """Lower and upper bound of the Wilson score interval of a share ``rate`` over ``n`` trials."""
    p, trials = _col(rate).cast("double"), _col(n).cast("double")
    z2 = F.lit(z * z)
    centre = p + F.try_divide(z2, trials * 2.0)
    spread = F.lit(z) * F.sqrt(
        F.try_divide(p * (F.lit(1.0) - p) + F.try_divide(z2, trials * 4.0), trials)
    )
    scale = F.lit(1.0) + F.try_divide(z2, trials)
    return (centre - spread) / scale, (centre + spread) / scale


def verdict(low: Column | str, high: Column | str, labels: Labels = RU) -> Column:
    """Does the interval lie above, below or across one half?"""
    return (
        F.when(_col(low) > 0.5, labels.strong)
        .when(_col(high) < 0.5, labels.weak)
        .otherwise(labels.normal)
    )


def duration_bucket(minutes: Column | str, labels: Labels = RU) -> Column:
    """Short below 25 minutes, medium below 32, long otherwise (also for null)."""
    m = _col(minutes)
    short, medium, long_ = labels.buckets
    return F.when(m < 25, short).when(m < 32, medium).otherwise(long_)


def patch_of(version: Column | str) -> Column:
    """First two dotted parts; ``16`` gives ``16.`` and an empty version gives ``.``."""
    v = _col(version)
    dot = F.lit(".")
    return F.concat(F.split_part(v, dot, F.lit(1)), dot, F.split_part(v, dot, F.lit(2)))


def patch_prefix(version: Column | str) -> Column:
    """Leading ``digits.digits`` of a version, null if it has none."""
    return F.nullif(F.regexp_extract(_col(version), r"^(\d+\.\d+)", 1), F.lit(""))


def patch_sort_key(patch: Column | str) -> Column:
    """Numeric order of patches, so that 16.7 comes before 16.10."""
    return F.split(_col(patch), r"\.").try_cast("array<int>")


def clean_role(position: Column | str, fallback: Column | str | None = None) -> Column:
    """Empty, ``Invalid`` and missing positions become ``UNDEFINED``."""
    p = _col(position)
    if fallback is not None:
        p = F.coalesce(p, _col(fallback))
    return F.when(p.isNull() | p.isin(*INVALID_ROLES), UNDEFINED_ROLE).otherwise(p)


def role_name(role: Column | str, labels: Labels = RU) -> Column:
    r = _col(role)
    named = None
    for key, text in labels.roles.items():
        named = F.when(r == key, text) if named is None else named.when(r == key, text)
    return named.otherwise(labels.role_default)


def result_label(
    win: Column | str, labels: Labels | None = None, keep_null: bool = False
) -> Column:
    """Text for an outcome; a null outcome reads as a loss unless ``keep_null``."""
    w = _col(win)
    won, lost = (labels.win, labels.loss) if labels else ("win", "loss")
    text = F.when(w, won).otherwise(lost)
    return F.when(w.isNotNull(), text) if keep_null else text


def display_name(name: Column | str, puuid: Column | str) -> Column:
    """A non-blank name, else the first ten characters of the player id."""
    n = _col(name)
    return F.when(F.trim(n) != "", n).otherwise(F.substring(_col(puuid), 1, 10))


def float_text(value: Column | str) -> Column:
    """A double as text: exact digits without an exponent if it is integral, else its shortest plain form.

    ``1e20`` is ``100000000000000000000``, ``10000000.5`` stays, below one
    ten-thousandth an exponent of two digits follows (``1.5e-07``), infinities are
    ``inf`` and ``-inf``, NaN is null. Integral values from 2^126 up keep the
    engine's own form.
    """
    d = _col(value).cast("double")
    size, raw = F.abs(d), d.cast("string")
    # above 64 bits: two halves, each exact, meet as decimals
    unit = F.lit(float(2**63))
    high = F.floor(size / unit)
    low = size - high.cast("double") * unit
    wide = high.cast("decimal(19,0)") * F.lit(str(2**63)).cast("decimal(19,0)") + low.try_cast("bigint").cast("decimal(19,0)")
    sign = F.when(d < 0, F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_replace(F.split_part(raw, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.abs(F.split_part(raw, F.lit("E"), F.lit(2)).try_cast("int")).cast("string")
    small = F.concat(mantissa, F.lit("e-"), F.when(F.length(power) < 2, F.lit("0")).otherwise(F.lit("")), power)
    plain = F.regexp_replace(raw.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    return (
        F.when(F.isnan(d), F.lit(None).cast("string"))
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when((d == F.floor(d)) & (size < float(2**63)), d.try_cast("bigint").cast("string"))
        .when((size >= float(2**63)) & (size < float(2**126)), F.concat(sign, wide.cast("string")))
        .when(size >= float(2**126), raw)
        .when(size < 1e-4, small)
        .otherwise(plain)
    )


def normalize_id(value: Column | str) -> Column:
    """Identifiers as text: integral floats lose the ``.0``, missing becomes empty.

    ``typeof`` is a constant of the plan, so only the branch for the column's
    own type is left after constant folding.
    """
    v = _col(value)
    floating = F.typeof(v).isin("double", "float")
    text = F.when(floating, float_text(v.try_cast("double"))).otherwise(v.cast("string"))
    return F.coalesce(text, F.lit(""))


def to_long(value: Column | str) -> Column:
    """64-bit integer or null. Fractions round; integral floats in text are accepted."""
    v = _col(value)
    kind, number = F.typeof(v), v.try_cast("double")
    # the type tests are constants of the plan: one branch is left
    return (
        F.when(kind.isin("bigint", "int", "smallint", "tinyint"), v.try_cast("bigint"))
        .when(kind.isin("double", "float"), F.rint(number).try_cast("bigint"))
        .otherwise(F.coalesce(v.try_cast("bigint"), F.round(number).try_cast("bigint")))
    )


def _instant_to_utc(instant: Column) -> Column:
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")
    )


def to_utc(value: Column | str) -> Column:
    """Text or timestamp to a zone-less UTC timestamp; unreadable text becomes null.

    Text without a zone is taken as UTC whatever the session time zone is.
    """
    v = _col(value)
    text = v.cast("string")
    zoned = text.rlike(r"\d{2}:\d{2}.*([Zz]|[+-]\d{2}(:?\d{2})?)$")
    kind = F.typeof(v)
    return (
        F.when(kind == "timestamp_ntz", v.try_cast("timestamp_ntz"))
        .when(kind == "timestamp", _instant_to_utc(v.try_cast("timestamp")))
        .when(zoned, _instant_to_utc(text.try_cast("timestamp")))
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def millis_to_utc(millis: Column | str) -> Column:
    """Epoch milliseconds to a zone-less UTC timestamp; out of range becomes null."""
    ms = to_long(millis)
    valid = F.when(ms.between(-MAX_EPOCH_MILLIS, MAX_EPOCH_MILLIS), ms)
    return _instant_to_utc(F.timestamp_millis(valid))


def epoch_seconds(value: Column | str) -> Column:
    """ISO text (no zone means UTC) to epoch seconds; empty or missing gives null."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, to_utc(value))


def load_stamp(at: str | None = None) -> Column:
    """UTC load time to the second as ISO text; pass ``at`` for repeatable runs."""
    if at is not None:
        return F.lit(at)
    return F.date_format(
        _instant_to_utc(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    )
