import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from scrimtally import functions as C


def one(spark, expr, **cols):
    """Value of an expression over one row; columns are (value, type)."""
    df = spark.range(1).select(*[F.lit(v).cast(t).alias(n) for n, (v, t) in cols.items()] or [F.lit(1)])
    return df.select(expr).first()[0]


@pytest.mark.parametrize(
    "n, d, inf, null",
    [(6, 3, 2.0, 2.0), (6, 0, math.inf, None), (-6, 0, -math.inf, None), (0, 0, None, None), (None, 2, None, None), (2, None, None, None)],
)
def test_ratio_at_zero(spark, n, d, inf, null):
    cols = {"n": (n, "int"), "d": (d, "int")}
    assert one(spark, C.ratio("n", "d"), **cols) == inf
    assert one(spark, C.ratio("n", "d", on_zero="null"), **cols) == null


def test_ratio_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        C.ratio("a", "b", on_zero="zero")


@pytest.mark.parametrize("deaths, expected", [(0, 9.0), (1, 9.0), (3, 3.0), (None, None)])
def test_kda_clips_but_keeps_null(spark, deaths, expected):
    got = one(spark, C.kda("k", "d", "a"), k=(4, "int"), d=(deaths, "int"), a=(5, "int"))
    assert got == expected


def test_add_metrics(spark):
    cols = "kills int, deaths int, assists int, gold_earned bigint, total_damage_dealt_to_champions bigint, vision_score int, game_duration_sec bigint"
    df = spark.createDataFrame([(2, 0, 3, 600, 1200, 30, 120), (1, 1, 1, 5, 0, 0, 0)], cols)
    a, b = C.add_metrics(df).collect()
    assert (a.kda, a.game_duration_min, a.gold_per_min, a.damage_per_min, a.vision_per_min) == (5.0, 2.0, 300.0, 600.0, 15.0)
    assert b.gold_per_min == math.inf and b.damage_per_min is None
    assert "cs_per_min" not in C.add_metrics(df).columns
    with_cs = C.add_metrics(df.withColumn("total_minions_killed", F.lit(10))).first()
    assert with_cs.cs_per_min == 5.0


def test_wilson_matches_the_formula_and_brackets_the_rate(spark):
    for wins, n in ((0, 5), (5, 5), (53, 100), (1, 1000)):
        p, z = wins / n, 1.96
        half = z * math.sqrt((p * (1 - p) + z * z / (4 * n)) / n)
        low, high = ((p + z * z / (2 * n) + s * half) / (1 + z * z / n) for s in (-1, 1))
        got = [one(spark, b, p=(p, "double"), n=(n, "bigint")) for b in C.wilson_bounds("p", "n")]
        assert got == pytest.approx([low, high], abs=1e-12)
        assert got[0] <= p + 1e-12 and p <= got[1] + 1e-12


def test_wilson_edge_cases(spark):
    low, _ = C.wilson_bounds("p", "n")
    assert math.isnan(one(spark, low, p=(3.0, "double"), n=(2, "int")))  # more wins than games
    assert one(spark, low, p=(0.5, "double"), n=(0, "int")) is None


@pytest.mark.parametrize("low, high, text", [(0.51, 0.6, "strong"), (0.4, 0.49, "weak"), (0.5, 0.6, "normal"), (None, None, "normal")])
def test_verdict(spark, low, high, text):
    got = one(spark, C.verdict("low", "high", C.EN), low=(low, "double"), high=(high, "double"))
    assert got == text


@pytest.mark.parametrize("minutes, bucket", [(24.99, 0), (25.0, 1), (31.99, 1), (32.0, 2), (None, 2)])
def test_duration_bucket(spark, minutes, bucket):
    assert one(spark, C.duration_bucket("m"), m=(minutes, "double")) == C.RU.buckets[bucket]


@pytest.mark.parametrize(
    "version, patch, prefix",
    [("16.11.782.9", "16.11", "16.11"), ("16", "16.", None), ("", ".", None), (None, None, None), ("x.y", "x.y", None)],
)
def test_patches(spark, version, patch, prefix):
    assert one(spark, C.patch_of("v"), v=(version, "string")) == patch
    assert one(spark, C.patch_prefix("v"), v=(version, "string")) == prefix


def test_patch_order_is_numeric(spark):
    df = spark.createDataFrame([("16.10",), ("16.7",), ("16.",), ("15.24",)], "p string")
    # a patch without a second number comes before the numbered ones
    assert [r.p for r in df.orderBy(C.patch_sort_key("p")).collect()] == ["15.24", "16.", "16.7", "16.10"]


@pytest.mark.parametrize(
    "role, other, simple, fallback",
    [("TOP", None, "TOP", "TOP"), ("", "MIDDLE", "UNDEFINED", "UNDEFINED"), ("Invalid", None, "UNDEFINED", "UNDEFINED"),
     (None, "JUNGLE", "UNDEFINED", "JUNGLE"), (None, "Invalid", "UNDEFINED", "UNDEFINED"), (None, None, "UNDEFINED", "UNDEFINED")],
)
def test_clean_role(spark, role, other, simple, fallback):
    cols = {"r": (role, "string"), "o": (other, "string")}
    assert one(spark, C.clean_role("r"), **cols) == simple
    assert one(spark, C.clean_role("r", "o"), **cols) == fallback


def test_role_names_and_results(spark):
    assert one(spark, C.role_name("r"), r=("JUNGLE", "string")) == "Лес"
    assert one(spark, C.role_name("r"), r=(None, "string")) == "Не определена"
    assert one(spark, C.result_label("w"), w=(None, "boolean")) == "loss"
    assert one(spark, C.result_label("w", keep_null=True), w=(None, "boolean")) is None
    assert one(spark, C.result_label("w", C.RU), w=(True, "boolean")) == "Победа"


@pytest.mark.parametrize("name, shown", [("Ann", "Ann"), ("  ", "0123456789"), (None, "0123456789"), ("", "0123456789")])
def test_display_name(spark, name, shown):
    assert one(spark, C.display_name("n", "p"), n=(name, "string"), p=("0123456789abc", "string")) == shown


@pytest.mark.parametrize(
    "value, kind, text",
    [(5.0, "double", "5"), (5.5, "double", "5.5"), (float("nan"), "double", ""), (None, "double", ""),
     (12345678901234, "bigint", "12345678901234"), ("EUW1_5", "string", "EUW1_5"), ("5.0", "string", "5.0"), (None, "string", "")],
)
def test_normalize_id(spark, value, kind, text):
    assert one(spark, C.normalize_id("v"), v=(value, kind)) == text


@pytest.mark.parametrize(
    "value, kind, number",
    [("266.0", "string", 266), ("12.7", "string", 13), (12.5, "double", 12), (266.0, "double", 266), ("x", "string", None),
     ("9007199254740993", "string", 9007199254740993), (None, "bigint", None), (7, "int", 7)],
)
def test_to_long(spark, value, kind, number):
    assert one(spark, C.to_long("v"), v=(value, kind)) == number


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "text, expected",
    [("2026-05-01 10:00:00", (2026, 5, 1, 10)), ("2026-05-01", (2026, 5, 1, 0)), ("2026-05-01T10:00:00+02:00", (2026, 5, 1, 8)),
     ("2026-05-01T10:00:00Z", (2026, 5, 1, 10)), ("bad", None), (None, None)],
)
def test_to_utc_does_not_depend_on_the_session_zone(spark, zone, text, expected):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, C.to_utc("v"), v=(text, "string"))
        assert got == (dt.datetime(*expected) if expected else None)
        seconds = one(spark, C.epoch_seconds("v"), v=(text, "string"))
        want = dt.datetime(*expected, tzinfo=dt.timezone.utc).timestamp() if expected else None
        assert seconds == want
        assert one(spark, C.millis_to_utc("m"), m=(1_000, "bigint")) == dt.datetime(1970, 1, 1, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_millis_out_of_range_is_null(spark):
    assert one(spark, C.millis_to_utc("m"), m=(9_223_372_036_855, "bigint")) is None


def test_load_stamp(spark):
    assert one(spark, C.load_stamp("x")) == "x"
    stamp = dt.datetime.fromisoformat(one(spark, C.load_stamp()))
    assert stamp.utcoffset() == dt.timedelta(0)
    assert abs((dt.datetime.now(dt.timezone.utc) - stamp).total_seconds()) < 60


def test_null_outcome_is_a_loss_in_double_precision(spark):
    df = spark.createDataFrame([(True,), (True,), (None,)], "w boolean")
    assert df.agg(C.share_of_wins("w")).first()[0] == 2 / 3


def test_ids_from_doubles_are_exact(spark):
    from scrimtally.functions import normalize_id

    values = [10000000.5, 1e20, 1e23, -1e20, float("inf"), float("-inf"), float("nan"), None, 0.0, -7.0, 2.0**63, 2.0**100 + 2.0**60,
              0.0001, 0.00015, 1e-5, 1.5e-7, -2.5e-300, 123456789012345.67, -0.5, 4503599627370495.5, 1e15 + 0.125]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = [r.t for r in df.select("i", normalize_id("x").alias("t")).orderBy("i").collect()]
    plain = lambda x: "" if x is None or x != x else str(int(x)) if float(x).is_integer() else str(x)
    assert got == [plain(x) for x in values]
