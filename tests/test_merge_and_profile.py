import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scrimtally.operators import aggregates as A
from scrimtally.operators import profile as P
from scrimtally.operators import upsert as U

COLS = "k string, seq int, v string"


def test_first_load_keeps_first_and_later_loads_keep_last(spark, rows):
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 2, "o")], COLS)
    first = U.upsert(None, new, ["k"], ["seq"])
    assert {r.k: r.v for r in first.collect()} == {"a": "x", None: "n"}
    empty = spark.createDataFrame([], COLS)
    assert {r.k: r.v for r in U.upsert(empty, new, ["k"], ["seq"]).collect()} == {"a": "x", None: "n"}
    existing = spark.createDataFrame([("a", 9, "old"), ("b", 9, "kept")], COLS)
    merged = U.upsert(existing, new, ["k"], ["seq"])
    assert {r.k: r.v for r in merged.collect()} == {"a": "y", "b": "kept", None: "o"}
    again = U.upsert(merged, new, ["k"], ["seq"])
    assert rows(again) == rows(merged)


def test_upsert_cuts_hot_keys_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("seq"), F.lit("v").alias("v")).write.parquet(f"{tmp_path}/t")
    df = U.keep_last(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["seq"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert df.first().seq == 999


def test_unseen_ids(spark, rows):
    found = spark.createDataFrame([("1", "p"), ("1", "q"), ("2", "p"), ("3", "p"), (None, "p")], "match_id string, by string")
    log = spark.createDataFrame([("1", "match_detail_error"), ("2", "success"), (None, "success")], "match_id string, status string")
    assert {(r.match_id, r.by) for r in U.unseen_ids(found, log).collect()} == {("1", "p"), ("3", "p"), (None, "p")}
    assert U.unseen_ids(found.select("match_id"), log).count() == 3
    nameless = spark.createDataFrame([(None, "p"), (None, "q"), (None, "q"), ("x", "p")], "match_id string, by string")
    assert U.unseen_ids(nameless, log).count() == 4
    assert [r[0] for r in U.distinct_ids(found).collect()] == ["1", "2", "3", None]


def expected(values):
    v = np.array([x for x in values if x is not None and not math.isnan(x)], dtype=float)
    if not len(v):
        return [None] * 3
    return [float(np.percentile(v, p)) for p in (25, 50, 75)]


def described(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    return P.describe(df, ["x"]).first()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e9, 1e9), st.sampled_from([0.0, 1.5, float("nan")])), min_size=1, max_size=40))
def test_quantiles_are_exact(spark, values):
    row = described(spark, values)
    for got, want in zip((row.p25, row.p50, row.p75), expected(values)):
        assert got == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_quantiles_with_a_hot_value_and_wide_ranges(spark):
    rng = random.Random(0)
    values = [7.0] * 4000 + [rng.expovariate(1e-3) for _ in range(5000)] + [1e300, -1e300, 5e-324, 1e-300] + [None] * 10
    row = described(spark, values)
    assert [row.p25, row.p50, row.p75] == pytest.approx(expected(values))
    assert row["count"] == 9004 and row.min == -1e300 and row.max == 1e300


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    row = described(spark, [inf, inf, 1.0, 2.0, -inf])
    assert (row.p25, row.p50, row.p75, row.min, row.max) == (1.0, 2.0, inf, -inf, inf)


def test_describe_of_several_columns(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "a int, b double")
    a, b = P.describe(df, ["a", "b"]).collect()
    assert (a.metric, a["count"], a["mean"], a["std"], a.p50) == ("a", 3, 2.0, 1.0, 2.0)
    assert (b["count"], b.p25, b.p75) == (2, 12.5, 17.5)
    none = P.describe(df.filter("a > 5"), ["a"]).first()
    assert none["count"] == 0 and none.p50 is None and none["mean"] is None


@pytest.mark.parametrize("kind", ["wide", "ties", "normal", "infinite"])
def test_quantiles_through_brackets(spark, monkeypatch, kind):
    """Small limits send a small table through all three passes."""
    monkeypatch.setattr(P, "SMALL", 10)
    monkeypatch.setattr(P, "LARGE", 100)
    monkeypatch.setattr(P, "ACCURACY", 200)
    monkeypatch.setattr(P, "GRID", 20)
    draw = random.Random(kind)
    one = {
        "wide": lambda: draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 299),
        "ties": lambda: float(draw.choice([0, 0, 0, 1, 2, 2])),
        "normal": lambda: draw.gauss(0, 1),
        "infinite": lambda: draw.choice([float("inf"), float("-inf"), draw.random()]),
    }[kind]
    data = [one() for _ in range(4001)]
    df = spark.createDataFrame([(x, -x) for x in data], "x double, y double").repartition(5)
    probs = (0.0, 0.1, 0.5, 0.999, 1.0)
    for row, values in zip(P.describe(df, ["x", "y"], probs).collect(), (sorted(data), sorted(-x for x in data)), strict=True):
        assert [row[f"p{round(100 * p)}"] for p in probs[:3]] == [values[round(4000 * p)] for p in probs[:3]]
        assert row["max"] == values[-1] and row["min"] == values[0]


def test_describe_runs_a_fixed_number_of_jobs_over_the_table(spark, tmp_path):
    values = [10.0 ** (i % 600 - 300) * (i + 1) for i in range(30_000)]
    spark.createDataFrame([(x,) for x in values], "x double").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    row = P.describe(df, ["x"]).first()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before)
    exact = sorted(values)
    k = 29_999 * 0.25
    low, high = exact[int(k)], exact[int(k) + 1]
    assert row.p25 == low + (high - low) * (k - int(k))
    assert jobs <= 10


def test_unseen_ids_keep_every_null_id_of_a_lone_column(spark, rows):
    found = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "match_id string")
    log = spark.createDataFrame([("b", "success"), (None, "success")], "match_id string, status string")
    assert rows(U.unseen_ids(found, log)) == [(None,), (None,), ("a",)]


def test_profiles(spark, rows):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), (None, None)], "s string, d double")
    assert [tuple(r) for r in P.value_counts(df, "s").collect()] == [("x", 2)]
    assert [tuple(r) for r in P.value_counts(df, "s", dropna=False).collect()] == [("x", 2), (None, 1)]
    assert [tuple(r) for r in P.null_counts(df).collect()] == [("d", 2), ("s", 1)]
    assert [tuple(r) for r in P.table_profile(df).collect()] == [(0, "s", "string", 3, 2, 1), (1, "d", "double", 3, 2, 1)]
    assert P.distinct_counts(df, ["s"]).first().s == 1 == P.distinct_counts(df, ["s"], approximate=True).first().s


def test_pandas_and_sql_treatment_of_missing_outcomes(spark):
    cols = """data_source string, match_id string, champion_name string, win boolean, kda double, damage_per_min double,
        gold_per_min double, vision_per_min double, kills int, deaths int, assists int"""
    data = [("s", f"m{i}", "X", w, 1.0, 1.0, 1.0, 1.0, 1, 1, 1) for i, w in enumerate([True, False, None, None])]
    df = spark.createDataFrame(data, cols)
    assert A.champion_stats(df).first().winrate == 0.25
    assert A.champion_stats_single(df, 1).first().winrate == 0.5
    assert A.champion_stats_percent(df).first().winrate == 50.0
    assert A.result_stats(df).count() == 3 and A.result_stats_single(df).count() == 2


def test_sources_without_a_threshold_drop_out(spark):
    cols = "data_source string, match_id string, champion_name string, win boolean, kda double, damage_per_min double, gold_per_min double, vision_per_min double"
    data = [(s, f"m{i}", "X", True, 1.0, 1.0, 1.0, 1.0) for s in ("kaggle", "riot_api", "riot_full") for i in range(30)]
    df = spark.createDataFrame(data, cols)
    assert [r.data_source for r in A.champion_filtered(df).collect()] == ["kaggle", "riot_api"]
    assert A.champion_filtered(df, {"riot_full": 31}).count() == 0
    assert A.popular_by_source(df, 1).count() == 3
