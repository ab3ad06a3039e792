import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scrimtally import schemas as S
from scrimtally.functions import EN, RU
from scrimtally.operators import aggregates as A
from scrimtally.plans import marts, reports
from scrimtally.plans import star as T
from scrimtally.sources import read_star

COMMON = """data_source string, match_id string, participant_id bigint, champion_id bigint, champion_name string,
    puuid string, team_position string, win boolean, item0 bigint, item1 bigint, item2 bigint"""


def participants(spark, data):
    return spark.createDataFrame(data, COMMON)


def test_complete_matches_drops_other_sizes_and_null_keys(spark, rows):
    data = [("a", m, i, 1, "X", "p", "TOP", True, 0, 0, 0) for m, n in (("two", 2), ("three", 3), (None, 2)) for i in range(n)]
    data += [(None, "two", i, 1, "X", "p", "TOP", True, 0, 0, 0) for i in range(2)]
    data += [("b", "two", 0, 1, "X", "p", "TOP", True, 0, 0, 0)]
    got = A.complete_matches(participants(spark, data), 2)
    assert rows(got, "data_source", "match_id", "participant_id") == [("a", "two", 0), ("a", "two", 1)]


def test_complete_matches_with_hot_ids(spark, tmp_path):
    # many oversized ids, one of them with a third of all rows
    hot = spark.range(30_000).select(F.lit("a").alias("data_source"), F.lit("hot").alias("match_id"))
    big = spark.range(150 * 20).select(F.lit("a").alias("data_source"), F.concat(F.lit("big"), (F.col("id") % 150).cast("string")).alias("match_id"))
    fine = spark.range(50_000).select(F.lit("a").alias("data_source"), F.concat(F.lit("m"), F.floor(F.col("id") / 10).cast("string")).alias("match_id"))
    hot.union(big).union(fine).write.parquet(f"{tmp_path}/rows")
    got = A.complete_matches(spark.read.parquet(f"{tmp_path}/rows"), 10)
    assert got.count() == 50_000
    assert got.filter(~F.col("match_id").startswith("m")).isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Limit" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_rows_of_other_matches_are_dropped_before_the_shuffle(spark, tmp_path):
    """Wide rows of incomplete matches made up most of what the star build shuffled."""
    few = spark.range(100).select(F.lit("a").alias("data_source"), F.concat(F.lit("m"), (F.col("id") % 10).cast("string")).alias("match_id"))
    rest = spark.range(20_000).select(F.lit("a").alias("data_source"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("match_id"))
    few.union(rest).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    kept = A.possibly_in(rows, few.distinct(), S.MATCH_KEY)
    assert kept.filter(F.col("match_id").startswith("m")).count() == 100
    assert kept.count() < 120
    assert A.possibly_in(rows, few.limit(0), S.MATCH_KEY).isEmpty()
    off = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in off:
        spark.conf.set(k, "-1")
    try:
        text = A.complete_matches(rows, 10)._jdf.queryExecution().executedPlan().toString()
        assert text.index("SortMergeJoin") < text.index("Exchange") < text.index("BroadcastHashJoin")
        assert A.complete_matches(rows, 10).count() == 100
    finally:
        for k, v in off.items():
            spark.conf.set(k, v)


def joins_in_place(df, key):
    """Of every join on ``key`` in the plan: is there no exchange below it?"""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :|+-*()0123456789"))
    found = []
    for i, line in enumerate(lines):
        if "SortMergeJoin" in line and key in line:
            below = []
            for more in lines[i + 1 :]:
                if depth(more) <= depth(line):
                    break
                below.append(more)
            found.append(not any("Exchange" in x for x in below))
    return found


def test_fact_bridge_and_matches_join_in_place(spark, tmp_path, rows):
    from registry import order_matches as M
    from registry.star import champions, items

    sf = "/root/testdata/sf0.001"
    folder = f"{tmp_path}/star"
    built = T.write_star(spark, M.common(spark, sf), champions(spark, sf), items(spark, sf), folder, M.GROUP_SIZE)
    again = read_star(spark, folder, S.STAR_TABLES)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        for star in (built, again):
            fact, bridge, matches = (star[n] for n in ("fact_participant", "fact_participant_item", "dim_match"))
            for df in (
                marts.item_stats(bridge, fact, star["dim_item"]),
                marts.champion_by_duration(fact, star["dim_champion"], matches),
                reports.scaling(star, "F", min_games=1),
                reports.patch_shift(star, "F", "16.3", "16.10", min_games=1),
            ):
                assert joins_in_place(df, "match_id") == [True]
                df.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name in S.STAR_TABLES:
        assert rows(built[name]) == rows(again[name].select(built[name].columns)), name
    assert T.read_complete(spark, folder).count() == built["fact_participant"].count()


def ref(spark):
    raw = spark.createDataFrame([(1, "Ref One", "t1", "Mage,Tank"), (2, "Ref Two", "t2", "")], "champion_id bigint, champion_name string, title string, tags string")
    return T.champions_ref(raw)


def test_dim_champion_keeps_spellings_unless_canonical(spark, rows):
    data = [("a", "m", i, c, n, "p", "TOP", True, 0, 0, 0) for i, (c, n) in enumerate([(1, "One"), (1, "ONE"), (2, "Two"), (9, "Nine"), (None, "None")])]
    dim = T.dim_champion(participants(spark, data), ref(spark))
    assert rows(dim) == [(1, "ONE", "t1", "Mage"), (1, "One", "t1", "Mage"), (2, "Two", "t2", ""), (9, "Nine", None, "Unknown")]
    assert rows(T.ambiguous_champions(dim)) == [(1, 2)]
    canonical = T.dim_champion(participants(spark, data), ref(spark), canonical=True)
    assert rows(canonical) == [(1, "Ref One", "t1", "Mage"), (2, "Ref Two", "t2", ""), (9, "Nine", None, "Unknown")]


def test_any_value_ignores_nulls(spark, rows):
    cols = "data_source string, match_id string, game_start_utc string, game_duration_min double, game_version string, queue_id int, source_tier string"
    df = spark.createDataFrame([("a", "m", None, 1.0, None, 420, None), ("a", "m", "t", 1.0, "v", 420, None)], cols)
    assert rows(T.dim_match(df)) == [("a", "m", "t", 1.0, "v", 420, None)]


def test_bridge_drops_empty_slots_and_keeps_repeats(spark, rows):
    data = [("a", "m", 1, 1, "X", "p", "TOP", True, 7, 7, 0), ("a", "m", 2, 1, "X", "p", "TOP", True, None, 8, 0)]
    bridge = T.fact_participant_item(participants(spark, data), ["item0", "item1", "item2"])
    assert rows(bridge) == [("a", "m", 1, 7), ("a", "m", 1, 7), ("a", "m", 2, 8)]


def test_dim_role_texts(spark, rows):
    data = [("a", "m", i, 1, "X", "p", r, True, 0, 0, 0) for i, r in enumerate(["TOP", "TOP", "UNDEFINED", None])]
    assert rows(T.dim_role(participants(spark, data), EN)) == [(None, "Undefined"), ("TOP", "Top"), ("UNDEFINED", "Undefined")]


@pytest.mark.parametrize("seed", range(3))
def test_item_stats_equals_the_row_by_row_join(spark, seed):
    """Keys repeat on purpose: the counted form must give the totals of the plain join."""
    rng = random.Random(seed)
    fact = [(rng.choice("ab"), f"m{rng.randrange(4)}", rng.choice([1, 2, None]), rng.choice([True, False, None])) for _ in range(60)]
    bridge = [(rng.choice("ab"), f"m{rng.randrange(4)}", rng.choice([1, 2, None]), rng.randrange(1, 5)) for _ in range(80)]
    count, won = Counter(), defaultdict(int)
    for s, m, p, item in bridge:
        for fs, fm, fp, win in fact:
            if p is not None and (s, m, p) == (fs, fm, fp):
                count[(s, item)] += 1
                won[(s, item)] += bool(win)
    expected = {k: (n, won[k] / n) for k, n in count.items() if n >= 10}
    key = "data_source string, match_id string, participant_id bigint"
    items = spark.createDataFrame([(1, "one", 100), (2, "two", None)], "item_id bigint, item_name string, gold_total bigint")
    got = marts.item_stats(
        spark.createDataFrame(bridge, f"{key}, item_id bigint"), spark.createDataFrame(fact, f"{key}, win boolean"), items
    ).collect()
    assert {(r.data_source, r.item_id): (r.purchases, pytest.approx(r.winrate)) for r in got} == expected
    names = {r.item_id: r.item_name for r in got}
    assert all(names[i] == {1: "one", 2: "two"}.get(i, str(i)) for i in names)
    assert all(r.wilson_low <= r.winrate for r in got)


FACT = "data_source string, match_id string, champion_id bigint, role_key string, win boolean, kda double"


def champion_tables(spark):
    data = [("a", f"m{i}", 1, "TOP" if i % 2 else "JUNGLE", i % 10 != 0, 1.0 * i) for i in range(40)]
    data += [("a", f"m{i}", 2, "TOP", i % 10 == 0, None) for i in range(40)]
    data += [("a", f"m{i}", 3, "TOP", i % 2 == 0, 2.0) for i in range(4)]
    dim = spark.createDataFrame(
        [(1, "One", "Mage"), (1, "ONE", "Mage"), (2, "Two", "Tank"), (3, "Three", "Tank")],
        "champion_id bigint, champion_name string, primary_class string",
    )
    return {"fact_participant": spark.createDataFrame(data, FACT), "dim_champion": dim}


def test_champion_strength(spark):
    t = champion_tables(spark)
    got = {r.champion_name: r for r in marts.champion_strength(t["fact_participant"], t["dim_champion"]).collect()}
    assert set(got) == {"One", "ONE", "Two"}  # the third has too few games; two spellings repeat the facts
    assert (got["One"].games, got["One"].wins, got["One"].verdict) == (40, 36, RU.strong)
    assert got["ONE"].wins == 36 and got["Two"].verdict == RU.weak
    assert all(r.wilson_low <= r.winrate <= r.wilson_high for r in got.values())


def test_ranking_agrees_with_the_mart_and_filters_positions(spark):
    t = champion_tables(spark)
    mart = {r.champion_name: r.wilson_low for r in marts.champion_strength(t["fact_participant"], t["dim_champion"]).collect()}
    ranking = reports.champion_ranking(t, "a", min_games=5)
    assert {r.champion_name: r.wilson_low for r in ranking.collect()} == mart
    assert [r.champion_name for r in ranking.collect()] == ["ONE", "One", "Two"]
    assert [r.champion_name for r in reports.strongest(ranking).collect()] == ["ONE", "One"]
    assert reports.anomalies(ranking).count() == 3
    top = reports.champion_ranking(t, "a", "TOP", 5, "raw").collect()
    assert {r.champion_name: r.games for r in top} == {"One": 20, "ONE": 20, "Two": 40}
    with pytest.raises(KeyError):
        reports.champion_ranking(t, "a", rank_by="luck")


def test_games_are_distinct_matches(spark):
    fact = spark.createDataFrame([("a", "m", 1, "TOP", True, 1.0)] * 3, FACT)
    dim = spark.createDataFrame([(1, "One", "Mage")], "champion_id bigint, champion_name string, primary_class string")
    row = marts.champion_strength(fact, dim, min_games=1).first()
    assert (row.games, row.wins, row.winrate) == (1, 3, 3.0)


def duration_tables(spark, data):
    """(champion, minutes, version, win) per match, one participant each."""
    fact = [("a", f"m{i}", c, "TOP", w, 1.0) for i, (c, _, _, w) in enumerate(data)]
    match = [("a", f"m{i}", m, v) for i, (_, m, v, _) in enumerate(data)]
    names = sorted({d[0] for d in data})
    return {
        "fact_participant": spark.createDataFrame(fact, FACT),
        "dim_match": spark.createDataFrame(match, "data_source string, match_id string, game_duration_min double, game_version string"),
        "dim_champion": spark.createDataFrame([(n, f"C{n}", "Mage") for n in names], "champion_id bigint, champion_name string, primary_class string"),
    }


def test_scaling_and_duration_mart_agree(spark, rows):
    rng = random.Random(1)
    data = [(rng.randrange(3), rng.choice([20.0, 28.0, 35.0, None]), "16.1.1", rng.random() < 0.5) for _ in range(400)]
    t = duration_tables(spark, data)
    mart = marts.champion_by_duration(t["fact_participant"], t["dim_champion"], t["dim_match"])
    t["champion_by_duration"] = mart
    rate = {(r.champion_name, r.duration_bucket[0]): (r.games, r.winrate) for r in mart.collect()}
    got = reports.scaling(t, "a", 15).collect()
    assert len(got) == 3 and [r.delta for r in got] == sorted((r.delta for r in got), reverse=True)
    for r in got:
        assert (r.g_short, r.wr_short) == rate[(r.champion_name, "1")]
        assert (r.g_long, r.wr_long) == rate[(r.champion_name, "3")]
        assert r.delta == pytest.approx(r.wr_long - r.wr_short)
    best = reports.best_scaler(t, "a", 15).first()
    assert (best.champion_name, best.delta) == (got[0].champion_name, pytest.approx(got[0].delta))
    ends = reports.best_and_worst(reports.scaling(t, "a", 15)).first()
    assert (ends.best_name, ends.worst_name) == (got[0].champion_name, got[-1].champion_name)
    # fewer than 2k rows: both ends list the same rows
    assert reports.extremes(reports.scaling(t, "a", 15)).count() == 6
    assert reports.scaling(t, "a", 10_000).count() == 0


def test_patches(spark):
    versions = ["16.10.1"] * 3 + ["16.9.1"] * 3 + ["16.7"] * 2 + [""] * 5 + [None] * 5
    t = duration_tables(spark, [(1, 20.0, v, i % 2 == 0) for i, v in enumerate(versions)])
    assert [(r.patch, r.matches) for r in reports.patches(t, "a", 2).collect()] == [("16.7", 2), ("16.9", 3), ("16.10", 3)]
    assert reports.latest_patches(t, "a", 3) == ("16.9", "16.10")
    assert reports.latest_patches(t, "a", 4) is None and reports.latest_patch_shift(t, "a", 4) is None
    row = reports.latest_patch_shift(t, "a", 3, 3).first()
    assert (row.g_a, row.g_b, row.wr_a, row.wr_b) == (3, 3, pytest.approx(1 / 3), pytest.approx(2 / 3))
    assert row.delta == pytest.approx(1 / 3)


def test_integrity(spark):
    t = duration_tables(spark, [(1, 20.0, "1", True)] * 3)
    assert T.integrity(t["fact_participant"], t["dim_match"], 1).first().ok
    assert not T.integrity(t["fact_participant"], t["dim_match"], 2).first().ok
