import json
import re
from datetime import date

from pyspark.sql import functions as F

from registry import ingest as I
from scrimtally import schemas as S
from scrimtally.operators import flatten as D
from scrimtally.operators import normalize as N


def match(mid, n=2, queue=420, **info):
    people = [
        {"participantId": i + 1, "puuid": f"p{i}", "championId": 10 + i, "championName": f"C{i}", "teamId": 100,
         "win": i % 2 == 0, "teamPosition": ["TOP", "", "Invalid", None][i % 4], "kills": 4, "deaths": 0, "assists": 2,
         "goldEarned": 600, "totalDamageDealtToChampions": 1200, "visionScore": 10, "totalMinionsKilled": 20,
         "challenges": [{"kda": 6.0, "killParticipation": 0.5}, None][i % 2], "item0": 0, "item1": 3001}
        for i in range(n)
    ]
    if n > 2:
        del people[2]["challenges"]
    body = {"gameDuration": 120, "gameStartTimestamp": 1000, "queueId": queue, "gameVersion": "16.7.1", "participants": people}
    return json.dumps({"metadata": {"matchId": mid}, "info": {**body, **info}})


def raw(spark, *texts):
    return spark.createDataFrame([(f"m{i}", t) for i, t in enumerate(texts)], S.RAW_MATCHES)


def test_flatten_gives_one_row_per_participant(spark, rows):
    df = D.flatten_matches(raw(spark, match("a", 4)), source_tier="master", stamp="t")
    assert len(df.columns) == 59
    assert rows(df, "match_id", "participant_id", "kda_challenge", "team_position", "game_duration_sec", "source_tier") == [
        ("a", 1, 6.0, "TOP", 120, "master"), ("a", 2, None, "", 120, "master"),
        ("a", 3, None, "Invalid", 120, "master"), ("a", 4, None, None, 120, "master"),
    ]


def test_bad_documents_are_counted_and_skipped(spark, rows):
    mistyped = match("b").replace('"kills": 4', '"kills": "many"')
    docs = raw(spark, match("a"), mistyped, "{bad", "", None, "[1]")
    counts = D.document_status_counts(docs, "_raw_json", S.MATCH_DOCUMENT)
    assert rows(counts) == [("malformed", 3), ("mistyped", 2), ("ok", 1)]
    flat = D.flatten_matches(docs, stamp="t")
    # the mistyped value is lost, the rest of its document stays
    assert rows(flat, "match_id", "participant_id", "kills", "gold_earned") == [
        ("a", 1, 4, 600), ("a", 2, 4, 600), ("b", 1, None, 600), ("b", 2, None, 600),
    ]


def test_only_whole_documents_are_read(spark, rows):
    one = match("a", 1)
    broken = [one + " junk", one + one, one + "," + one, one.replace('"', "'"), one + "]", "// x\n" + one, one + '],"docs":[1']
    docs = raw(spark, *broken, f"\n {one}\t")
    counts = D.document_status_counts(docs, "_raw_json", S.MATCH_DOCUMENT)
    assert rows(counts) == [("malformed", len(broken)), ("ok", 1)]
    assert rows(D.flatten_matches(docs), "match_id", "participant_id") == [("a", 1)]


def test_numbers_survive_in_any_spelling(spark, rows):
    for spelled in ("3.0", '"3"', '"3.0"', "3e0", "3"):
        docs = raw(spark, match("a", 1, mapId=0).replace('"mapId": 0', f'"mapId": {spelled}').replace('"kills": 4', f'"kills": {spelled}'))
        assert rows(D.flatten_matches(docs), "map_id", "kills") == [(3, 3)], spelled
        assert rows(D.document_status_counts(docs, "_raw_json", S.MATCH_DOCUMENT)) == [("ok", 1)]
    docs = raw(spark, match("a", 1).replace('"kills": 4', '"kills": 99999999999'), match("b", 1).replace('"win": true', '"win": "so"'), '{"info": 5}')
    assert rows(D.flatten_matches(docs), "match_id", "kills", "win") == [("a", None, True), ("b", 4, None)]
    assert rows(D.document_status_counts(docs, "_raw_json", S.MATCH_DOCUMENT)) == [("mistyped", 3)]


def test_documents_without_participants_give_no_rows(spark):
    docs = raw(spark, '{"metadata": {"matchId": "x"}}', '{"info": {"participants": []}}')
    assert D.flatten_matches(docs).count() == 0


def test_source_puuid_may_come_from_the_raw_table(spark, rows):
    docs = raw(spark, match("a", 1)).withColumn("found_by", F.lit("q"))
    df = D.flatten_matches(docs, source_puuid=F.col("found_by"), source_tier=F.upper("found_by"))
    assert rows(df, "source_puuid", "source_tier") == [("q", "Q")]


def test_json_is_parsed_once(spark):
    docs = raw(spark, match("a"))
    plan = N.normalize_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_read_documents_are_not_parsed_again_for_their_status(spark):
    counts = D.document_status_counts(raw(spark, match("a"), "{bad"), "_raw_json", S.MATCH_DOCUMENT)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    # what the second form reads is null unless the first one refused
    inputs = re.findall(r"from_json\(ArrayType\(StringType,true\), (?:\([^)]*\), )*(CASE WHEN NOT|concat)", plan)
    assert inputs and set(inputs) == {"CASE WHEN NOT"}


def test_malformed_texts_are_told_without_their_status(spark):
    one = match("a", 1)
    texts = [one, one + " junk", one.replace('"kills": 4', '"kills": "many"'), "{bad", "", None, "[1]", "null", "3", one.replace('"', "'")]
    parsed = D.parse_documents(raw(spark, *texts), "_raw_json", S.MATCH_DOCUMENT)
    assert [r.doc_malformed == (r.doc_status == D.STATUS_MALFORMED) for r in parsed.collect()] == [True] * len(texts)
    # the types of all values are looked at for the status alone
    plans = [parsed.select(c)._jdf.queryExecution().optimizedPlan().toString() for c in ("doc_status", "doc_malformed")]
    assert ["exists(" in p for p in plans] == [True, False]


def test_documents_are_made_in_several_tasks_a_core(spark, tmp_path):
    n = 400
    lines = [(i % 90, i % 50, i % 7, i, float(i % 50)) for i in range(n)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    orders = [(i, i % 11, date(2020, 1 + i % 12, 1)) for i in range(90)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    plain, spread = (I.match_documents(spark, str(tmp_path), spread=s) for s in (False, True))
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect())) and spread.count() == n
    tasks = [df.select(F.spark_partition_id()).distinct().count() for df in (plain, spread)]
    assert tasks[0] < 2 * spark.sparkContext.defaultParallelism < tasks[1]


def test_normalize_documents(spark, rows):
    docs = raw(spark, match("a", 4), match("b", 2, queue=450), match("c", 1, gameDuration=0))
    df = N.normalize_documents(docs)
    assert df.columns == S.COMMON.fieldNames() and len(df.columns) == 51
    got = rows(df, "match_id", "participant_id", "team_position", "kda", "gold_per_min", "cs_per_min", "data_source")
    assert got == [
        ("a", 1, "TOP", 6.0, 300.0, 10.0, "riot_full"), ("a", 2, "UNDEFINED", 6.0, 300.0, 10.0, "riot_full"),
        ("a", 3, "UNDEFINED", 6.0, 300.0, 10.0, "riot_full"), ("a", 4, "UNDEFINED", 6.0, 300.0, 10.0, "riot_full"),
        ("c", 1, "TOP", 6.0, float("inf"), float("inf"), "riot_full"),
    ]
    assert str(df.first().game_start_utc) == "1970-01-01 00:00:01"


def test_league_slice(spark, rows):
    entries = [{"summonerId": f"s{i}", "puuid": f"p{i}", "wins": i, "losses": 1} for i in range(5)]
    docs = raw(spark, json.dumps({"leagueId": "L", "name": "N", "entries": entries}), '{"leagueId": "E"}')
    df = D.flatten_league(docs, "MASTER", offset=3, limit=10, stamp="t")
    assert len(df.columns) == 15
    assert rows(df, "league_id", "source_tier", "puuid") == [("L", "master", "p3"), ("L", "master", "p4")]
    assert D.flatten_league(docs, "master", offset=9, limit=2).count() == 0
    assert rows(D.ladder_winrate(D.flatten_league(docs, "m", 0, 2)), "winrate") == [(0.0,), (0.5,)]


def test_fill_missing_ids(spark, rows):
    players = spark.createDataFrame(
        [("s1", "p1"), ("s2", None), ("s3", ""), (None, None), ("s9", None)], "summoner_id string, puuid string"
    )
    lookup = spark.createDataFrame(
        [("s1", "no", 1, 1), ("s2", "found2", 7, 30), ("s3", "found3", 8, 40)],
        "summoner_id string, puuid string, profile_icon_id int, summoner_level int",
    )
    assert rows(D.fill_missing_ids(players, lookup)) == [
        (None, None, None, None), ("s1", "p1", None, None), ("s2", "found2", 7, 30),
        ("s3", "found3", 8, 40), ("s9", None, None, None),
    ]


def test_reference_documents(spark):
    champions = {"data": {"X": {"key": "2", "name": "Xa", "title": "t", "tags": ["A", "B"]}, "Y": {"key": "1", "name": "Ab", "title": "u"}}}
    got = [tuple(r) for r in D.flatten_champions(raw(spark, json.dumps(champions))).collect()]
    assert got == [(1, "Ab", "u", ""), (2, "Xa", "t", "A,B")]
    items = {"data": {"20": {"name": "i", "gold": {"total": 5, "purchasable": True}, "tags": ["T"]}, "3": {"name": "j"}}}
    got = [tuple(r) for r in D.flatten_items(raw(spark, json.dumps(items))).collect()]
    assert got == [(3, "j", None, None, ""), (20, "i", 5, True, "T")]
    assert D.latest_version(raw(spark, '["16.2", "16.1"]', "[]")).collect()[0].version == "16.2"


def test_normalize_tabular(spark, rows):
    base = {c: None for c in S.TABULAR_COLUMNS}
    data = [
        {**base, "game_id": 5.0, "queue_id": 420, "game_duration": 60, "team_position": None, "individual_position": "TOP",
         "kills": 1, "deaths": 2, "assists": 3, "gold_earned": 10, "game_start_utc": "2020-01-01 00:00:00"},
        {**base, "game_id": 6.0, "queue_id": 420, "team_position": "Invalid", "individual_position": "TOP"},
        {**base, "game_id": 7.0, "queue_id": 450},
    ]
    kinds = {"game_id": "double", "queue_id": "int", "game_duration": "bigint", "kills": "int", "deaths": "int", "assists": "int", "gold_earned": "bigint"}
    df = spark.createDataFrame(
        [tuple(d[c] for c in S.TABULAR_COLUMNS) for d in data],
        ", ".join(f"{c} {kinds.get(c, 'string')}" for c in S.TABULAR_COLUMNS),
    )
    out = N.normalize_tabular(df)
    assert out.columns == S.COMMON.fieldNames()
    assert rows(out, "match_id", "team_position", "kda", "gold_per_min", "cs_per_min", "data_source", "source_tier") == [
        ("5", "TOP", 2.0, 10.0, None, "kaggle", "kaggle"), ("6", "UNDEFINED", None, None, None, "kaggle", "kaggle"),
    ]


def test_normalize_collected_keeps_roles_and_derives_the_start(spark, rows):
    df = spark.createDataFrame([("EU_1", 1000, "", "True", "NaN")], "match_id string, game_start_timestamp bigint, team_position string, win string, kda string")
    out = N.normalize_collected(df)
    row = out.first()
    assert (row.match_id, row.team_position, row.win, row.kda, row.data_source) == ("EU_1", "", True, None, "riot_api")
    assert str(row.game_start_utc) == "1970-01-01 00:00:01"
    assert N.start_text(df).first().game_start_utc == "1970-01-01 00:00:01"


def test_union_keeps_every_row(spark):
    a = N.normalize_collected(spark.createDataFrame([("1",)], "match_id string"))
    assert N.union_sources([a, a, a]).count() == 3
