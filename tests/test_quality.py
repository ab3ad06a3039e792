import pytest
from pyspark.sql import functions as F

from scrimtally.operators import quality as Q

RULES = Q.Rules(group_size=2)
COLS = """data_source string, match_id string, participant_id bigint, puuid string, champion_id bigint,
    champion_name string, team_id int, win boolean, team_position string, queue_id int, kills int, deaths int,
    assists int, kda double, gold_per_min double, damage_per_min double"""


def good(source="a", match="m", pid=1, win=True):
    return [source, match, pid, "p", 1, "X", 100, win, "TOP", 420, 1, 1, 1, 2.0, 1.0, 1.0]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], COLS)


def report(df, rules=RULES):
    return {r.check: r for r in Q.run_checks(df, rules).collect()}


def pair(**changes):
    rows = [good(pid=1, win=True), good(pid=2, win=False)]
    names = [c.split()[0] for c in COLS.replace("\n", " ").split(",")]
    for name, value in changes.items():
        rows[0][names.index(name)] = value
    return rows


def test_clean_data_passes(spark):
    got = report(frame(spark, pair()))
    assert len(got) == 11 and all(r.passed for r in got.values())
    assert not Q.has_errors(Q.run_checks(frame(spark, pair()), RULES), strict=True)


@pytest.mark.parametrize(
    "changes, failed",
    [
        ({"team_id": 300}, {"team_id_values"}), ({"team_id": None}, {"team_id_values"}),
        ({"queue_id": None}, {"queue_is_ranked_solo"}), ({"queue_id": 450}, {"queue_is_ranked_solo"}),
        ({"kda": None}, {"kda_finite"}), ({"kda": float("nan")}, {"kda_finite"}), ({"kda": float("inf")}, {"kda_finite"}),
        ({"kills": -1}, {"non_negative_metrics"}), ({"puuid": None}, {"keys_not_null"}),
        ({"match_id": ""}, {"keys_not_null", "ten_participants_per_match"}), ({"match_id": None}, {"keys_not_null", "ten_participants_per_match"}),
        ({"win": False}, {"win_balance[a]"}), ({"participant_id": 2}, {"unique_participant_key"}),
        ({"team_position": "Invalid"}, {"team_position_values"}), ({"team_position": "UNDEFINED"}, {"team_position_values"}),
        ({"team_position": None}, set()),
    ],
)
def test_each_defect_fails_its_check(spark, changes, failed):
    got = report(frame(spark, pair(**changes)))
    assert {k for k, r in got.items() if not r.passed} == failed


def test_missing_column_and_empty_table(spark):
    got = report(frame(spark, pair()).drop("kda", "win", "team_id"))
    assert {k for k, r in got.items() if not r.passed} == {"schema_columns", "kda_finite", "team_id_values", "win_balance"}
    assert got["schema_columns"].detail == "missing: team_id, win, kda"
    empty = report(frame(spark, []))
    assert not empty["not_empty"].passed and not empty["team_position_values"].passed
    assert empty["unique_participant_key"].passed


def test_one_balance_row_per_source_and_severity(spark):
    df = frame(spark, pair() + [good("b", "n", i, True) for i in (1, 2)])
    got = report(df)
    assert got["win_balance[a]"].passed and not got["win_balance[b]"].passed
    warn = Q.run_checks(frame(spark, pair(team_position="UNDEFINED")), RULES)
    assert not Q.has_errors(warn) and Q.has_errors(warn, strict=True)
    assert got["non_negative_metrics"].detail == "no negative values"


def test_duplicates_count_null_keys_as_equal(spark):
    rows = [good(match=None, pid=None) for _ in range(3)]
    got = report(frame(spark, rows))
    assert got["unique_participant_key"].detail == "2 surplus rows"
    assert Q.duplicate_participants(frame(spark, rows)).first().copies == 3
    roles = Q.unexpected_roles(frame(spark, pair(team_position="X"))).collect()
    assert [(r.team_position, r.rows) for r in roles] == [("X", 1)]


def test_row_level_checks_read_the_table_once(spark, tmp_path):
    frame(spark, pair()).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = Q._row_level(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert df.select(F.count("*")).first()[0] == 2
