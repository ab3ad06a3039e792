"""The physical plans that carry the design."""

import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    "champion_strength item_stats champion_by_duration complete_matches dim_champion dim_match dim_player kpis champion_ranking "
    "player_profiles scaling patch_shift popular_by_source quality_report source_overview keyed_upsert unseen_ids".split(),
)
def test_no_product_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in text


def test_reports_prune_partitions_and_columns(spark):
    text = plan(QUERIES["champion_ranking"](spark, SF_DIR))
    fact = next(line for line in text.splitlines() if "FileScan" in line and "role_key" not in line and "kda" in line)
    assert "PartitionFilters: [isnotnull(data_source" in fact
    assert "ReadSchema: struct<match_id:string,champion_id:bigint,win:boolean,kda:double>" in fact


def test_small_dimensions_are_broadcast_by_their_file_size(spark):
    text = plan(QUERIES["champion_strength"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(QUERIES["champion_strength"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")


def test_the_match_count_is_computed_once(spark):
    df = QUERIES["complete_matches"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_top_n_per_group_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["popular_by_source"](spark, SF_DIR))


def test_writes_by_folder_are_not_sorted(spark, tmp_path):
    """Wide rows sorted by folder before the write spill where a task holds many of them."""
    spark.sql(f"CREATE TABLE by_folder (id BIGINT, k STRING) USING parquet PARTITIONED BY (k) LOCATION '{tmp_path}/t'")
    try:
        rows = "SELECT id, CAST(id % 3 AS STRING) FROM range(9)"
        text = spark.sql(f"EXPLAIN INSERT INTO by_folder {rows}").first()[0]
        assert "Sort" not in text
        spark.sql(f"INSERT INTO by_folder {rows}")
        assert spark.table("by_folder").filter("k = '1'").count() == 3
    finally:
        spark.sql("DROP TABLE by_folder")
