import json

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from registry import ingest as queries
from scrimtally import schemas as S
from scrimtally import sources as IO
from scrimtally.operators.quality import Rules
from scrimtally.plans import stages
from scrimtally.session import scratch_dir
from scrimtally.streaming import incremental_ingest, ingested_log, ingested_matches
from scrimtally.streaming import ingest as ingest_module
from scrimtally.streaming.ingest import ingest_batch
from test_documents import match


def put(spark, folder, *docs):
    spark.createDataFrame(list(docs), S.RAW_MATCHES).coalesce(1).write.mode("append").parquet(folder)


def ingest(spark, base, **kw):
    incremental_ingest(spark, f"{base}/in", f"{base}/out", f"{base}/cp", "master", stamp="t", **kw)
    log = sorted((r.batch_id, str(r.match_id), r.status) for r in ingested_log(spark, f"{base}/out").collect())
    found = sorted((r.match_id, r.participant_id, r.batch_id) for r in ingested_matches(spark, f"{base}/out").collect())
    return log, found


def test_incremental_ingest(spark, tmp_path):
    base = str(tmp_path)
    assert ingested_matches(spark, f"{base}/out").count() == 0
    put(spark, f"{base}/in", ("a", match("a")), ("a", match("a")), ("bad", "{"), ("b", match("b", 1)))
    log, found = ingest(spark, base)
    assert log == [(0, "a", "success"), (0, "b", "success"), (0, "bad", "match_detail_error")]
    assert found == [("a", 1, 0), ("a", 2, 0), ("b", 1, 0)]
    # nothing new: no batch at all
    assert ingest(spark, base) == (log, found)
    # a known match in a new file is skipped, a failed one is tried again
    put(spark, f"{base}/in", ("a", match("a", 4)), ("bad", match("bad", 1)), ("c", match("c", 1)))
    log2, found2 = ingest(spark, base)
    assert log2 == log + [(1, "bad", "success"), (1, "c", "success")]
    assert found2 == sorted(found + [("bad", 1, 1), ("c", 1, 1)])
    # a batch that is replayed after a failure leaves the same result
    docs = spark.read.parquet(f"{base}/in").withColumn("file", F.lit("f"))
    ingest_batch(docs.filter("match_id in ('bad', 'c')"), 1, f"{base}/out", "master", "t")
    assert ingested_matches(spark, f"{base}/out").count() == len(found2)
    assert ingested_log(spark, f"{base}/out").count() == len(log2)


def test_one_file_per_batch(spark, tmp_path):
    base = str(tmp_path)
    for name in ("a", "b", "a"):
        put(spark, f"{base}/in", (name, match(name, 1)))
    log, found = ingest(spark, base, files_per_batch=1)
    assert sorted(x[1] for x in log) == ["a", "b"] and len(found) == 2
    assert ingested_log(spark, f"{base}/out").select("batch_id").distinct().count() == 2


def test_batches_are_cut_by_bytes(spark, tmp_path):
    base = str(tmp_path)
    for name in ("a", "b", "c"):
        put(spark, f"{base}/in", (name, match(name, 1)))
    log, _ = ingest(spark, base, bytes_per_batch=1)
    assert [x[0] for x in log] == [0, 1, 2]
    put(spark, f"{base}/in", ("d", match("d", 1)))
    put(spark, f"{base}/in", ("e", match("e", 1)))
    log, _ = ingest(spark, base)
    assert [x[0] for x in log] == [0, 1, 2, 3, 3]


def test_a_readable_copy_wins_over_broken_ones(spark, tmp_path):
    docs = [x for n in range(8) for x in ((f"m{n}", match(f"m{n}", 1)[:-9]), (f"m{n}", match(f"m{n}", 1)))]
    put(spark, f"{tmp_path}/in", *docs, ("m0", match("other", 1)))
    log, found = ingest(spark, str(tmp_path))
    assert log == [(0, f"m{n}", "success") for n in range(8)]
    assert found == [(f"m{n}", 1, 0) for n in range(8)]


def test_documents_listed_without_an_id(spark, tmp_path):
    docs = [(None, match("a", 2)), (None, match("b", 2)), ("b", match("b", 2)), (None, "{"), (None, "["), (None, None)]
    put(spark, f"{tmp_path}/in", *docs)
    log, found = ingest(spark, str(tmp_path))
    assert log == [(0, "None", "match_detail_error")] * 3 + [(0, "a", "success"), (0, "b", "success")]
    assert found == [("a", 1, 0), ("a", 2, 0), ("b", 1, 0), ("b", 2, 0)]
    # the ids found inside are known to later batches
    put(spark, f"{tmp_path}/in", (None, match("a", 1)))
    assert ingest(spark, str(tmp_path)) == (log, found)


def test_parsed_documents_are_staged_compactly(spark, tmp_path, monkeypatch):
    """Nested texts are neither cached nor shuffled; the stage goes, and known documents go before a join."""
    def no_cache(self, *args):
        raise AssertionError("parsed documents are cached")

    monkeypatch.setattr(type(spark.range(1)), "persist", no_cache)
    many = [(f"m{i}", match(f"m{i}", 2)) for i in range(30)]
    put(spark, f"{tmp_path}/in", *many, *many[:5], ("bad", "{"), ("bad", "["), ("empty", match("empty", 0)))
    log, found = ingest(spark, str(tmp_path))
    assert log == sorted([(0, f"m{i}", "success") for i in range(30)] + [(0, "bad", "match_detail_error"), (0, "empty", "success")])
    assert found == sorted((f"m{i}", p, 0) for i in range(30) for p in (1, 2))
    put(spark, f"{tmp_path}/in", *many, ("bad", match("bad", 1)), ("new", match("new", 1)), (None, "{"))
    log2, found2 = ingest(spark, str(tmp_path))
    assert sorted(set(log2) - set(log)) == [(1, "None", "match_detail_error"), (1, "bad", "success"), (1, "new", "success")]
    assert found2 == sorted([*found, ("bad", 1, 1), ("new", 1, 1)])
    assert not IO.path_exists(spark, f"{tmp_path}/out/_stage/batch_id=*")


def test_one_large_file_is_parsed_by_several_tasks(spark, tmp_path, monkeypatch):
    """A row group is read by one task; its documents are dealt over more, but not those that are known."""
    monkeypatch.setattr(ingest_module, "FEW_DOCUMENTS", 50, raising=False)
    body = F.replace(F.lit(match("name", 2)), F.lit("name"), F.col("match_id"))
    docs = spark.range(400).select(F.concat(F.lit("m"), "id").alias("match_id")).withColumn("_raw_json", body)
    for share in (docs, docs.unionByName(docs.withColumn("match_id", F.lit("bad")).limit(1))):
        share.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        log, found = ingest(spark, str(tmp_path))
    assert ingested_matches(spark, f"{tmp_path}/out").select(F.input_file_name()).distinct().count() > 1
    assert log == sorted([(0, f"m{i}", "success") for i in range(400)] + [(1, "bad", "match_detail_error")])
    assert found == sorted((f"m{i}", p, 0) for i in range(400) for p in (1, 2))


def test_parts_are_written_as_several_files(spark, tmp_path, monkeypatch):
    """A part is a batch, whatever its files; no file is empty."""
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 50, raising=False)
    lines = spark.range(1200).selectExpr("id % 300 l_orderkey", "id % 50 l_partkey", "id % 7 l_suppkey", "id l_linenumber", "id % 50 + 0.5D l_quantity")
    orders = spark.range(300).selectExpr("id o_orderkey", "id % 11 o_custkey", "DATE'2020-03-01' o_orderdate")
    for name, data in (("lineitem", lines), ("orders", orders)):
        data.write.parquet(f"{tmp_path}/{name}.parquet")
    out = queries.ingested_in_parts(spark, str(tmp_path))
    broken = F.expr(queries.BROKEN)
    counts = {r[0]: (r[1], r[2]) for r in lines.groupBy(F.expr("l_orderkey % 3")).agg(F.count_if(~broken), F.count_if(broken)).collect()}
    want = [(b, s, n) for b in counts for s, n in zip(("success", "match_detail_error"), counts[b], strict=True) if n]
    want.append((3, "match_detail_error", counts[0][1] + counts[2][1]))
    log = ingested_log(spark, f"{out}/out").groupBy("batch_id", "status").count()
    assert sorted(map(tuple, log.collect())) == sorted(want)
    # the other ingest queries make their documents in several tasks a core
    spread = []
    monkeypatch.setattr(queries, "match_documents", lambda s, d, spread=False, tasks=None, seen=spread: seen.append(spread) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.ingested(spark, str(tmp_path))
    assert spread == [True]
    sizes = spark.read.parquet(f"{out}/in").groupBy(F.input_file_name()).count()
    assert sizes.count() == 4 * 8 and sizes.agg(F.min("count")).first()[0] > 0


@pytest.mark.parametrize("few", [0, 9])
def test_known_documents_are_dropped_before_a_shuffle(spark, tmp_path, monkeypatch, few):
    """With more new ids than are broadcast, too; documents without an id stay."""
    monkeypatch.setattr(ingest_module, "FEW_IDS", few)
    ids = [*(f"m{i}" for i in range(200)), "x", "y", "y", None, None]
    docs = spark.createDataFrame([(i, "{}") for i in ids], S.RAW_MATCHES)
    log = spark.createDataFrame([(f"m{i}", "success") for i in range(200)] + [("y", "match_detail_error")], "match_id string, status string")
    left = ingest_module._unknown(docs, log, str(tmp_path))
    assert sorted(str(r.match_id) for r in left.collect()) == ["None", "None", "x", "y", "y"]
    # a semi join that is broadcast comes before the exact one
    assert "LeftSemi" in left._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_participants_within_a_document(spark, tmp_path):
    body = json.loads(match("a", 2))
    for i, p in enumerate(body["info"]["participants"]):
        p["participantId"], p["kills"] = 1, i
    put(spark, f"{tmp_path}/in", ("a", json.dumps(body)))
    ingest(spark, str(tmp_path))
    assert [r.kills for r in ingested_matches(spark, f"{tmp_path}/out").collect()] == [0]
    body["metadata"]["matchId"] = "b"
    put(spark, f"{tmp_path}/in", ("b", json.dumps(body)))
    ingest(spark, str(tmp_path))
    assert [r.kills for r in ingested_matches(spark, f"{tmp_path}/out").filter("match_id = 'b'").collect()] == [1]


def test_csv_keeps_long_ids_quotes_and_line_breaks(spark, tmp_path, rows):
    data = [("12345678901234567890", 'say "hi", ok\nnext', 1.5), (None, None, None), ("007", "a\\b", 2.0)]
    df = spark.createDataFrame(data, "match_id string, text string, x double")
    IO.write_table(df, f"{tmp_path}/t", ["parquet", "csv"])
    assert rows(IO.read_csv(spark, f"{tmp_path}/t.csv", df.schema, multi_line=True)) == rows(df)
    assert rows(IO.resolve_source(spark, f"{tmp_path}/t")) == rows(df)
    with pytest.raises(ValueError):
        IO.write_table(df, f"{tmp_path}/u", ["xlsx"])


def test_source_resolution(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(IO.SourceMissing):
        IO.resolve_source(spark, f"{tmp_path}/t")
    assert IO.read_optional(spark, f"{tmp_path}/t") is None and IO.present([None, df]) == [df]
    assert IO.read_csv_or_empty(spark, f"{tmp_path}/t.csv", df.schema).count() == 0
    IO.write_table(df, f"{tmp_path}/t", ["csv"])
    assert IO.resolve_source(spark, f"{tmp_path}/t", df.schema).count() == 1
    assert IO.read_csv_or_empty(spark, f"{tmp_path}/t.csv", df.schema).count() == 1
    with pytest.raises(ValueError):
        IO.resolve_source(spark, f"{tmp_path}/t")
    assert IO.missing_tables(spark, str(tmp_path), ["t", "u"]) == ["u"]
    with pytest.raises(IO.SourceMissing, match="u"):
        IO.read_star(spark, str(tmp_path), ["t", "u"])
    assert IO.read_star(spark, str(tmp_path), ["t"], {"t": df.schema})["t"].count() == 1


def test_glob_columns_and_views(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(str(i), "{}", 1)], "match_id string, _raw_json string, extra int").write.parquet(f"{tmp_path}/d/{i}.parquet")
    df = IO.read_parquet(spark, f"{tmp_path}/d/*.parquet", ["match_id", "_raw_json"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2 and "extra" not in plan
    IO.register_views(spark, {"docs_view": df, "path_view": f"{tmp_path}/d/0.parquet"})
    assert spark.sql("select count(*) from docs_view join path_view using (match_id)").first()[0] == 1


def test_layout_and_pruning(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("data_source"), (F.col("id") % 50).alias("k"), "id")
    out = IO.write_parquet(df, f"{tmp_path}/t", partition_by=["data_source"], cluster_by=["k"])
    assert out.columns == df.columns and out.count() == 1000 and dict(out.dtypes)["data_source"] == "string"
    plan = out.filter("data_source = '1' and k = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_source" in plan and "PushedFilters: [IsNotNull(k), EqualTo(k,7)]" in plan


def test_export_counts_and_schema_columns(spark, tmp_path):
    df = spark.range(5)
    assert IO.export_tables({"a": df, "b": df.limit(2)}, str(tmp_path)) == {"a": 5, "b": 2}
    assert not IO.missing_tables(spark, str(tmp_path), ["a", "b"])
    names = [r.column for r in IO.schema_columns(spark, S.COMMON).collect()]
    assert names == S.COMMON.fieldNames() and len(names) == 51
    for _ in range(2):
        IO.append_log(df, f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 10


def test_jdbc_load(spark, monkeypatch):
    """Without a database: the writes and the read-back are recorded."""
    calls, stored = [], {}

    def write(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))
        stored[table] = 3

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties=None: spark.range(stored[table]))
    tables = {"fact_participant": spark.range(3), "big": spark.range(9), "dim": spark.range(1)}
    done = IO.load_jdbc(spark, tables, "jdbc:x", skip=[" big ", ""], properties={"user": "u"})
    assert done == ["fact_participant", "dim"] and calls[0] == ("jdbc:x", "fact_participant", {"user": "u"})
    with pytest.raises(IO.SourceMissing, match="lost"):
        IO.load_jdbc(spark, tables, "jdbc:x", required=["lost", "dim"])
    tables["fact_participant"] = spark.range(4)
    with pytest.raises(RuntimeError, match="3 rows stored, 4 expected"):
        IO.load_jdbc(spark, tables, "jdbc:x")


def reference(spark):
    champions = spark.createDataFrame([(10, "C0", "t", "Mage"), (11, "C1", "t", "Tank")], S.CHAMPIONS_REF)
    items = spark.createDataFrame([(3001, "Sword", 2500, True, "A")], S.ITEMS_REF)
    return champions, items


def test_all_stages(spark, tmp_path):
    docs = spark.createDataFrame([(f"m{i}", match(f"m{i}", 2)) for i in range(12)], S.RAW_MATCHES)
    docs = docs.withColumn("_raw_json", F.regexp_replace("_raw_json", '"teamPosition": "[A-Za-z]*"', '"teamPosition": "TOP"'))
    rules = Rules(group_size=2)
    star = stages.run_all(spark, str(tmp_path), *reference(spark), documents=docs, rules=rules)
    assert list(star) and set(star) == set(S.STAR_TABLES)
    assert {n: star[n].count() for n in ("fact_participant", "dim_match", "dim_champion", "fact_participant_item", "item_stats")} == {
        "fact_participant": 24, "dim_match": 12, "dim_champion": 2, "fact_participant_item": 24, "item_stats": 1,
    }
    row = star["item_stats"].first()
    assert (row.item_name, row.purchases, row.winrate) == ("Sword", 24, 0.5)
    assert IO.read_star(spark, f"{tmp_path}/star", S.STAR_TABLES)["champion_strength"].count() == 2
    with pytest.raises(stages.QualityError):
        stages.run_all(spark, f"{tmp_path}/x", *reference(spark), documents=docs, rules=Rules(group_size=3))
    with pytest.raises(ValueError):
        stages.build_common()


class _Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, master, **settings):
        self.settings, self.sparkContext, self.master = settings, self, master

    def getConf(self):
        return self.settings

    def getCheckpointDir(self):
        return None


def test_scratch_folder_is_the_shared_one():
    shared = _Session("spark://host", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_dir(shared, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://host"), "x")
    assert "/run-" in scratch_dir(_Session("local[4]"), "x")
