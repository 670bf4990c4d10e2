"""Sinks: nothing half written, finished runs kept, plans that write nothing."""

import glob

from pagewright.operators import catalog, sinks


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "run_id string, doc_id string, n int")


def test_finished_runs_are_kept(spark, tmp_path):
    at = str(tmp_path / "runs")
    sinks.write_runs(_rows(spark, ("r1", "a", 1), ("r1", "b", 2)), at)
    later = _rows(spark, ("r1", "a", 9), ("r2", "a", 3))
    assert [(r.run_id, r.n) for r in sinks.plan_runs(later, at).collect()] == [("r2", 3)]
    sinks.write_runs(later, at)
    assert {(r.run_id, r.doc_id, r.n) for r in spark.read.parquet(at).collect()} == {("r1", "a", 1), ("r1", "b", 2), ("r2", "a", 3)}


def test_a_table_is_replaced_whole(spark, tmp_path):
    at = str(tmp_path / "t")
    assert sinks.read_or_none(spark, at) is None
    sinks.replace_table(_rows(spark, ("r", "a", 1)), at)
    sinks.replace_table(_rows(spark, ("r", "b", 2)), at)
    assert [r.doc_id for r in sinks.read_or_none(spark, at).collect()] == ["b"] and not glob.glob(f"{at}.*")


def test_triage_and_documents(spark, tmp_path):
    tiers = spark.createDataFrame([(1, ["review_numeric"]), (2, [])], "pos int, tiers array<string>")
    sinks.write_triage(tiers, str(tmp_path / "triage"), 1)
    sinks.write_triage(tiers, str(tmp_path / "triage"), 2)
    assert {(r.pos, r.policy_version) for r in spark.read.parquet(str(tmp_path / "triage")).collect()} == {(1, 1), (1, 2)}
    sinks.write_documents(_rows(spark, ("r", "a", 1)), str(tmp_path / "docs"))
    assert glob.glob(str(tmp_path / "docs/run_id=r/*.json.gz")) and spark.read.json(str(tmp_path / "docs")).count() == 1


def test_upsert(spark):
    old, new = _rows(spark, ("r", "a", 1), ("r", "b", 2)), _rows(spark, ("r", "b", 5), ("r", "c", 6)).drop("n")
    assert {(r.doc_id, r.n) for r in sinks.upsert(old, new, ["run_id", "doc_id"]).collect()} == {("a", 1), ("b", None), ("c", None)}


def test_facets_and_memberships(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([({"a": ["x", "y"], "b": ["p"]}, {"a": ["z"], "b": ["q", "p"]}, ["a"], ["c1", "c2"], ["c3", "c2"], ["c1"]), (None, None, None, None, None, None)], "o map<string,array<string>>, s map<string,array<string>>, d array<string>, co array<string>, cs array<string>, cl array<string>")
    got = df.select(catalog.merge_facets(F.col("o"), F.col("s"), F.col("d")).alias("f"), catalog.merge_containers(F.col("co"), F.col("cs"), F.col("cl")).alias("c")).collect()
    assert got[0].f == {"a": ["z"], "b": ["p", "q"]} and got[0].c == ["c2", "c3"] and got[1].f == {} and got[1].c == []


def test_numbers_over_partitions(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = {r.v: r.n for r in catalog.numbered(df, [F.col("v")], "n").collect()}
    assert got == {v: v + 1 for v in range(1000)}
