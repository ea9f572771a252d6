"""The bucketed graph: merges touch only the buckets of their tables and equal a merge of whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from metaweave.operators import graph as G
from metaweave.operators.graph import table_part
from metaweave.sources import graph_store
from metaweave.sources.graph_store import GraphStore, bucket_of

TABLES = "db string, cluster string, schema_name string, table_name string, description string, is_view boolean"
COLUMNS = "db string, cluster string, schema_name string, table_name string, col_name string, description string, col_type string, sort_order int"


def graph(spark, tables, note=""):
    t = spark.createDataFrame([("d", "c", "s/1", n, f"{n}{note}", False) for n in tables], TABLES)
    c = spark.createDataFrame([("d", "c", "s/1", n, f"c/{i}", note, "int", i) for n in tables for i in range(3)], COLUMNS)
    return G.graph_nodes(t, c), G.graph_edges(t, c)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def store(spark, tmp_path):
    names = [f"t{i}" for i in range(60)]
    return GraphStore(spark, str(tmp_path / "graph"), buckets=16).create(*graph(spark, names), "run_a")


def test_untouched_files_stay(spark, store):
    before = files(store.root)
    touched = store.upsert(*graph(spark, ["t7", "new"], "!"), "run_b")
    after = files(store.root)
    mine = {r[0] for r in spark.createDataFrame([("d/c/s%2F1/t7",), ("d/c/s%2F1/new",)], "k string").select(bucket_of("k", 16)).collect()}
    assert {f"Table/{b}" for b in mine} | {f"Column/{b}" for b in mine} == {p for p in touched["nodes"] if p.split("/")[0] in ("Table", "Column")}
    assert {f"TABLE/{b}" for b in mine} == {p for p in touched["edges"] if p.startswith("TABLE/")}
    assert {p: t for p, t in after.items() if p in before} == before          # nothing is rewritten in place
    new = {"/".join(x.split("=")[1] for x in p.split("/")[-4:-2]) for p in after if p not in before}
    assert new == set(touched["nodes"]) | set(touched["edges"])
    assert len(new) < 20 < len(before)


def test_readers_stay_at_their_version(spark, store):
    old, n = store.nodes(), store.nodes().count()
    for i in range(2):
        store.upsert(*graph(spark, ["t7", f"new{i}"], f"{i}"), f"run_{i}")
    assert old.count() == n and old.where("publish_tag <> 'run_a'").count() == 0
    assert store.nodes(1).count() == n and store.version() == 3
    store.upsert(*graph(spark, ["t7"], "9"), "run_9")  # the first version's own runs go now
    assert store.nodes(2).count() == n + 4 and store.nodes().where("publish_tag = 'run_9'").count() == 3 + 4


def test_two_merges_at_once_lose_nothing(spark, store, monkeypatch):
    """The second merge commits between the first one's read and its commit."""
    other = GraphStore(spark, store.root, buckets=16)
    calls = []

    def slow(spark_, folder, version, text, commit=graph_store.commit_version):
        calls.append(version)
        if len(calls) == 1:
            other.upsert(*graph(spark, ["t7", "theirs"], "?"), "run_c")
        return commit(spark_, folder, version, text)

    monkeypatch.setattr(graph_store, "commit_version", slow)
    store.upsert(*graph(spark, ["t8", "ours"], "!"), "run_b")
    assert calls == [2, 2, 3] and store.version() == 3
    tags = {r.name: r.publish_tag for r in store.nodes().where("label = 'Table'").collect()}
    assert (tags["ours"], tags["theirs"], tags["t7"], tags["t8"], tags["t9"]) == ("run_b", "run_c", "run_c", "run_b", "run_a")
    assert store.edges().where("type = 'TABLE'").count() == 62


def test_merge_equals_the_merge_of_whole_tables(spark, store):
    batch = graph(spark, ["t3", "t4", "new"], "!")
    want_nodes = G.publish_upsert(store.nodes(), batch[0], "run_b")
    want_edges = G.publish_upsert(store.edges(), batch[1], "run_b", keys=("start_key", "end_key", "type"))
    want = {tuple(r) for r in want_nodes.select(*store.nodes().columns).collect()}, {tuple(r) for r in want_edges.select(*store.edges().columns).collect()}
    for _ in range(2):  # a second run of the batch changes nothing
        store.upsert(*batch, "run_b")
        assert ({tuple(r) for r in store.nodes().collect()}, {tuple(r) for r in store.edges().collect()}) == want
    assert store.nodes().where(F.col("publish_tag") == "run_b").count() == 3 + 3 * 4
    assert store.upsert(*graph(spark, []), "run_c") == {"nodes": [], "edges": []}
    assert {tuple(r) for r in store.nodes().collect()} == want[0]


def test_reads_prune_folders(spark, store):
    plan = store.nodes().where(F.col("label") == "Table")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan


def test_table_part(spark):
    keys = ["d", "d/c/s", "d/c/s/t", "d/c/s/t/c", "d/c/s%2F1/t/c"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(table_part("k")).collect()] == ["d", "d/c/s", "d/c/s/t", "d/c/s/t", "d/c/s%2F1/t"]


def test_lookup_prunes_and_checks_edges(spark, store):
    """Requests reach the scans as hashes, hops read their own folders, and a decoded parent counts only with its edge."""
    from metaweave.operators.search import search_documents
    nodes, edges = store.nodes(), store.edges()
    keys = spark.createDataFrame([("d/c/s%2F1/t5",), ("d/c/s%2F1/t5",), ("d/c/s%2F1/none",), (None,)], "key string")
    found = G.graph_lookup(nodes, edges, keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_mw_place") > 3 and "PartitionFilters: [label" in plan and "PartitionFilters: [type" in plan
    got = {r.key: (r.found, r.schema_name, r.columns_text) for r in found.collect()}
    assert got == {"d/c/s%2F1/t5": (True, "s/1", "0:c/0:int|1:c/1:int|2:c/2:int"), "d/c/s%2F1/none": (False, None, None), None: (False, None, None)}
    cut = edges.where("end_key NOT IN ('d/c/s%2F1/t5', 'd/c/s%2F1/t6/c%2F1')")
    docs = {r.name: r for r in search_documents(nodes.where("key <> 'd/c/s%2F1/t7'"), cut).collect()}
    assert docs["t5"].schema_name is None and docs["t5"].database is None and len(docs["t5"].column_names) == 3
    assert docs["t6"].column_names == ["c/0", "c/2"] and docs["t6"].database == "d" and "t7" not in docs and len(docs) == 59
