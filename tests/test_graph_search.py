"""Graph keys, CSV / JSON hand-off, upsert, index swap, search."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from metaweave.model import NODES
from metaweave.operators import graph as G
from metaweave.operators import search as Q
from metaweave.session import scratch_path
from metaweave.sources import exchange, index


def records(spark):
    tables = spark.createDataFrame(
        [("db", "cl", "s", "a/b", "slash table", False), ("db", "cl", "s", "a", None, True)],
        "db string, cluster string, schema_name string, table_name string, description string, is_view boolean")
    columns = spark.createDataFrame(
        [("db", "cl", "s", "a/b", "x", "the x", "int", 0), ("db", "cl", "s", "a", "b", None, "string", 0),
         ("db", "cl", "s", "a", "c", "see", "int", 1)],
        "db string, cluster string, schema_name string, table_name string, col_name string, description string, "
        "col_type string, sort_order int")
    return tables, columns


def test_keys_are_escaped_and_unique(spark):
    tables, columns = records(spark)
    nodes = G.graph_nodes(tables, columns)
    keys = [r.key for r in nodes.collect()]
    assert len(keys) == len(set(keys)) == 1 + 1 + 1 + 2 + 3
    assert "db/cl/s/a%2Fb" in keys and "db/cl/s/a/b" in keys
    edges = G.graph_edges(tables, columns)
    ends = {r.start_key for r in edges.collect()} | {r.end_key for r in edges.collect()}
    assert ends <= set(keys)


def test_csv_round_trip_is_identity(spark):
    rows = [("k1", "Table", "n", None, None, 1, True), ("k2", "Table", "", 'quote " here', "a\nb", None, None),
            ("k3", "Column", "back\\slash", ",", "", 0, False)]
    nodes = spark.createDataFrame(rows, NODES)
    edges = spark.createDataFrame([("k1", "k2", "TABLE")], "start_key string, end_key string, type string")
    out = scratch_path(spark, "csv-test")
    exchange.write_graph_csv(nodes, edges, out)
    back_nodes, back_edges = exchange.read_graph_csv(spark, out)
    assert sorted(back_nodes.collect()) == sorted(nodes.collect())
    assert back_edges.collect() == edges.collect()


def test_upsert(spark):
    cur = spark.createDataFrame([("k1", "a", "t1"), ("k2", "b", "t1")], "key string, v string, publish_tag string")
    batch = spark.createDataFrame([("k2", "c"), ("k3", "d")], "key string, v string")
    once = G.publish_upsert(cur, batch, "t2")
    got = sorted((r.key, r.v, r.publish_tag) for r in once.collect())
    assert got == [("k1", "a", "t1"), ("k2", "c", "t2"), ("k3", "d", "t2")]
    twice = G.publish_upsert(once, batch, "t2")
    assert sorted(twice.collect()) == sorted(once.collect())


def test_documents_json_and_index_swap(spark):
    tables, columns = records(spark)
    nodes, edges = G.graph_nodes(tables, columns), G.graph_edges(tables, columns)
    lu = spark.createDataFrame([("db", "cl", "s", "a", 7)],
                               "db string, cluster string, schema_name string, table_name string, "
                               "last_updated_time_epoch long")
    docs = Q.search_documents(nodes, edges, lu)
    got = {r.name: r for r in docs.collect()}
    assert got["a"].column_names == ["b", "c"] and got["a"].column_descriptions == ["see"]
    assert got["a"].last_updated_epoch == 7 and got["a/b"].last_updated_epoch is None
    assert (got["a"].database, got["a"].cluster, got["a"].schema_name) == ("db", "cl", "s")
    path = scratch_path(spark, "json-test")
    exchange.write_json(docs, path)
    assert sorted(exchange.read_json(spark, path).collect()) == sorted(docs.collect())
    first = index.publish_index(docs.where(F.col("name") == "a"), alias="t_idx")
    second = index.publish_index(docs, alias="t_idx")
    assert first != second
    assert index.read_index(spark, "t_idx").count() == 2
    # The last three targets stay for readers that are still at one of them; older ones go.
    third, fourth, fifth = (index.publish_index(docs, alias="t_idx") for _ in range(3))
    assert [spark.catalog.tableExists(t) for t in (first, second, third, fourth, fifth)] == [False, True, True, True, True]
    assert index.current_target(spark, "t_idx") == fifth


def test_lookup(spark):
    tables, columns = records(spark)
    nodes, edges = G.graph_nodes(tables, columns), G.graph_edges(tables, columns)
    keys = spark.createDataFrame([("db/cl/s/a",), ("db/cl/s/missing",)], "key string")
    got = {r.key: r for r in G.graph_lookup(nodes, edges, keys).collect()}
    assert got["db/cl/s/a"].found and got["db/cl/s/a"].columns_text == "0:b:string|1:c:int"
    assert not got["db/cl/s/missing"].found


def test_bm25_ranks_rare_term_first(spark):
    docs = spark.createDataFrame(
        [("k1", "alpha", "common words", ["x"], []), ("k2", "beta", "common rare", ["y"], ["rare"]),
         ("k3", "gamma", None, ["common"], [])],
        "key string, name string, description string, column_names array<string>, "
        "column_descriptions array<string>")
    index = Q.search_index(docs)
    tf = {(r.term, r.key): r.tf for r in index.postings.collect()}
    assert tf[("rare", "k2")] == 2 and tf[("common", "k1")] == 1
    queries = spark.createDataFrame([(1, "rare common"), (2, "nothing")], "query_id int, text string")
    ranked = Q.search_rank(queries, index, k=2).orderBy("query_id", "rank").collect()
    # k2 holds the rare term; of the rest the shorter document (k3) ranks first.
    assert [(r.query_id, r.rank, r.key) for r in ranked] == [(1, 1, "k2"), (1, 2, "k3")]


def test_topk_is_limited_before_the_shuffle(spark):
    docs = spark.createDataFrame(
        [(f"k{i}", f"n{i}", "common", [], []) for i in range(50)],
        "key string, name string, description string, column_names array<string>, "
        "column_descriptions array<string>")
    index = Q.search_index(docs)
    queries = spark.createDataFrame([(1, "common")], "query_id int, text string")
    ranked = Q.search_rank(queries, index, k=3)
    assert ranked.count() == 3
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


DOCS = "key string, name string, description string, column_names array<string>, column_descriptions array<string>"


def test_postings_keep_fields_and_positions(spark):
    docs = spark.createDataFrame([("k", "a-b a", "B c", ["a", "x a"], [None, "c"]), ("none", None, "...", [], None)], DOCS)
    index = Q.search_index(docs)
    got = {r.term: ([(f.field, f.positions) for f in r.fields], r.tf, r.doc_len) for r in index.postings.collect()}
    assert got["a"] == ([("name", [0, 2]), ("column_names", [0, 2])], 4, 9)
    assert got["b"] == ([("name", [1]), ("description", [0])], 2, 9)
    assert got["c"] == ([("description", [1]), ("column_descriptions", [0])], 2, 9) and set(got) == {"a", "b", "c", "x"}
    assert [tuple(r) for r in index.stats.collect()] == [(1, 9)]
    assert Q.search_rank(spark.createDataFrame([(1, "a")], "query_id int, text string"), Q.search_index(docs.limit(0)), k=3).count() == 0


def bm25(docs, queries, k):
    """All documents of every query, in plain Python."""
    words = {d[0]: [w for w in re.split("[^a-z0-9]+", " ".join([d[1] or "", d[2] or "", *d[3], *d[4]]).lower()) if w] for d in docs}
    words = {key: w for key, w in words.items() if w}
    mean = sum(map(len, words.values())) / len(words)
    out = []
    for q, text in queries:
        scores = {}
        for t in set(re.split("[^a-z0-9]+", text.lower())) - {""}:
            df = sum(t in w for w in words.values())
            for key, w in words.items():
                if tf := w.count(t):
                    idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                    scores[key] = scores.get(key, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        best = sorted(scores, key=lambda x: (-round(scores[x], 6), x))[:k]
        out += [(q, i + 1, key) for i, key in enumerate(best)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_ranking_equals_full_scoring(spark, tmp_path, seed):
    """Zipf-like terms: common ones are weak, rare ones fewer than k; ties; unknown terms; an index read back from files."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(f"k{i:03d}", " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 12))), None, rng.choices(vocabulary, weights, k=2) if i % 3 else [], []) for i in range(400)]
    queries = [(q, " ".join(rng.choices(vocabulary, k=rng.randint(1, 6)) + rng.choices(vocabulary, weights, k=3) + ["unknown"])) for q in range(25)]
    index = Q.search_index(spark.createDataFrame(docs, DOCS), 8).write(str(tmp_path / "index"))
    asked = spark.createDataFrame(queries, "query_id int, text string")
    for k in (1, 5, 500):
        got = [(r.query_id, r.rank, r.key) for r in Q.search_rank(asked, index, k=k).collect()]
        assert sorted(got) == sorted(bm25(docs, queries, k))


def test_ranking_reads_the_query_terms_folders_only(spark, tmp_path):
    index = Q.search_index(spark.createDataFrame([(f"k{i}", f"n{i} common", None, [], []) for i in range(300)], DOCS), 64).write(str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "n7 n9")], "query_id int, text string")
    ranked = Q.search_rank(queries, index, k=3)
    assert {r.key for r in ranked.collect()} == {"k7", "k9"}
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_broadcast_only_under_the_bound(spark):
    from metaweave.functions.sizing import at_most, broadcast_if_small
    small = spark.range(5)
    assert at_most(small, 5) and not at_most(small, 4)
    big = spark.range(100).withColumnRenamed("id", "k")
    joined = spark.range(1000).withColumnRenamed("id", "k").join(broadcast_if_small(big, 10), "k")
    assert joined.count() == 100
