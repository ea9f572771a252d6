"""End-to-end plans B and C: relational catalog -> graph -> CSV -> upsert; graph -> docs -> JSON -> index."""

from pyspark.sql import functions as F

from metaweave.model import PG_COLUMNS
from metaweave.plans.graph_plan import publish_graph, publish_search, relational_records
from metaweave.session import scratch_path
from metaweave.sources.index import read_index


def pg(spark, rows):
    return spark.createDataFrame(rows, PG_COLUMNS)


def test_relational_to_graph_to_index(spark):
    run1 = pg(spark, [("wh", "public", "t", "a", "integer", "first a", 1),
                      ("wh", "public", "t", "b", "text", None, 2),
                      ("wh", "audit", "x", "z", "text", None, 1)])
    tables, cols = relational_records(run1)
    assert sorted(r.table_name for r in tables.collect()) == ["t"]
    assert {r.cluster for r in cols.collect()} == {"wh"}
    nodes, edges = publish_graph(spark, tables, cols, scratch_path(spark, "handoff"), "tag1")
    got = {r.key: (r.description, r.publish_tag) for r in nodes.collect()}
    assert got["postgres/wh/public/t/a"] == ("first a", "tag1")
    assert len(got) == 1 + 1 + 1 + 1 + 2

    run2 = pg(spark, [("wh", "public", "t", "a", "integer", "second a", 1),
                      ("wh", "public", "u", "c", "text", None, 1)])
    tables2, cols2 = relational_records(run2)
    nodes2, edges2 = publish_graph(spark, tables2, cols2, scratch_path(spark, "handoff"), "tag2",
                                   current_nodes=nodes, current_edges=edges)
    got2 = {r.key: (r.description, r.publish_tag) for r in nodes2.collect()}
    assert got2["postgres/wh/public/t/a"] == ("second a", "tag2")
    assert got2["postgres/wh/public/t/b"] == (None, "tag1")      # untouched key keeps its old tag
    assert "postgres/wh/public/u/c" in got2
    ends = {r.start_key for r in edges2.collect()} | {r.end_key for r in edges2.collect()}
    assert ends <= set(got2)

    target = publish_search(spark, nodes2, edges2, None, scratch_path(spark, "docs-json"), alias="plan_idx")
    docs = {r.name: r for r in read_index(spark, "plan_idx").collect()}
    assert target.startswith("tables_")
    assert docs["t"].column_names == ["a", "b"] and docs["t"].column_descriptions == ["second a"]
    assert docs["u"].schema_name == "public" and docs["u"].cluster == "wh" and docs["u"].database == "postgres"
    assert read_index(spark, "plan_idx").where(F.col("last_updated_epoch").isNotNull()).count() == 0
