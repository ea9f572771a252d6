"""What one task holds follows a fixed size, not the input: parts and buckets grow with the files that are read."""

import os

import pytest
from pyspark.sql import functions as F

from metaweave.functions import sizing
from metaweave.model import RAW_DESCRIBE
from metaweave.operators import describe as D
from metaweave.operators import graph as G
from metaweave.sources.graph_store import GraphStore
from metaweave.sources.landed import land_describe, write_landed

TABLES = "db string, cluster string, schema_name string, table_name string, description string, is_view boolean"
COLUMNS = "db string, cluster string, schema_name string, table_name string, col_name string, description string, col_type string, sort_order int"


@pytest.fixture
def lines(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.lit("s").alias("schema_name"), F.concat(F.lit("t"), (F.col("id") % 9000).cast("string")).alias("table_name"),
        (F.col("id") / 9000 + 1).cast("int").alias("row_no"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("col_name"),
        F.lit("int").alias("data_type"), F.sha2(F.col("id").cast("string"), 256).alias("comment"))
    rows.write.parquet(str(tmp_path / "lines"))
    return spark.read.schema(RAW_DESCRIBE).parquet(str(tmp_path / "lines"))


@pytest.fixture
def records(spark, tmp_path):
    names = [(f"t{i}", f"words of {i * 7919}") for i in range(3000)]
    spark.createDataFrame([("d", "c", "s", n, d, False) for n, d in names], TABLES).write.parquet(str(tmp_path / "tables"))
    spark.createDataFrame([("d", "c", "s", n, f"c{i}", d, "int", i) for n, d in names for i in range(3)], COLUMNS).write.parquet(str(tmp_path / "columns"))
    return spark.read.parquet(str(tmp_path / "tables")), spark.read.parquet(str(tmp_path / "columns"))


def in_parts(df):
    """Rows of the largest partition that holds any."""
    return max(
        r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_sizes_follow_the_files(spark, lines, monkeypatch):
    size = sizing.read_bytes(lines)
    assert size > 1_000_000 and sizing.read_bytes(spark.createDataFrame([(1,)], "a int")) < 1000
    assert sizing.tasks_for(lines) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sizing, "TASK_BYTES", size // 100)
    assert 100 <= sizing.tasks_for(lines) <= 102


def test_landed_buckets_follow_the_size(spark, lines, tmp_path, monkeypatch):
    want = sorted(D.partition_columns(D.annotate_describe(lines)).collect())
    monkeypatch.setattr(sizing, "TASK_BYTES", sizing.read_bytes(lines) // 60)
    landed = land_describe(lines, "sized_lines", str(tmp_path / "landed"))
    assert len([f for f in os.listdir(tmp_path / "landed") if f.endswith(".parquet")]) >= 50
    assert landed.drop("row_block").exceptAll(lines).isEmpty() and landed.count() == 60_000
    columns = D.partition_columns(D.annotate_describe(landed))
    assert sorted(columns.collect()) == want and in_parts(columns) < 60_000 // 8 // 2
    write_landed({"raw_describe": lines}, str(tmp_path / "plain"))
    assert len([f for f in os.listdir(tmp_path / "plain" / "raw_describe") if f.endswith(".parquet")]) >= 50


def test_merge_and_documents_are_dealt_by_size(spark, records, tmp_path, monkeypatch):
    nodes, edges = G.graph_nodes(*records), G.graph_edges(*records)
    plain = GraphStore(spark, str(tmp_path / "plain"), buckets=4).create(nodes, edges, "a")
    monkeypatch.setattr(sizing, "TASK_BYTES", sizing.read_bytes(plain.edges()) // 40)
    merged = G.publish_upsert(plain.edges(), edges, "b", keys=("start_key", "end_key", "type"))
    assert merged.count() == edges.count() and in_parts(merged) < 12_002 // 8 // 2
    store = GraphStore(spark, str(tmp_path / "sized"), buckets=4).create(nodes, edges, "a")
    assert store.nodes().exceptAll(plain.nodes()).isEmpty() and store.edges().exceptAll(plain.edges()).isEmpty()
    assert store.edges().count() == plain.edges().count()
    monkeypatch.setattr(G, "GRAPH_TASK_BYTES", sizing.read_bytes(store.nodes(), store.edges()) // 60)
    tables = G.assembled_tables(store.nodes(), store.edges())
    assert tables.count() == 3000 and in_parts(tables) < 3000 // 8 // 2
    assert tables.where(F.size("columns") == 3).count() == 3000
    assert G.assembled_tables(store.nodes(), store.edges(), tables.select("key").where("key like '%/t7'")).count() == 1
