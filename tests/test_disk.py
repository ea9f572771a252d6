"""What stays on the disk: neither the shuffle files of a write, nor a merge's batches, nor tables that no query read."""

import glob
import os
import time
from datetime import datetime

from pyspark.sql import functions as F
from test_graph_store import graph

from metaweave.operators import search as Q
from metaweave.session import CLEANUP, checkpoint_root, materialize
from metaweave.sources.fixtures import LAKE_NAMES, Fixtures, LandedFixtures
from metaweave.sources.graph_store import GraphStore
from metaweave.sources.landed import land_describe, write_landed

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
         "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def source_tables(spark, root):
    """A few source tables, with keys that are null, repeated or without a partner."""
    day = datetime(2020, 1, 2)
    orders = [(k, k % 4, "FOP"[k % 3], day, ["5-LOW", "4-NOT SPECIFIED", "1-URGENT"][k // 2 % 3]) for k in [*range(40), 7, 8]] + [(None, 1, "F", day, "5-LOW")]
    lines = [(k, k * 3 + i, i, i + 1, float(i), 10.0 * i, 0.1, 0.2, "ANR"[i % 3], "OF"[k % 2], day) for k in [*range(44), 9] for i in range(k % 5)]
    lines.append((None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "O", day))
    events = [(i, day, i % 5, ["signup", "error", "click"][i % 3]) for i in range(30)]
    for name, rows, schema in (("nation", [(i, f"N{i}", i) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
                               ("customer", [(i, i) for i in range(4)], "c_custkey long, c_nationkey int"), ("orders", orders, ORDERS),
                               ("lineitem", lines, LINES), ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def shuffles(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in local for f in glob.glob(os.path.join(top, "*", "shuffle_*"))}


def batches(spark):
    return {x for x in os.listdir(f"{checkpoint_root(spark).removeprefix('file:')}/metaweave") if x.startswith("batch-")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("s").alias("schema_name"), F.col("id").cast("string").alias("table_name"), F.col("id").cast("int").alias("row_no"))
    before, setting = shuffles(spark), spark.conf.get(CLEANUP, None)
    materialize(rows.repartition(3, "table_name"), "disk")
    write_landed({"rows": rows}, str(tmp_path / "plain"))
    land_describe(rows, "disk_lines", str(tmp_path / "lines"))
    end = time.time() + 20  # Spark removes them beside the query
    while shuffles(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffles(spark) - before
    assert spark.conf.get(CLEANUP, None) == setting
    spark.sql("DROP TABLE disk_lines")


def test_batches_of_a_merge_go(spark, tmp_path):
    names = [f"t{i}" for i in range(20)]
    materialize(spark.range(1), "disk")  # the folder is there
    before = batches(spark)
    store = GraphStore(spark, str(tmp_path / "graph"), buckets=4).create(*graph(spark, names), "run_a")
    store.upsert(None, graph(spark, ["t3"])[1], "run_b")
    assert store.nodes().count() == 20 * 4 + 3 and store.edges().where("publish_tag = 'run_b'").count() == 6
    assert batches(spark) == before


def test_tables_are_landed_when_read(spark, tmp_path):
    given = source_tables(spark, tmp_path / "given")
    landed, plain = LandedFixtures(spark, given, str(tmp_path / "landed-a")), Fixtures(spark, given)
    raw = landed.lake_raw()
    assert sorted(os.listdir(tmp_path / "landed-a")) == sorted(LAKE_NAMES)
    for name in LAKE_NAMES:
        want = getattr(plain, name)
        assert want.count() and sorted(map(repr, raw[name].select(*want.columns).collect())) == sorted(map(repr, want.collect())), name
    # Each line of an order stands in each table of its key.
    assert landed.raw_describe.where("table_name = 't9' AND row_no < 1000").count() == 8 and landed.raw_describe.where("table_name = 't8' AND row_no < 1000").count() == 6
    assert landed.raw_commits.count() == plain.raw_commits.count()
    assert "raw_commits" in os.listdir(tmp_path / "landed-a") and landed.lake_raw()["raw_tables"] is raw["raw_tables"]
    spark.sql("DROP TABLE mw_describe_a")


def test_documents_below_the_bar_are_not_sorted(spark, tmp_path, monkeypatch):
    none = F.lit(None).cast("string")
    docs = spark.range(300).select(
        F.concat(F.lit("k"), "id").alias("key"), F.lit("t").alias("name"),
        F.when(F.col("id") % 2 == 0, F.repeat(F.lit("part "), (F.col("id") % 7 + 1).cast("int"))).alias("description"),
        F.array(F.lit("c")).alias("column_names"), F.array(none).alias("column_descriptions"))
    index = Q.search_index(docs, 4).write(str(tmp_path / "index"))
    spark.createDataFrame([(1, "part c"), (2, "t"), (None, "part")], "query_id int, text string").write.parquet(str(tmp_path / "queries"))
    queries = spark.read.parquet(str(tmp_path / "queries"))
    monkeypatch.setattr(Q, "MAX_CANDIDATES", 0)
    got = Q.search_rank(queries, index, k=10)
    assert "_mw_bar" in got._jdf.queryExecution().optimizedPlan().toString()
    # Without floors there is no bar.
    bare = Q.SearchIndex(index.postings, index.terms.withColumn("floors", F.filter("floors", lambda f: F.lit(False))), index.stats)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, Q.search_rank(queries, bare, k=10).collect()))
    assert got.count() == 30
