"""Incremental refresh: two landed DESCRIBE batches upserted into the published graph."""

from metaweave.model import RAW_DESCRIBE, RAW_DESCRIBE_EXT, RAW_SCHEMAS, RAW_TABLE_DETAIL, RAW_TABLES
from metaweave.session import scratch_path
from metaweave.streaming.refresh import EDGES_ALIAS, NODES_ALIAS, refresh_graph_stream


def test_two_batches_upsert_into_graph(spark):
    static = {
        "raw_schemas": spark.createDataFrame([("s",)], RAW_SCHEMAS),
        "raw_tables": spark.createDataFrame([("s", "a", 1, "MANAGED"), ("s", "b", 2, "MANAGED")], RAW_TABLES),
        "raw_table_detail": spark.createDataFrame(
            [("s", "a", "delta", "table a", None), ("s", "b", "delta", None, None)], RAW_TABLE_DETAIL),
        "raw_describe_ext": spark.createDataFrame([], RAW_DESCRIBE_EXT),
    }
    landing = scratch_path(spark, "landing")
    spark.createDataFrame([("s", "a", 1, "x", "int", "first")], RAW_DESCRIBE).write.parquet(f"{landing}/run1")
    ckpt = scratch_path(spark, "refresh-ckpt")
    q = refresh_graph_stream(spark, f"{landing}/*", static, cluster="c", checkpoint=ckpt)
    q.awaitTermination()
    first = {r.key: r for r in spark.table(NODES_ALIAS).collect()}
    assert first["delta/c/s/a/x"].description == "first"
    assert "delta/c/s/b" not in first

    spark.createDataFrame([("s", "a", 1, "x", "int", "second"), ("s", "b", 1, "y", "string", "")],
                          RAW_DESCRIBE).write.parquet(f"{landing}/run2")
    # Same checkpoint: only the new landing is processed.
    q2 = refresh_graph_stream(spark, f"{landing}/*", static, cluster="c", checkpoint=ckpt)
    q2.awaitTermination()
    second = {r.key: r for r in spark.table(NODES_ALIAS).collect()}
    assert second["delta/c/s/a/x"].description == "second"
    assert second["delta/c/s/b/y"].publish_tag == "batch-1"
    assert {"delta", "delta/c", "delta/c/s", "delta/c/s/a", "delta/c/s/b"} <= set(second)
    edges = spark.table(EDGES_ALIAS).collect()
    assert all(e.start_key in second and e.end_key in second for e in edges)
