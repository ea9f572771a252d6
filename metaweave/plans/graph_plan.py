"""Entry points B and C: metadata records -> graph -> search documents -> index.

* B: relational catalog (or lake records) -> nodes / edges -> CSV hand-off ->
  upsert into the current graph, written to a new version folder.
* C: graph -> search documents -> JSON hand-off -> index behind an alias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.model import S, TB
from metaweave.operators import graph as G
from metaweave.operators import search as Q
from metaweave.operators.scope import relational_catalog
from metaweave.sources import exchange, index


def relational_records(pg_columns: DataFrame, schemas=("public",), database: str = "postgres",
                       cluster: str | None = None, catalog_as_cluster: bool = True) -> tuple[DataFrame, DataFrame]:
    """Relational catalog rows as (table_records, column_records) of the model."""
    cols = relational_catalog(pg_columns, schemas, database, cluster, catalog_as_cluster)
    tables = cols.select("db", "cluster", S, TB).distinct().withColumns({
        "description": F.lit(None).cast("string"),
        "is_view": F.lit(False),
    })
    return tables, cols


def publish_graph(
    spark: SparkSession,
    table_records: DataFrame,
    column_records: DataFrame,
    handoff_dir: str,
    publish_tag: str,
    current_nodes: DataFrame | None = None,
    current_edges: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write nodes / relationships as CSV, read them back, upsert into the current graph.

    Returns the merged (nodes, edges); the caller writes them to a new
    location (never over the folder it is reading).
    """
    nodes = G.graph_nodes(table_records, column_records)
    edges = G.graph_edges(table_records, column_records)
    exchange.write_graph_csv(nodes, edges, handoff_dir)
    nodes, edges = exchange.read_graph_csv(spark, handoff_dir)
    if current_nodes is None:
        current_nodes = nodes.limit(0)
    if current_edges is None:
        current_edges = edges.limit(0)
    merged_nodes = G.publish_upsert(current_nodes, nodes, publish_tag)
    merged_edges = G.publish_upsert(current_edges, edges, publish_tag, keys=("start_key", "end_key", "type"))
    return merged_nodes, merged_edges


def publish_search(
    spark: SparkSession,
    nodes: DataFrame,
    edges: DataFrame,
    last_updated: DataFrame | None,
    json_path: str,
    run_id: str | None = None,
    alias: str = "table_search_index",
) -> str:
    """Graph -> search documents -> JSON (overwrite) -> new index table behind ``alias``."""
    docs = Q.search_documents(nodes, edges, last_updated, entity_type="table")
    exchange.write_json(docs, json_path)
    return index.publish_index(exchange.read_json(spark, json_path), run_id=run_id, alias=alias)
