"""Items 18, 19, 21, 25: the property graph as node / edge tables.

Keys are ``/``-joined, escaped identity parts:
``db``, ``db/cluster``, ``db/cluster/schema``, ``…/table``, ``…/table/column``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.functions.exprs import node_key
from metaweave.functions.ordered import DEFAULT_BLOCK, block_of
from metaweave.functions.sizing import broadcast_if_small, tasks_for
from metaweave.model import (
    EDGE_CLUSTER,
    EDGE_COLUMN,
    EDGE_SCHEMA,
    EDGE_TABLE,
    LABEL_CLUSTER,
    LABEL_COLUMN,
    LABEL_DATABASE,
    LABEL_SCHEMA,
    LABEL_TABLE,
    S,
    TB,
)

# Identity parts of each level's key, top to bottom.
DB_PARTS = ("db",)
CLUSTER_PARTS = ("db", "cluster")
SCHEMA_PARTS = ("db", "cluster", S)
TABLE_PARTS = ("db", "cluster", S, TB)
COLUMN_PARTS = ("db", "cluster", S, TB, "col_name")


def _node(df: DataFrame, key, label, name, description=None, col_type=None, sort_order=None, is_view=None) -> DataFrame:
    def lit_or(c, t):
        return F.lit(None).cast(t) if c is None else (F.col(c) if isinstance(c, str) else c).cast(t)

    return df.select(
        key.alias("key"), F.lit(label).alias("label"), F.col(name).alias("name"),
        lit_or(description, "string").alias("description"), lit_or(col_type, "string").alias("col_type"),
        lit_or(sort_order, "int").alias("sort_order"), lit_or(is_view, "boolean").alias("is_view"),
    )


def graph_nodes(table_records: DataFrame, column_records: DataFrame) -> DataFrame:
    """Item 18: nodes (key, label, name, description, col_type, sort_order, is_view).

    Shared parents (database, cluster, schema) come from the distinct identity
    triples, a partial aggregate; tables and columns are keyed uniquely already.
    """
    parents = table_records.select("db", "cluster", S).distinct()
    nodes = [
        _node(parents.select("db").distinct(), node_key(*DB_PARTS), LABEL_DATABASE, "db"),
        _node(parents.select("db", "cluster").distinct(), node_key(*CLUSTER_PARTS), LABEL_CLUSTER, "cluster"),
        _node(parents, node_key(*SCHEMA_PARTS), LABEL_SCHEMA, S),
        _node(table_records, node_key(*TABLE_PARTS), LABEL_TABLE, TB, description="description", is_view="is_view"),
        _node(column_records, node_key(*COLUMN_PARTS), LABEL_COLUMN, "col_name", description="description",
              col_type="col_type", sort_order="sort_order"),
    ]
    out = nodes[0]
    for n in nodes[1:]:
        out = out.unionByName(n)
    return out


def graph_edges(table_records: DataFrame, column_records: DataFrame) -> DataFrame:
    """Item 19: parent -> child edges (start_key, end_key, type)."""
    parents = table_records.select("db", "cluster", S).distinct()

    def edge(df, start, end, typ):
        return df.select(start.alias("start_key"), end.alias("end_key"), F.lit(typ).alias("type"))

    return (
        edge(parents.select("db", "cluster").distinct(), node_key(*DB_PARTS), node_key(*CLUSTER_PARTS), EDGE_CLUSTER)
        .unionByName(edge(parents, node_key(*CLUSTER_PARTS), node_key(*SCHEMA_PARTS), EDGE_SCHEMA))
        .unionByName(edge(table_records, node_key(*SCHEMA_PARTS), node_key(*TABLE_PARTS), EDGE_TABLE))
        .unionByName(edge(column_records, node_key(*TABLE_PARTS), node_key(*COLUMN_PARTS), EDGE_COLUMN))
    )


def publish_upsert(current: DataFrame, batch: DataFrame, publish_tag: str, keys=("key",)) -> DataFrame:
    """Item 21: merge ``batch`` into ``current`` by key.

    New and matching keys take the batch's values and ``publish_tag``; all
    other rows stay as they were (tag included).  One shuffle on the key, into as many parts as the files' sizes ask for:
    a partial ``max_by`` of whole rows before it would sort each scan task's input and merge next to nothing.
    Applying the same batch twice equals applying it once.
    """
    keys = list(keys)
    cols = [c for c in current.columns if c != "publish_tag"]
    cur = current if "publish_tag" in current.columns else current.withColumn("publish_tag", F.lit(None).cast("string"))
    new = batch.select(*cols).withColumn("publish_tag", F.lit(publish_tag))
    values = [c for c in cols + ["publish_tag"] if c not in keys]
    both = cur.select(*keys, *values, F.lit(0).alias("_mw_src")).unionByName(
        new.select(*keys, *values, F.lit(1).alias("_mw_src")))
    merged = both.repartition(tasks_for(both), *keys).groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_mw_src")).alias("_v"))
    return merged.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def nodes_labelled(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.where(F.col("label") == label)


def edges_typed(edges: DataFrame, typ: str) -> DataFrame:
    return edges.where(F.col("type") == typ)


def table_part(key: Column | str) -> Column:
    """The key of the table that a node key lies under; a key above the tables stands for itself."""
    return F.substring_index(key, "/", len(TABLE_PARTS))


def parent_part(key: Column | str) -> Column:
    """The key without its last part."""
    c = F.col(key) if isinstance(key, str) else key
    return F.regexp_extract(c, "^(.*)/[^/]*$", 1)


def schema_context(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(_sk, schema_name, cluster, database) of every schema node: a few rows, read from the folders above the tables only."""
    schema = nodes_labelled(nodes, LABEL_SCHEMA).select(F.col("key").alias("_sk"), F.col("name").alias(S))
    hop_cluster = edges_typed(edges, EDGE_SCHEMA).select(F.col("end_key").alias("_sk"), F.col("start_key").alias("_ck"))
    cluster = nodes_labelled(nodes, LABEL_CLUSTER).select(F.col("key").alias("_ck"), F.col("name").alias("cluster"))
    hop_db = edges_typed(edges, EDGE_CLUSTER).select(F.col("end_key").alias("_ck"), F.col("start_key").alias("_dk"))
    db = nodes_labelled(nodes, LABEL_DATABASE).select(F.col("key").alias("_dk"), F.col("name").alias("database"))
    return (schema.join(hop_cluster, "_sk", "left").join(cluster, "_ck", "left").join(hop_db, "_ck", "left").join(db, "_dk", "left")
            .select("_sk", S, "cluster", "database"))


#: Values of the filter that is sent to the scans of a lookup: its size does not depend on the number of requests.
REQUEST_BITS = 18


def requested(rows: DataFrame, table_key: Column, keys: DataFrame, bits: int = REQUEST_BITS) -> DataFrame:
    """Rows whose table may be among ``keys``: a Bloom filter of one hash, as a join with at most ``2**bits`` broadcast numbers.

    Some rows of other tables pass; all rows of the requested ones do.
    """
    def place(key):
        return F.pmod(F.xxhash64(key), F.lit(1 << bits)).cast("int")

    wanted = keys.select(place(F.col("key")).alias("_mw_place")).distinct()
    return rows.withColumn("_mw_place", place(table_key)).join(F.broadcast(wanted), "_mw_place", "left_semi").drop("_mw_place")


#: Bytes of the graph's files for one task: keys repeat much and compress well, and a task sorts its rows several times.
GRAPH_TASK_BYTES = 1 << 20


def graph_tasks(nodes: DataFrame, edges: DataFrame) -> int:
    return tasks_for(nodes, edges, task_bytes=GRAPH_TASK_BYTES)


#: Schema nodes that are sent to all tasks; beyond it the join is left to the planner.
MAX_SCHEMAS = 100_000


def assembled_tables(nodes: DataFrame, edges: DataFrame, keys: DataFrame | None = None, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Every table node with its parents and columns, read from the graph:
    (key, name, description, is_view, schema_name, cluster, database, columns), columns in order.

    A node's parent is decoded from its path key and checked against the edges: tables and columns meet their edges in
    one join, so nodes and edges below the schemas are scanned once each.  From there the plan is linear: columns gather
    per (table, block of positions) with their table's own row, then blocks per table.  A column without its edge, or
    whose table has no node, is left out; a table without an edge to a schema has no parents.  ``keys`` (a ``key``
    column) restricts the tables: nodes and edges of others are filtered out before they are exchanged.
    """
    below = nodes.where(F.col("label").isin(LABEL_TABLE, LABEL_COLUMN)).select("label", "key", "name", "description", "col_type", "sort_order", "is_view")
    links = edges.where(F.col("type").isin(EDGE_TABLE, EDGE_COLUMN)).select("type", "start_key", "end_key")
    if keys is not None:
        below = requested(below, table_part("key"), keys)
        links = requested(links, table_part("end_key"), keys)
    links = links.where(F.col("start_key") == parent_part("end_key")).select(F.col("end_key").alias("key"), F.col("type").alias("_type"), F.col("start_key").alias("_up"))
    column = F.col("label") == LABEL_COLUMN
    hop = F.when(column, EDGE_COLUMN).otherwise(EDGE_TABLE)
    tasks = graph_tasks(nodes, edges)
    below = below.withColumn("_type", hop).repartition(tasks, "key", "_type")
    linked = below.join(links.repartition(tasks, "key", "_type"), ["key", "_type"], "left").where(~column | F.col("_up").isNotNull())
    placed = linked.select(
        F.when(column, F.col("_up")).otherwise(F.col("key")).alias("key"),
        F.when(column, F.coalesce(block_of("sort_order", block_size), F.lit(0))).otherwise(0).alias("_b"),
        F.when(~column, F.struct("name", "description", "is_view", F.col("_up").alias("_sk"))).alias("_t"),
        F.when(column, F.struct(F.col("sort_order").alias("o"), F.col("name").alias("n"), "description", "col_type")).alias("_c"))
    # Dealt before the aggregates: lists gain nothing from partial ones, which would sort all that a task reads.
    # max, not first: a table has one node, and a maximum is the same in every run.
    parts = placed.repartition(tasks, "key", "_b").groupBy("key", "_b").agg(F.max("_t").alias("_t"), F.array_sort(F.collect_list("_c")).alias("_cs"))
    tables = parts.repartition(tasks, "key").groupBy("key").agg(
        F.max("_t").alias("_t"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_cs"))), lambda p: p["_cs"])).alias("_cs"))
    found = tables.where(F.col("_t").isNotNull()).select(
        "key", "_t.*", F.transform("_cs", lambda c: F.struct(c["n"].alias("name"), c["description"], c["col_type"], c["o"].alias("sort_order"))).alias("columns"))
    if keys is not None:  # one row a table here; the filter above may have let others through
        found = found.join(keys.select("key"), "key", "left_semi")
    # Broadcast, the schemas leave the tables where they are, dealt by key.
    return found.join(broadcast_if_small(schema_context(nodes, edges), MAX_SCHEMAS), "_sk", "left").drop("_sk")


def graph_lookup(nodes: DataFrame, edges: DataFrame, keys: DataFrame, last_updated: DataFrame | None = None) -> DataFrame:
    """Item 25: one row per requested table key: ``found``, the table node, its
    schema / cluster / database names, ``columns_text`` (``sort_order:name:col_type``
    in column order) and ``last_updated_epoch``.

    The request table may be as large as the graph.  What it asks for reaches the scans of nodes and edges as a filter of
    bounded size (:func:`requested`), so a small request exchanges little of a large graph.
    """
    req = keys.select("key").distinct()
    tasks = graph_tasks(nodes, edges)  # as the tables are dealt, so that they meet requests and times where they are
    found = assembled_tables(nodes, edges, req).withColumnRenamed("name", TB)
    text = F.transform("columns", lambda c: F.concat_ws(":", c["sort_order"].cast("string"), c["name"], F.coalesce(c["col_type"], F.lit(""))))
    found = found.withColumn("columns_text", F.when(F.size("columns") > 0, F.array_join(text, "|"))).drop("columns")
    out = req.repartition(tasks, "key").join(found, "key", "left")
    if last_updated is not None:
        lu = last_updated.select(node_key(*TABLE_PARTS).alias("key"),
                                 F.col("last_updated_time_epoch").alias("last_updated_epoch"))
        out = out.join(lu.repartition(tasks, "key"), "key", "left")
    return out.withColumn("found", F.col(TB).isNotNull())
