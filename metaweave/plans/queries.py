"""

Each takes ``(spark, sf_dir)``, derives the metadata fixtures from the
parquet tables in ``sf_dir`` and returns a flat DataFrame whose column names
match the DuckDB oracle in :mod:`metaweave.plans.oracle`.  Nested arrays are
emitted as delimited strings so that results hash the same in both engines.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.functions.exprs import node_key
from metaweave.model import S, TABLE_KEYS, TB
from metaweave.operators import commit_log as L
from metaweave.operators import describe as D
from metaweave.operators import detail as X
from metaweave.operators import graph as G
from metaweave.operators import records as R
from metaweave.operators import search as Q
from metaweave.operators.scope import relational_catalog, scope_exclude, scope_include
from metaweave.plans.graph_plan import publish_graph, relational_records
from metaweave.plans.lake import LakeCatalog, lake_catalog
from metaweave.session import materialize, scratch_path
from metaweave.sources import commit_log, exchange, index
from metaweave.sources.fixtures import Fixtures, landed_fixtures
from metaweave.sources.graph_store import GraphStore

# Identity of the lake catalog in every query.
DATABASE = "delta"
CLUSTER = "main"
TOP_K = 10
# Buckets of the stages' graph: a few files a label at the test scales.
GRAPH_BUCKETS = 16
TERM_BUCKETS = 64

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    """The fixture tables, landed once per application (see ``landed_fixtures``)."""
    return landed_fixtures(spark, sf_dir)


def _lake(spark: SparkSession, sf_dir: str) -> tuple[Fixtures, LakeCatalog]:
    fx = _fx(spark, sf_dir)
    return fx, lake_catalog(fx.lake_raw(), cluster=CLUSTER, database=DATABASE)


class Stages:
    """The published output of each pipeline job, written once per application
    and data directory, as the scheduled jobs hand over in the reference:
    lake catalog -> graph -> search documents -> search index.

    A query about a later operator reads the stage before it and runs only
    its own operator on it.  Every stage is derived by Spark from the given
    tables, so its size grows with them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.fx = _fx(spark, sf_dir)

    @cached_property
    def lake(self) -> LakeCatalog:
        """Lake pipeline with its column table and checked table list written."""
        return lake_catalog(self.fx.lake_raw(), cluster=CLUSTER, database=DATABASE, materialize=True)

    @cached_property
    def graph(self) -> tuple[DataFrame, DataFrame]:
        store = self.new_store()
        return store.nodes().drop("publish_tag"), store.edges().drop("publish_tag")

    def new_store(self) -> GraphStore:
        tables, columns = self.lake.table_records, self.lake.column_records
        store = GraphStore(self.spark, scratch_path(self.spark, "graph"), buckets=GRAPH_BUCKETS)
        return store.create(G.graph_nodes(tables, columns), G.graph_edges(tables, columns), "run_a")

    @cached_property
    def merged_store(self) -> GraphStore:
        """A store of its own for the merge queries; merging the same batch again leaves it as it is."""
        return self.new_store()

    @cached_property
    def last_updated(self) -> DataFrame:
        return materialize(self.lake.last_updated, "last-updated")

    @cached_property
    def docs(self) -> DataFrame:
        nodes, edges = self.graph
        return materialize(Q.search_documents(nodes, edges, self.last_updated), "search-docs")

    @cached_property
    def index(self) -> Q.SearchIndex:
        return Q.search_index(self.docs, TERM_BUCKETS).write(scratch_path(self.spark, "search-index"))

    @cached_property
    def queries(self) -> DataFrame:
        return materialize(search_queries(self.fx), "queries")

    def build_all(self) -> None:
        self.index, self.queries, self.merged_store  # noqa: B018 - builds every stage before them


_STAGES: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _STAGES:
        _STAGES[key] = Stages(spark, sf_dir)
    return _STAGES[key]


# -- 2.1 sources and scope ---------------------------------------------------------

def q_scope_exclude(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return scope_exclude(fx.raw_schemas, fx.raw_tables, fx.exclude_list).select(*TABLE_KEYS)


def q_scope_include(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return scope_include(fx.raw_schemas, fx.raw_tables, fx.schema_list, fx.exclude_list).select(*TABLE_KEYS)


def q_relational_catalog(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return relational_catalog(fx.pg_columns, ["public"]).select(
        "db", "cluster", S, TB, "col_name", "col_type", "description",
        F.col("sort_order").alias("col_sort_order"))


def q_commit_log_detail(spark, sf_dir):
    return X.commit_log_detail(_fx(spark, sf_dir).raw_commits)


def _replayed(spark, sf_dir) -> DataFrame:
    fx = _fx(spark, sf_dir)
    return L.replay_commit_log(commit_log.parse_landed_lines(fx.raw_log_lines), commit_log.checkpoint_rows(fx.raw_log_checkpoints))


def q_commit_log_replay(spark, sf_dir):
    return _replayed(spark, sf_dir).withColumn("last_modified_ms", F.unix_millis("last_modified")).drop("last_modified")


def q_lake_from_commit_log(spark, sf_dir):
    # Entry point A with details from the logs: every entry of the listing with its reason.
    fx = _fx(spark, sf_dir)
    detail = L.replayed_table_detail(_replayed(spark, sf_dir), fx.table_paths)
    lake = lake_catalog(fx.lake_raw(), cluster=CLUSTER, database=DATABASE, table_detail=detail)
    return lake.checked.where(~F.col("is_view")).select(
        *TABLE_KEYS, "format", "description", "n_columns", "reason", F.unix_millis("last_modified").alias("last_modified_ms"))


# -- 2.2 DESCRIBE interpretation -------------------------------------------------

def q_describe_sections(spark, sf_dir):
    return D.describe_sections(_fx(spark, sf_dir).raw_describe)


def q_describe_columns(spark, sf_dir):
    return D.describe_columns(D.annotate_describe(_fx(spark, sf_dir).raw_describe)).drop("first_order")


def q_partition_columns(spark, sf_dir):
    return D.partition_columns(D.annotate_describe(_fx(spark, sf_dir).raw_describe)).drop("first_order")


def q_partition_columns_name_first(spark, sf_dir):
    return D.partition_columns(D.annotate_describe(_fx(spark, sf_dir).raw_describe), match=D.MATCH_NAME_FIRST).drop("first_order")


def q_describe_properties(spark, sf_dir):
    return D.describe_properties(_fx(spark, sf_dir).raw_describe_ext)


# -- 2.3 assembly --------------------------------------------------------------------

def q_route_kind(spark, sf_dir):
    return X.route_kind(_fx(spark, sf_dir).raw_tables).select(*TABLE_KEYS, "is_view")


def q_attach_details(spark, sf_dir):
    # ``scraped`` precedes every written stage, so this runs the operator over the landed tables.
    lake = stages(spark, sf_dir).lake
    return lake.scraped.select(*TABLE_KEYS, "is_view", "has_detail", "format", "description", "last_modified")


def q_drop_unscrapable(spark, sf_dir):
    lake = stages(spark, sf_dir).lake
    return X.drop_unscrapable(lake.scraped, lake.columns).select(*TABLE_KEYS, "is_view", "n_columns", "reason")


def q_delta_filter(spark, sf_dir):
    lake = stages(spark, sf_dir).lake
    return X.delta_filter(X.kept(lake.checked)).select(*TABLE_KEYS, "format")


def q_table_metadata(spark, sf_dir):
    lake = stages(spark, sf_dir).lake
    tables, columns = R.table_metadata(lake.delta, lake.columns, DATABASE, CLUSTER)
    return tables.join(R.columns_text(columns), TABLE_KEYS, "left").select(
        "db", "cluster", S, TB, "description", "is_view", "columns_text", "n_columns")


def q_table_metadata_nested(spark, sf_dir):
    # The nested record: each position of a record's column list, as it stands in the array.
    lake = stages(spark, sf_dir).lake
    nested = R.nest_columns(*R.table_metadata(lake.delta, lake.columns, DATABASE, CLUSTER))
    return nested.select("db", "cluster", S, TB, "is_view", F.posexplode("columns").alias("position", "c")).select(
        "db", "cluster", S, TB, "is_view", "position", "c.name", "c.description", "c.col_type", "c.sort_order")


def q_kept_records_all_formats(spark, sf_dir):
    # Items 12-13 with delta_only=False: every kept table or view, whatever its format.
    lake = stages(spark, sf_dir).lake
    tables, _ = R.table_metadata(X.delta_filter(lake.kept, delta_only=False), lake.columns, DATABASE, CLUSTER)
    return tables.select("db", "cluster", S, TB, "description", "is_view", "n_columns")


def q_table_last_updated(spark, sf_dir):
    return R.table_last_updated(stages(spark, sf_dir).lake.table_records)


def q_emit_records(spark, sf_dir):
    lake = stages(spark, sf_dir).lake
    return R.number_records(R.emit_records(lake.table_records)).select("emit_ord", "record_kind", S, TB)


def q_table_signature(spark, sf_dir):
    # Over the published column snapshot (items 5-7 of every described table).
    return R.table_signature(stages(spark, sf_dir).lake.columns)


def q_column_diff(spark, sf_dir):
    # Snapshot A is the published column table; snapshot B the FIXTURES rule applied to it.
    st = stages(spark, sf_dir)
    columns_a = R.with_attributes(st.lake.columns)
    return R.column_diff(columns_a, st.fx.columns_b(columns_a))


# -- 2.4 graph, search, sinks ----------------------------------------------------------

def _records(spark, sf_dir):
    lake = stages(spark, sf_dir).lake
    return lake.table_records, lake.column_records


def q_graph_nodes(spark, sf_dir):
    tables, columns = _records(spark, sf_dir)
    return G.graph_nodes(tables, columns).select("key", "label", "name", "description")


def q_graph_edges(spark, sf_dir):
    tables, columns = _records(spark, sf_dir)
    return G.graph_edges(tables, columns)


def q_csv_exchange(spark, sf_dir):
    # Each query hands over its own half of the graph.
    out = scratch_path(spark, "graph-csv")
    exchange.write_nodes_csv(G.graph_nodes(*_records(spark, sf_dir)), out)
    return exchange.read_nodes_csv(spark, out)


def q_csv_exchange_edges(spark, sf_dir):
    out = scratch_path(spark, "graph-csv")
    exchange.write_edges_csv(G.graph_edges(*_records(spark, sf_dir)), out)
    return exchange.read_edges_csv(spark, out)


def _batch_b(spark, sf_dir) -> tuple[Stages, DataFrame, DataFrame]:
    """The stages, and the records of the second column snapshot."""
    st = stages(spark, sf_dir)
    tables, columns = st.lake.table_records, st.lake.columns
    return st, tables, R.column_records_of(st.fx.columns_b(columns), tables, DATABASE, CLUSTER)


def q_publish_upsert(spark, sf_dir):
    st, tables, columns = _batch_b(spark, sf_dir)
    st.merged_store.upsert(G.graph_nodes(tables, columns), None, "run_b")
    return st.merged_store.nodes().select("key", "label", "description", "col_type", "publish_tag")


def q_publish_upsert_edges(spark, sf_dir):
    st, tables, columns = _batch_b(spark, sf_dir)
    st.merged_store.upsert(None, G.graph_edges(tables, columns), "run_b")
    return st.merged_store.edges()


def _flat_docs(docs: DataFrame) -> DataFrame:
    return docs.select(
        "key", "database", "cluster", S, "name", "description",
        F.nullif(F.array_join("column_names", ","), F.lit("")).alias("column_names"),
        F.nullif(F.array_join("column_descriptions", "|"), F.lit("")).alias("column_descriptions"),
        "last_updated_epoch",
    )


def q_search_documents(spark, sf_dir):
    st = stages(spark, sf_dir)
    nodes, edges = st.graph
    return _flat_docs(Q.search_documents(nodes, edges, st.last_updated))


def q_json_exchange(spark, sf_dir):
    out = scratch_path(spark, "search-json")
    exchange.write_json(stages(spark, sf_dir).docs, out)
    return _flat_docs(exchange.read_json(spark, out))


def q_publish_index(spark, sf_dir):
    docs = stages(spark, sf_dir).docs
    alias = "metaweave_table_search_index"
    index.publish_index(docs, alias=alias)
    index.publish_index(docs, alias=alias)
    return _flat_docs(index.read_index(spark, alias))


def q_graph_lookup(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    st = stages(spark, sf_dir)
    nodes, edges = st.graph
    keys = fx.raw_tables.select(node_key(F.lit(DATABASE), F.lit(CLUSTER), S, TB).alias("key"))
    return G.graph_lookup(nodes, edges, keys, st.last_updated).select(
        "key", "found", S, "columns_text", "last_updated_epoch")


def q_search_index(spark, sf_dir):
    """Every term of every field of every document with its positions."""
    postings = Q.search_index(stages(spark, sf_dir).docs).postings
    return postings.select("term", "key", "tf", "doc_len", F.inline("fields")).select(
        "term", "key", "tf", "doc_len", "field", F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"))


def q_relational_graph(spark, sf_dir):
    # Entry points B and C in one job: relational catalog -> graph -> CSV -> upsert into an empty graph -> documents -> JSON.
    tables, columns = relational_records(_fx(spark, sf_dir).pg_columns)
    nodes, edges = publish_graph(spark, tables, columns, scratch_path(spark, "relational-csv"), "run_a")
    out = scratch_path(spark, "relational-json")
    exchange.write_json(Q.search_documents(nodes, edges), out)
    return _flat_docs(exchange.read_json(spark, out))


def search_queries(fx: Fixtures) -> DataFrame:
    """One query per nation, built from its customers: a rare term (the
    smallest customer key), a column name and two common words."""
    cust = fx.source("customer").select("c_custkey", "c_nationkey")
    nation = fx.source("nation").select("n_nationkey", "n_regionkey")
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey)
        .groupBy("n_nationkey", "n_regionkey")
        .agg(F.min("c_custkey").alias("_c"))
        .select(
            F.col("n_nationkey").alias("query_id"),
            F.concat_ws(" ", F.lit("customer"), F.col("_c").cast("string"),
                        F.concat(F.lit("c"), (F.col("n_regionkey") + 1).cast("string")), F.lit("part")).alias("text"),
        )
    )


def q_search_rank(spark, sf_dir):
    st = stages(spark, sf_dir)
    return Q.search_rank(st.queries, st.index, k=TOP_K)


QUERIES: dict[str, Query] = {
    "scope_exclude": q_scope_exclude,
    "scope_include": q_scope_include,
    "relational_catalog": q_relational_catalog,
    "commit_log_detail": q_commit_log_detail,
    "commit_log_replay": q_commit_log_replay,
    "lake_from_commit_log": q_lake_from_commit_log,
    "describe_sections": q_describe_sections,
    "describe_columns": q_describe_columns,
    "partition_columns": q_partition_columns,
    "describe_properties": q_describe_properties,
    "route_kind": q_route_kind,
    "attach_details": q_attach_details,
    "drop_unscrapable": q_drop_unscrapable,
    "delta_filter": q_delta_filter,
    "table_metadata": q_table_metadata,
    "table_metadata_nested": q_table_metadata_nested,
    "table_last_updated": q_table_last_updated,
    "emit_records": q_emit_records,
    "table_signature": q_table_signature,
    "column_diff": q_column_diff,
    "graph_nodes": q_graph_nodes,
    "graph_edges": q_graph_edges,
    "csv_exchange": q_csv_exchange,
    "csv_exchange_edges": q_csv_exchange_edges,
    "publish_upsert": q_publish_upsert,
    "publish_upsert_edges": q_publish_upsert_edges,
    "search_documents": q_search_documents,
    "json_exchange": q_json_exchange,
    "publish_index": q_publish_index,
    "graph_lookup": q_graph_lookup,
    "relational_graph": q_relational_graph,
    "search_index": q_search_index,
    "search_rank": q_search_rank,
    "partition_columns_name_first": q_partition_columns_name_first,
    "kept_records_all_formats": q_kept_records_all_formats,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which Delta tables were last updated when, and what are their columns?"""
    _, lake = _lake(spark, sf_dir)
    text = R.columns_text(lake.column_records)
    lu = lake.last_updated.select(*TABLE_KEYS, "last_updated_time_epoch")
    return (
        lake.table_records.join(text, TABLE_KEYS, "left").join(lu, TABLE_KEYS, "left")
        .select("db", "cluster", S, TB, "description", "is_view", "n_columns", "columns_text",
                "last_updated_time_epoch")
    )
