"""Schemas of the landed raw tables and of the metadata model, plus fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

S, TB = "schema_name", "table_name"
TABLE_KEYS = [S, TB]
# Block of line numbers, a column of DESCRIBE rows that were landed in buckets.
ROW_BLOCK = "row_block"

# --- landed raw tables -------------------------------------------------------

RAW_SCHEMAS = T.StructType([T.StructField(S, T.StringType())])

RAW_TABLES = T.StructType([
    T.StructField(S, T.StringType()),
    T.StructField(TB, T.StringType()),
    T.StructField("table_ord", T.LongType()),
    T.StructField("table_type", T.StringType()),
])

RAW_TABLE_DETAIL = T.StructType([
    T.StructField(S, T.StringType()),
    T.StructField(TB, T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("last_modified", T.TimestampNTZType()),
])

RAW_DESCRIBE = T.StructType([
    T.StructField(S, T.StringType()),
    T.StructField(TB, T.StringType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("col_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("comment", T.StringType()),
])

RAW_DESCRIBE_EXT = T.StructType([
    T.StructField(S, T.StringType()),
    T.StructField(TB, T.StringType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("col_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
])

RAW_COMMITS = T.StructType([
    T.StructField("table_id", T.LongType()),
    T.StructField("version", T.LongType()),
    T.StructField("commit_ts", T.TimestampNTZType()),
    T.StructField("action", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("format", T.StringType()),
])

PG_COLUMNS = T.StructType([
    T.StructField("catalog_name", T.StringType()),
    T.StructField("schemaname", T.StringType()),
    T.StructField(TB, T.StringType()),
    T.StructField("col_name", T.StringType()),
    T.StructField("col_type", T.StringType()),
    T.StructField("col_description", T.StringType()),
    T.StructField("col_sort_order", T.IntegerType()),
])

# Lines of commit files and rows of checkpoint files, with the paths of their files (see sources.commit_log).
RAW_LOG_LINES = "file_path string, line string"
RAW_LOG_CHECKPOINTS = (
    "file_path string, metaData struct<id:string,description:string,format:struct<provider:string>>, "
    "add struct<path:string,size:bigint,modificationTime:bigint>, remove struct<path:string,deletionTimestamp:bigint>")
TABLE_PATHS = f"table_path string, {S} string, {TB} string"

RAW_SCHEMAS_BY_NAME = {
    "raw_schemas": RAW_SCHEMAS,
    "raw_tables": RAW_TABLES,
    "raw_table_detail": RAW_TABLE_DETAIL,
    "raw_describe": RAW_DESCRIBE,
    "raw_describe_ext": RAW_DESCRIBE_EXT,
    "raw_commits": RAW_COMMITS,
    "raw_log_lines": RAW_LOG_LINES,
    "raw_log_checkpoints": RAW_LOG_CHECKPOINTS,
    "table_paths": TABLE_PATHS,
    "pg_columns": PG_COLUMNS,
}

# --- model --------------------------------------------------------------------

COLUMN = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("col_type", T.StringType()),
    T.StructField("sort_order", T.IntegerType()),
])

NODES = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("col_type", T.StringType()),
    T.StructField("sort_order", T.IntegerType()),
    T.StructField("is_view", T.BooleanType()),
])

EDGES = T.StructType([
    T.StructField("start_key", T.StringType()),
    T.StructField("end_key", T.StringType()),
    T.StructField("type", T.StringType()),
])

SEARCH_DOCS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("cluster", T.StringType()),
    T.StructField(S, T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("column_names", T.ArrayType(T.StringType())),
    T.StructField("column_descriptions", T.ArrayType(T.StringType())),
    T.StructField("last_updated_epoch", T.LongType()),
])

# --- fixed values (our own naming of the graph and record model) ---------------

# Node labels, top to bottom.
LABEL_DATABASE = "Database"
LABEL_CLUSTER = "Cluster"
LABEL_SCHEMA = "Schema"
LABEL_TABLE = "Table"
LABEL_COLUMN = "Column"

# Relationship types: parent -> child, named after the child.
EDGE_CLUSTER = "CLUSTER"
EDGE_SCHEMA = "SCHEMA"
EDGE_TABLE = "TABLE"
EDGE_COLUMN = "COLUMN"

# Record kinds of the emitted stream, in their per-table order.
KIND_TABLE_METADATA = "table_metadata"
KIND_LAST_UPDATED = "table_last_updated"

# Reject reasons, in the order they are tested.
REASON_NO_SCHEMA = "no_schema"
REASON_NO_DETAIL = "no_detail"
REASON_NO_COLUMNS = "no_columns"
REASON_KEPT = "kept"

# DESCRIBE EXTENDED: rows after the first row whose name contains this text are
# key/value properties.
DETAILED_TABLE_MARKER = "# Detailed Table"
