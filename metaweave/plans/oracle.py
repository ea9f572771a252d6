"""DuckDB oracle SQL for every registered query.

The fixture CTEs are the derivation rules of ``FIXTURES.md``; the operator
CTEs restate each operator's semantics in plain SQL (windows and GROUP BY,
no block splitting).  Column names and types match the Spark queries.
"""

from __future__ import annotations

DATABASE = "delta"
CLUSTER = "main"


def esc(expr: str) -> str:
    return f"replace(replace({expr}, '%', '%25'), '/', '%2F')"


def key(*parts: str) -> str:
    return "concat_ws('/', " + ", ".join(esc(p) for p in parts) + ")"


MARKER = "(coalesce({c}, '') = '' OR {c} LIKE '%#%')"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_schemas": ((), "SELECT n_name AS schema_name FROM nation"),
    "raw_tables": ((), """
SELECT n_name AS schema_name, concat('t', CAST(o_orderkey AS VARCHAR)) AS table_name, o_orderkey AS table_ord,
 CASE o_orderpriority WHEN '5-LOW' THEN 'VIEW' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'MANAGED' END AS table_type
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "raw_table_detail": (("raw_tables",), """
SELECT t.schema_name, t.table_name,
 CASE o_orderstatus WHEN 'F' THEN 'delta' WHEN 'O' THEN 'DELTA' ELSE 'parquet' END AS format,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('orders of customer ', CAST(o_custkey AS VARCHAR)) END AS description,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1500 MILLISECONDS END AS last_modified
FROM orders JOIN raw_tables t ON o_orderkey = t.table_ord
WHERE t.table_type = 'MANAGED' AND o_orderkey % 13 <> 0"""),
    "raw_describe": (("raw_tables",), """
WITH c AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_partkey,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                     l_quantity, l_shipdate, l_discount, l_tax) AS rn FROM lineitem),
r AS (SELECT l_orderkey AS k, CAST(rn AS INT) AS row_no, concat('c', CAST(l_linenumber AS VARCHAR)) AS col_name,
   CASE l_returnflag WHEN 'A' THEN 'bigint' WHEN 'N' THEN 'string' ELSE 'decimal(10,2)' END AS data_type,
   CASE WHEN l_linestatus = 'O' THEN '' ELSE concat('part ', CAST(l_partkey AS VARCHAR)) END AS comment FROM c
  UNION ALL SELECT o_orderkey, 1001, '# Partition Information', '', '' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 1002, '# col_name', 'data_type', 'comment' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 1003, 'c1', 'bigint', '' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 1001, '', '', '' FROM orders WHERE o_orderkey % 3 = 1
  UNION ALL SELECT o_orderkey, 1002, '# Partitioning', '', '' FROM orders WHERE o_orderkey % 3 = 1
  UNION ALL SELECT o_orderkey, 1003, 'Part 0', 'c2', '' FROM orders WHERE o_orderkey % 3 = 1)
SELECT t.schema_name, t.table_name, r.row_no, r.col_name, r.data_type, r.comment
FROM r JOIN raw_tables t ON r.k = t.table_ord"""),
    "raw_describe_ext": (("raw_tables",), """
WITH v AS (SELECT * FROM raw_tables WHERE (table_type IS NULL OR table_type = 'VIEW') AND table_ord % 17 <> 0)
SELECT schema_name, table_name, 1 AS row_no, 'c1' AS col_name, 'bigint' AS data_type FROM v
UNION ALL SELECT schema_name, table_name, 2, '', '' FROM v
UNION ALL SELECT schema_name, table_name, 3, '# Detailed Table Information', '' FROM v
UNION ALL SELECT schema_name, table_name, 4, 'Type', 'VIEW' FROM v
UNION ALL SELECT schema_name, table_name, 5, 'Comment', concat('view ', table_name) FROM v
UNION ALL SELECT schema_name, table_name, 6, 'description', concat('old ', table_name) FROM v WHERE table_ord % 5 = 0
UNION ALL SELECT schema_name, table_name, 7, 'description', concat('desc ', table_name) FROM v WHERE table_ord % 5 = 0
UNION ALL SELECT schema_name, table_name, 8, 'format', 'Delta' FROM v WHERE table_ord % 4 = 0"""),
    "raw_commits": ((), """
SELECT user_id AS table_id, event_id AS version, ts AS commit_ts, event_type AS action,
 CASE WHEN event_type IN ('signup', 'error') THEN concat('rev ', CAST(event_id AS VARCHAR)) END AS description,
 CASE WHEN event_type = 'signup' THEN 'delta' WHEN event_type = 'error' THEN 'parquet' END AS format FROM events"""),
    "pg_columns": ((), """
SELECT 'wh' AS catalog_name,
 CASE WHEN p_size % 3 = 0 THEN 'public' WHEN p_size % 3 = 1 THEN 'audit' ELSE 'staging' END AS schemaname,
 p_type AS table_name, concat('col', CAST(p_partkey AS VARCHAR)) AS col_name,
 CASE WHEN p_size < 25 THEN 'integer' ELSE 'text' END AS col_type, p_name AS col_description,
 CAST(p_partkey AS INT) AS col_sort_order FROM part"""),
    "exclude_list": ((), "SELECT n_name AS schema_name FROM nation WHERE n_regionkey = 3"),
    "schema_list": ((), "SELECT n_name AS schema_name FROM nation WHERE n_regionkey = 1"),
    # --- operators ---
    "scoped": (("raw_schemas", "raw_tables"), """
SELECT * FROM raw_tables WHERE schema_name IN (SELECT schema_name FROM raw_schemas)"""),
    "sec": (("raw_describe",), f"""
SELECT d.*, CASE WHEN {MARKER.format(c='d.col_name')} THEN 'marker'
   WHEN f.first_marker IS NOT NULL AND d.row_no > f.first_marker THEN 'partition' ELSE 'column' END AS section
FROM raw_describe d JOIN (
  SELECT schema_name, table_name, min(CASE WHEN {MARKER.format(c='col_name')} THEN row_no END) AS first_marker
  FROM raw_describe GROUP BY schema_name, table_name) f
ON d.schema_name = f.schema_name AND d.table_name = f.table_name"""),
    "colrows": (("sec",), """
SELECT *, CAST(row_number() OVER (PARTITION BY schema_name, table_name ORDER BY row_no) - 1 AS INT) AS sort_order
FROM sec WHERE section = 'column'"""),
    "cols": (("colrows",), """
SELECT schema_name, table_name, col_name, v.data_type AS data_type, v.description AS description,
  v.sort_order AS sort_order, first_order
FROM (SELECT schema_name, table_name, col_name, min(sort_order) AS first_order,
        max_by({'data_type': data_type, 'description': NULLIF(comment, ''), 'sort_order': sort_order}, row_no) AS v
      FROM colrows GROUP BY schema_name, table_name, col_name)"""),
    "pcols": (("sec", "cols"), """
SELECT c.*, h.target IS NOT NULL AS is_partition
FROM cols c LEFT JOIN (
  SELECT DISTINCT p.schema_name, p.table_name, coalesce(ct.col_name, cn.col_name) AS target
  FROM (SELECT DISTINCT schema_name, table_name, col_name, data_type FROM sec WHERE section = 'partition') p
  LEFT JOIN cols ct ON ct.schema_name = p.schema_name AND ct.table_name = p.table_name AND ct.col_name = p.data_type
  LEFT JOIN cols cn ON cn.schema_name = p.schema_name AND cn.table_name = p.table_name AND cn.col_name = p.col_name
) h ON h.schema_name = c.schema_name AND h.table_name = c.table_name AND h.target = c.col_name"""),
    "pcols_name_first": (("sec", "cols"), """
SELECT c.*, h.target IS NOT NULL AS is_partition
FROM cols c LEFT JOIN (
  SELECT DISTINCT p.schema_name, p.table_name, coalesce(cn.col_name, ct.col_name) AS target
  FROM (SELECT DISTINCT schema_name, table_name, col_name, data_type FROM sec WHERE section = 'partition') p
  LEFT JOIN cols ct ON ct.schema_name = p.schema_name AND ct.table_name = p.table_name AND ct.col_name = p.data_type
  LEFT JOIN cols cn ON cn.schema_name = p.schema_name AND cn.table_name = p.table_name AND cn.col_name = p.col_name
) h ON h.schema_name = c.schema_name AND h.table_name = c.table_name AND h.target = c.col_name"""),
    "props": (("raw_describe_ext",), """
SELECT e.schema_name, e.table_name, e.col_name AS prop_key, max_by({'v': e.data_type}, e.row_no).v AS prop_value
FROM raw_describe_ext e JOIN (
  SELECT schema_name, table_name, min(CASE WHEN col_name LIKE '%# Detailed Table%' THEN row_no END) AS m
  FROM raw_describe_ext GROUP BY schema_name, table_name) f
ON e.schema_name = f.schema_name AND e.table_name = f.table_name
WHERE e.row_no > f.m
GROUP BY e.schema_name, e.table_name, e.col_name"""),
    "vdet": (("raw_describe_ext", "props"), """
SELECT p.schema_name, p.table_name,
  max(CASE WHEN q.prop_key = 'format' THEN q.prop_value END) AS format,
  max(CASE WHEN q.prop_key = 'description' THEN q.prop_value END) AS description
FROM (SELECT DISTINCT schema_name, table_name FROM raw_describe_ext) p
LEFT JOIN props q ON q.schema_name = p.schema_name AND q.table_name = p.table_name
GROUP BY p.schema_name, p.table_name"""),
    "scraped": (("scoped", "raw_table_detail", "vdet"), """
SELECT r.schema_name, r.table_name, r.table_ord, r.is_view,
  CASE WHEN r.is_view THEN v.schema_name IS NOT NULL ELSE d.schema_name IS NOT NULL END AS has_detail,
  CASE WHEN r.is_view THEN v.format ELSE d.format END AS format,
  CASE WHEN r.is_view THEN v.description ELSE d.description END AS description,
  CASE WHEN r.is_view THEN NULL ELSE d.last_modified END AS last_modified
FROM (SELECT *, (coalesce(table_type, '') = '' OR lower(table_type) = 'view') AS is_view FROM scoped) r
LEFT JOIN raw_table_detail d ON d.schema_name = r.schema_name AND d.table_name = r.table_name
LEFT JOIN vdet v ON v.schema_name = r.schema_name AND v.table_name = r.table_name"""),
    "checked": (("scraped", "pcols"), """
SELECT s.*, CAST(coalesce(n.n_columns, 0) AS INT) AS n_columns,
  CASE WHEN s.schema_name IS NULL THEN 'no_schema' WHEN NOT s.has_detail THEN 'no_detail'
       WHEN coalesce(n.n_columns, 0) = 0 THEN 'no_columns' ELSE 'kept' END AS reason
FROM scraped s LEFT JOIN (
  SELECT schema_name, table_name, count(*) AS n_columns FROM pcols GROUP BY schema_name, table_name) n
ON n.schema_name = s.schema_name AND n.table_name = s.table_name"""),
    "delta": (("checked",), """
SELECT * FROM checked WHERE reason = 'kept' AND coalesce(lower(format) = 'delta', false)"""),
    "trec": (("delta",), f"""
SELECT '{DATABASE}' AS db, '{CLUSTER}' AS cluster, schema_name, table_name, description, is_view, table_ord,
  last_modified, n_columns FROM delta"""),
    "crec": (("pcols", "delta"), f"""
SELECT '{DATABASE}' AS db, '{CLUSTER}' AS cluster, c.schema_name, c.table_name, c.col_name, c.description,
  c.data_type AS col_type, c.sort_order, c.first_order
FROM pcols c JOIN delta d ON d.schema_name = c.schema_name AND d.table_name = c.table_name"""),
    "lu": (("trec",), """
SELECT db, cluster, schema_name, table_name, CAST(floor(epoch(last_modified)) AS BIGINT) AS last_updated_time_epoch
FROM trec WHERE last_modified IS NOT NULL"""),
    "cols_b": (("pcols", "raw_tables"), """
SELECT schema_name, table_name, col_name,
 CASE WHEN sort_order = 2 THEN 'double' ELSE data_type END AS data_type,
 CASE WHEN sort_order = 3 THEN NULL ELSE description END AS description, sort_order, is_partition
FROM pcols WHERE sort_order <> 5
UNION ALL SELECT schema_name, table_name, 'c_new', 'string', NULL, 99, FALSE FROM raw_tables WHERE table_name LIKE '%7'"""),
    "crec_b": (("cols_b", "delta"), f"""
SELECT '{DATABASE}' AS db, '{CLUSTER}' AS cluster, c.schema_name, c.table_name, c.col_name, c.description,
  c.data_type AS col_type, c.sort_order
FROM cols_b c JOIN delta d ON d.schema_name = c.schema_name AND d.table_name = c.table_name"""),
    "nodes": (("trec", "crec"), f"""
SELECT DISTINCT {key('db')} AS key, 'Database' AS label, db AS name, CAST(NULL AS VARCHAR) AS description,
  CAST(NULL AS VARCHAR) AS col_type, CAST(NULL AS INTEGER) AS sort_order, CAST(NULL AS BOOLEAN) AS is_view FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster')}, 'Cluster', cluster, NULL, NULL, NULL, NULL FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster', 'schema_name')}, 'Schema', schema_name, NULL, NULL, NULL, NULL FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, 'Table', table_name, description, NULL, NULL, is_view FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name', 'col_name')}, 'Column', col_name, description,
  col_type, sort_order, NULL FROM crec"""),
    "nodes_b": (("trec", "crec_b"), f"""
SELECT DISTINCT {key('db')} AS key, 'Database' AS label, db AS name, CAST(NULL AS VARCHAR) AS description,
  CAST(NULL AS VARCHAR) AS col_type FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster')}, 'Cluster', cluster, NULL, NULL FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster', 'schema_name')}, 'Schema', schema_name, NULL, NULL FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, 'Table', table_name, description, NULL FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name', 'col_name')}, 'Column', col_name, description,
  col_type FROM crec_b"""),
    "edges": (("trec", "crec"), f"""
SELECT DISTINCT {key('db')} AS start_key, {key('db', 'cluster')} AS end_key, 'CLUSTER' AS type FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster')}, {key('db', 'cluster', 'schema_name')}, 'SCHEMA' FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name')}, {key('db', 'cluster', 'schema_name', 'table_name')}, 'TABLE'
  FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')},
  {key('db', 'cluster', 'schema_name', 'table_name', 'col_name')}, 'COLUMN' FROM crec"""),
    "edges_b": (("trec", "crec_b"), f"""
SELECT DISTINCT {key('db')} AS start_key, {key('db', 'cluster')} AS end_key, 'CLUSTER' AS type FROM trec
UNION ALL SELECT DISTINCT {key('db', 'cluster')}, {key('db', 'cluster', 'schema_name')}, 'SCHEMA' FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name')}, {key('db', 'cluster', 'schema_name', 'table_name')}, 'TABLE' FROM trec
UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, {key('db', 'cluster', 'schema_name', 'table_name', 'col_name')}, 'COLUMN'
  FROM crec_b"""),
    "docs": (("trec", "crec", "lu"), f"""
SELECT {key('t.db', 't.cluster', 't.schema_name', 't.table_name')} AS key, t.db AS database, t.cluster,
  t.schema_name, t.table_name AS name, t.description, c.column_names, c.column_descriptions,
  l.last_updated_time_epoch AS last_updated_epoch
FROM trec t
LEFT JOIN (SELECT schema_name, table_name, string_agg(col_name, ',' ORDER BY sort_order) AS column_names,
             string_agg(description, '|' ORDER BY sort_order) AS column_descriptions
           FROM crec GROUP BY schema_name, table_name) c
  ON c.schema_name = t.schema_name AND c.table_name = t.table_name
LEFT JOIN lu l ON l.schema_name = t.schema_name AND l.table_name = t.table_name"""),
    "postings": (("trec", "crec"), f"""
SELECT term, key, count(*) AS tf FROM (
  SELECT key, unnest(regexp_split_to_array(lower(txt), '[^a-z0-9]+')) AS term FROM (
    SELECT {key('db', 'cluster', 'schema_name', 'table_name')} AS key, table_name AS txt FROM trec
    UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, description FROM trec
    UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, col_name FROM crec
    UNION ALL SELECT {key('db', 'cluster', 'schema_name', 'table_name')}, description FROM crec
  ) WHERE txt IS NOT NULL
) WHERE term <> '' GROUP BY term, key"""),
}


def with_ctes(*names: str) -> str:
    """WITH clause holding ``names`` and everything they depend on, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in CTES[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in ordered) + "\n"


FLAT_DOCS = """SELECT key, database, cluster, schema_name, name, description, column_names, column_descriptions,
  last_updated_epoch FROM docs"""

ORACLE: dict[str, str] = {
    "scope_exclude": with_ctes("raw_schemas", "raw_tables", "exclude_list") + """
SELECT schema_name, table_name FROM raw_tables
WHERE schema_name IN (SELECT schema_name FROM raw_schemas
                      WHERE schema_name NOT IN (SELECT schema_name FROM exclude_list))""",
    "scope_include": with_ctes("raw_tables", "schema_list", "exclude_list") + """
SELECT schema_name, table_name FROM raw_tables WHERE schema_name IN (SELECT schema_name FROM schema_list)""",
    "relational_catalog": with_ctes("pg_columns") + """
SELECT 'postgres' AS db, catalog_name AS cluster, schemaname AS schema_name, table_name, col_name, col_type,
  col_description AS description, col_sort_order FROM pg_columns WHERE schemaname IN ('public')""",
    "commit_log_detail": with_ctes("raw_commits") + """
SELECT table_id, last_modified, m.format AS format, m.description AS description FROM (
  SELECT table_id, max(commit_ts) AS last_modified,
    max_by({'format': format, 'description': description}, version) FILTER (WHERE format IS NOT NULL) AS m
  FROM raw_commits GROUP BY table_id)""",
    "describe_sections": with_ctes("sec") + "SELECT schema_name, table_name, row_no, section FROM sec",
    "describe_columns": with_ctes("cols") + """
SELECT schema_name, table_name, col_name, data_type, description, sort_order FROM cols""",
    "partition_columns": with_ctes("pcols") + """
SELECT schema_name, table_name, col_name, data_type, description, sort_order, is_partition FROM pcols""",
    "describe_properties": with_ctes("props") + "SELECT schema_name, table_name, prop_key, prop_value FROM props",
    "route_kind": with_ctes("raw_tables") + """
SELECT schema_name, table_name, (coalesce(table_type, '') = '' OR lower(table_type) = 'view') AS is_view
FROM raw_tables""",
    "attach_details": with_ctes("scraped") + """
SELECT schema_name, table_name, is_view, has_detail, format, description, last_modified FROM scraped""",
    "drop_unscrapable": with_ctes("checked") + """
SELECT schema_name, table_name, is_view, n_columns, reason FROM checked""",
    "delta_filter": with_ctes("delta") + "SELECT schema_name, table_name, format FROM delta",
    "table_metadata": with_ctes("trec", "crec") + """
SELECT t.db, t.cluster, t.schema_name, t.table_name, t.description, t.is_view, c.columns_text, t.n_columns
FROM trec t LEFT JOIN (
  SELECT schema_name, table_name,
    string_agg(concat_ws(':', CAST(sort_order AS VARCHAR), col_name, col_type, coalesce(description, '')), '|'
               ORDER BY first_order) AS columns_text
  FROM crec GROUP BY schema_name, table_name) c
ON c.schema_name = t.schema_name AND c.table_name = t.table_name""",
    "table_metadata_nested": with_ctes("trec", "crec") + """
SELECT t.db, t.cluster, t.schema_name, t.table_name, t.is_view,
  CAST(row_number() OVER (PARTITION BY t.schema_name, t.table_name ORDER BY c.first_order) - 1 AS INTEGER) AS position,
  c.col_name AS name, c.description, c.col_type, c.sort_order
FROM trec t JOIN crec c ON c.schema_name = t.schema_name AND c.table_name = t.table_name""",
    "table_last_updated": with_ctes("lu") + """
SELECT db, cluster, schema_name, table_name, last_updated_time_epoch FROM lu""",
    "emit_records": with_ctes("trec") + """
SELECT CAST(row_number() OVER (ORDER BY table_ord, kind_ord) AS BIGINT) AS emit_ord, record_kind, schema_name,
  table_name FROM (
  SELECT table_ord, 0 AS kind_ord, 'table_metadata' AS record_kind, schema_name, table_name FROM trec
  UNION ALL SELECT table_ord, 1, 'table_last_updated', schema_name, table_name FROM trec
  WHERE last_modified IS NOT NULL)""",
    "table_signature": with_ctes("cols") + """
SELECT concat_ws('.', schema_name, table_name) AS full_name,
  string_agg(concat_ws(':', col_name, data_type), ',' ORDER BY first_order) AS signature
FROM cols GROUP BY schema_name, table_name""",
    "column_diff": with_ctes("pcols", "cols_b") + """
SELECT * FROM (
  SELECT coalesce(a.schema_name, b.schema_name) AS schema_name, coalesce(a.table_name, b.table_name) AS table_name,
    coalesce(a.col_name, b.col_name) AS col_name,
    CASE WHEN a.col_name IS NULL THEN 'added' WHEN b.col_name IS NULL THEN 'removed'
         WHEN a.data_type IS NOT DISTINCT FROM b.data_type AND a.description IS NOT DISTINCT FROM b.description
          AND a.sort_order IS NOT DISTINCT FROM b.sort_order AND a.is_partition IS NOT DISTINCT FROM b.is_partition
          AND b.sort_order <> 4 -- the second snapshot's attributes
         THEN 'same' ELSE 'changed' END AS change
  FROM pcols a FULL OUTER JOIN cols_b b
  ON a.schema_name = b.schema_name AND a.table_name = b.table_name AND a.col_name = b.col_name
) WHERE change <> 'same'""",
    "graph_nodes": with_ctes("nodes") + "SELECT key, label, name, description FROM nodes",
    "graph_edges": with_ctes("edges") + "SELECT start_key, end_key, type FROM edges",
    "csv_exchange": with_ctes("nodes") + "SELECT key, label, name, description, col_type, sort_order, is_view FROM nodes",
    "csv_exchange_edges": with_ctes("edges") + "SELECT start_key, end_key, type FROM edges",
    "publish_upsert": with_ctes("nodes", "nodes_b") + """
SELECT coalesce(b.key, a.key) AS key,
  CASE WHEN b.key IS NOT NULL THEN b.label ELSE a.label END AS label,
  CASE WHEN b.key IS NOT NULL THEN b.description ELSE a.description END AS description,
  CASE WHEN b.key IS NOT NULL THEN b.col_type ELSE a.col_type END AS col_type,
  CASE WHEN b.key IS NOT NULL THEN 'run_b' ELSE 'run_a' END AS publish_tag
FROM nodes a FULL OUTER JOIN nodes_b b ON a.key = b.key""",
    "publish_upsert_edges": with_ctes("edges", "edges_b") + """
SELECT coalesce(b.start_key, a.start_key) AS start_key, coalesce(b.end_key, a.end_key) AS end_key, coalesce(b.type, a.type) AS type,
  CASE WHEN b.end_key IS NOT NULL THEN 'run_b' ELSE 'run_a' END AS publish_tag
FROM edges a FULL OUTER JOIN edges_b b ON a.start_key = b.start_key AND a.end_key = b.end_key AND a.type = b.type""",
    "search_documents": with_ctes("docs") + FLAT_DOCS,
    "json_exchange": with_ctes("docs") + FLAT_DOCS,
    "publish_index": with_ctes("docs") + FLAT_DOCS,
    "graph_lookup": with_ctes("raw_tables", "trec", "crec", "lu") + f"""
SELECT r.key, t.table_name IS NOT NULL AS found, t.schema_name, c.columns_text,
  l.last_updated_time_epoch AS last_updated_epoch
FROM (SELECT DISTINCT {key(f"'{DATABASE}'", f"'{CLUSTER}'", 'schema_name', 'table_name')} AS key FROM raw_tables) r
LEFT JOIN (SELECT {key('db', 'cluster', 'schema_name', 'table_name')} AS key, schema_name, table_name FROM trec) t
  ON t.key = r.key
LEFT JOIN (SELECT {key('db', 'cluster', 'schema_name', 'table_name')} AS key,
             string_agg(concat_ws(':', CAST(sort_order AS VARCHAR), col_name, coalesce(col_type, '')), '|'
                        ORDER BY sort_order) AS columns_text
           FROM crec GROUP BY db, cluster, schema_name, table_name) c ON c.key = r.key
LEFT JOIN (SELECT {key('db', 'cluster', 'schema_name', 'table_name')} AS key, last_updated_time_epoch FROM lu) l
  ON l.key = r.key""",
    # Positions count the terms of a field; the elements of a list follow one another.
    "search_index": with_ctes("docs") + """,
texts AS (
  SELECT key, 'name' AS field, name AS txt FROM docs UNION ALL SELECT key, 'description', description FROM docs
  UNION ALL SELECT key, 'column_names', replace(column_names, ',', ' ') FROM docs
  UNION ALL SELECT key, 'column_descriptions', column_descriptions FROM docs
), split AS (SELECT key, field, list_filter(regexp_split_to_array(lower(txt), '[^a-z0-9]+'), lambda t: t <> '') AS ts FROM texts WHERE txt IS NOT NULL),
hits AS (SELECT key, field, ts[p + 1] AS term, p FROM split, unnest(range(0, len(ts))) AS r(p)),
lens AS (SELECT key, count(*) AS doc_len FROM hits GROUP BY key),
tfs AS (SELECT term, key, count(*) AS tf FROM hits GROUP BY term, key)
SELECT h.term, h.key, any_value(tf) AS tf, any_value(doc_len) AS doc_len, field, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS positions
FROM hits h JOIN lens USING (key) JOIN tfs ON tfs.term = h.term AND tfs.key = h.key GROUP BY h.term, h.key, field""",
    "search_rank": with_ctes("postings") + """,
dl AS (SELECT key, sum(tf) AS doc_len FROM postings GROUP BY key),
st AS (SELECT count(*) AS n, avg(doc_len) AS avgdl FROM dl),
q AS (SELECT n_nationkey AS query_id,
        concat_ws(' ', 'customer', CAST(min(c_custkey) AS VARCHAR), concat('c', CAST(n_regionkey + 1 AS VARCHAR)),
                  'part') AS text
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_regionkey),
qt AS (SELECT DISTINCT query_id, term FROM (
        SELECT query_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM q) WHERE term <> ''),
dft AS (SELECT term, count(*) AS df FROM postings WHERE term IN (SELECT term FROM qt) GROUP BY term),
sc AS (
  SELECT qt.query_id, p.key,
    round(sum(ln(CAST(1.0 AS DOUBLE) + (CAST(st.n AS DOUBLE) - dft.df + CAST(0.5 AS DOUBLE))
                  / (dft.df + CAST(0.5 AS DOUBLE)))
              * p.tf * CAST(2.2 AS DOUBLE)
              / (p.tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE)
                 + CAST(0.75 AS DOUBLE) * dl.doc_len / st.avgdl))), 6) AS score
  FROM qt JOIN dft ON dft.term = qt.term JOIN postings p ON p.term = qt.term JOIN dl ON dl.key = p.key, st
  GROUP BY qt.query_id, p.key)
SELECT query_id, CAST(rk AS INT) AS rank, key, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rk FROM sc) WHERE rk <= 10""",
}

# Item 4 over logs: the fixture's log files as rows, then the state at each table's newest version.
CTES.update({
    "log_versions": ((), """
SELECT *, CASE WHEN (top + 1) // 10 * 10 - 1 >= 9 THEN (top + 1) // 10 * 10 - 1 END AS cp, CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS parts,
  epoch_us(ts) // 1000 AS ms, concat('lake/u', CAST(user_id AS VARCHAR)) AS table_path,
  CASE WHEN event_type = 'signup' THEN 'delta' WHEN event_type = 'error' THEN 'parquet' END AS fmt
FROM (SELECT user_id, event_id, event_type, ts, row_number() OVER w - 1 AS v, count(*) OVER (PARTITION BY user_id) - 1 AS top,
        lead(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""),
    # Every fifth table lacks a part of its last checkpoint and starts from the one before.
    "log_base": (("log_versions",), """
SELECT DISTINCT user_id, table_path, CASE WHEN user_id % 5 <> 0 THEN cp WHEN cp - 10 >= 9 THEN cp - 10 END AS base FROM log_versions"""),
    "log_files": (("log_versions", "log_base"), """
SELECT c.*, b.base FROM log_versions c JOIN log_base b USING (user_id) WHERE event_id % 97 <> 0 AND (cp IS NULL OR v >= cp - 12)"""),
    "log_later": (("log_files",), "SELECT * FROM log_files WHERE base IS NULL OR v > base"),
    "log_state": (("log_versions", "log_base", "log_later"), """
SELECT b.table_path, v AS path, b.base AS version, true AS live, event_id * 10 + 1 AS size, ms
FROM log_versions c JOIN log_base b USING (user_id) WHERE v <= b.base AND NOT (coalesce(next_type, '') = 'purchase' AND v < b.base)
UNION ALL SELECT table_path, v, v, true, event_id * 10 + 1, ms FROM log_later
UNION ALL SELECT table_path, v - 1, v, false, 0, NULL FROM log_later WHERE event_type = 'purchase' AND v > 0"""),
    "log_meta": (("log_versions", "log_base", "log_later"), """
SELECT table_path, max_by({'f': fmt, 'd': concat('rev ', CAST(event_id AS VARCHAR))}, v) AS m FROM (
  SELECT b.table_path, fmt, event_id, v FROM log_versions c JOIN log_base b USING (user_id) WHERE v <= b.base AND fmt IS NOT NULL
  UNION ALL SELECT table_path, fmt, event_id, v FROM log_later WHERE fmt IS NOT NULL) GROUP BY table_path"""),
    "log_there": (("log_base", "log_later"), """
SELECT DISTINCT table_path, v FROM (SELECT table_path, v FROM log_later UNION ALL SELECT table_path, coalesce(base, -1) FROM log_later
  UNION ALL SELECT table_path, base FROM log_base WHERE base IS NOT NULL)"""),
    "log_gaps": (("log_there",), """
SELECT table_path, sum(nxt - v - 1) AS n, min(v + 1) AS first_missing, max(nxt - 1) AS last_missing
FROM (SELECT table_path, v, lead(v) OVER (PARTITION BY table_path ORDER BY v) AS nxt FROM log_there) WHERE nxt > v + 1 GROUP BY table_path"""),
    "replayed": (("log_files", "log_state", "log_meta", "log_there", "log_gaps", "log_base"), """
SELECT t.table_path, b.base AS base_version, t.version, m.m.f AS format, m.m.d AS description,
  CAST(coalesce(l.n_files, 0) AS BIGINT) AS n_files, CAST(coalesce(l.n_bytes, 0) AS BIGINT) AS n_bytes,
  CAST(coalesce(g.n, 0) AS BIGINT) AS n_missing, g.first_missing, g.last_missing, m.m IS NOT NULL AND coalesce(g.n, 0) = 0 AS complete,
  coalesce(c.ms, l.written) AS last_modified_ms
FROM (SELECT table_path, max(v) AS version FROM log_there GROUP BY table_path) t JOIN log_base b USING (table_path)
LEFT JOIN log_files c ON c.table_path = t.table_path AND c.v = t.version
LEFT JOIN log_meta m ON m.table_path = t.table_path LEFT JOIN log_gaps g ON g.table_path = t.table_path
LEFT JOIN (SELECT table_path, count(*) FILTER (WHERE live) AS n_files, sum(size) FILTER (WHERE live) AS n_bytes, max(written) AS written FROM (
    SELECT table_path, path, max_by(live, version) AS live, max_by(size, version) AS size, max(ms) AS written
    FROM log_state GROUP BY table_path, path) GROUP BY table_path) l ON l.table_path = t.table_path"""),
    "scraped_log": (("raw_tables", "replayed"), """
SELECT r.schema_name, r.table_name, d.format, d.description, d.last_modified_ms, d.table_path IS NOT NULL AS has_detail
FROM raw_tables r LEFT JOIN replayed d ON d.complete AND d.table_path = concat('lake/u', CAST(r.table_ord AS VARCHAR))
WHERE NOT (coalesce(table_type, '') = '' OR lower(table_type) = 'view')"""),
})
ORACLE["commit_log_replay"] = with_ctes("replayed") + "SELECT * FROM replayed"
ORACLE["lake_from_commit_log"] = with_ctes("scraped_log", "pcols") + """
SELECT s.schema_name, s.table_name, s.format, s.description, CAST(coalesce(n.n_columns, 0) AS INT) AS n_columns,
  CASE WHEN NOT s.has_detail THEN 'no_detail' WHEN coalesce(n.n_columns, 0) = 0 THEN 'no_columns' ELSE 'kept' END AS reason, s.last_modified_ms
FROM scraped_log s LEFT JOIN (SELECT schema_name, table_name, count(*) AS n_columns FROM pcols GROUP BY schema_name, table_name) n
ON n.schema_name = s.schema_name AND n.table_name = s.table_name"""

ORACLE["relational_graph"] = with_ctes("pg_columns") + f"""
SELECT {key("'postgres'", 'catalog_name', 'schemaname', 'table_name')} AS key, 'postgres' AS database, catalog_name AS cluster,
  schemaname AS schema_name, table_name AS name, CAST(NULL AS VARCHAR) AS description,
  string_agg(col_name, ',' ORDER BY col_sort_order) AS column_names, string_agg(col_description, '|' ORDER BY col_sort_order) AS column_descriptions,
  CAST(NULL AS BIGINT) AS last_updated_epoch
FROM pg_columns WHERE schemaname IN ('public') GROUP BY catalog_name, schemaname, table_name"""

# Option variants: the other partition match rule (Q1) and delta_only=False.
ORACLE["partition_columns_name_first"] = with_ctes("pcols_name_first") + """
SELECT schema_name, table_name, col_name, data_type, description, sort_order, is_partition FROM pcols_name_first"""
ORACLE["kept_records_all_formats"] = with_ctes("checked") + f"""
SELECT '{DATABASE}' AS db, '{CLUSTER}' AS cluster, schema_name, table_name, description, is_view, n_columns
FROM checked WHERE reason = 'kept'"""
