"""Unit tables for routing, details, rejects, delta filter, scope and records."""

import datetime as dt

from metaweave.model import RAW_DESCRIBE, RAW_DESCRIBE_EXT, RAW_SCHEMAS, RAW_TABLE_DETAIL, RAW_TABLES
from metaweave.operators import detail as X
from metaweave.operators import records as R
from metaweave.operators.scope import scope_exclude, scope_include
from metaweave.plans.lake import lake_catalog


def tables_df(spark, rows):
    return spark.createDataFrame(rows, RAW_TABLES)


def test_route_kind(spark):
    types = [None, "", "VIEW", "View", "MANAGED", "EXTERNAL"]
    df = tables_df(spark, [("s", f"t{i}", i, t) for i, t in enumerate(types)])
    got = [r.is_view for r in X.route_kind(df).orderBy("table_ord").collect()]
    assert got == [True, True, True, True, False, False]


def raw_catalog(spark, tables, details, describe, ext=(), schemas=("s",)):
    return {
        "raw_schemas": spark.createDataFrame([(s,) for s in schemas], RAW_SCHEMAS),
        "raw_tables": tables_df(spark, tables),
        "raw_table_detail": spark.createDataFrame(list(details), RAW_TABLE_DETAIL),
        "raw_describe": spark.createDataFrame(list(describe), RAW_DESCRIBE),
        "raw_describe_ext": spark.createDataFrame(list(ext), RAW_DESCRIBE_EXT),
    }


TS = dt.datetime(2020, 1, 2, 3, 4, 5, 900000)


def sample(spark):
    tables = [
        ("s", "a", 1, "MANAGED"),      # delta, kept
        ("s", "b", 2, "MANAGED"),      # no detail
        ("s", "c", 3, "MANAGED"),      # markers only -> no columns
        ("s", "d", 4, "MANAGED"),      # parquet
        ("s", "e", 5, "MANAGED"),      # null format
        ("s", "v", 6, "VIEW"),         # view with format Delta
        ("s", "w", 7, None),           # view without describe extended -> no detail
        (None, "tmp", 8, "TEMPORARY"),  # no schema
    ]
    details = [
        ("s", "a", "Delta", "desc a", TS),
        ("s", "c", "delta", None, TS),
        ("s", "d", "parquet", None, None),
        ("s", "e", None, None, TS),
    ]
    describe = [
        ("s", "a", 1, "x", "int", ""), ("s", "a", 2, "y", "string", "why"),
        ("s", "c", 1, "", "", ""), ("s", "c", 2, "# Partitioning", "", ""),
        ("s", "d", 1, "x", "int", None), ("s", "e", 1, "x", "int", None),
        ("s", "v", 1, "x", "int", None), ("s", "w", 1, "x", "int", None),
    ]
    ext = [("s", "v", 1, "x", "int"), ("s", "v", 2, "# Detailed Table Information", ""),
           ("s", "v", 3, "format", "Delta"), ("s", "v", 4, "description", "a view")]
    return raw_catalog(spark, tables, details, describe, ext)


def test_reasons_and_delta_filter(spark):
    lake = lake_catalog(sample(spark), cluster="c")
    reasons = {r.table_name: r.reason for r in lake.checked.collect()}
    assert reasons == {"a": "kept", "b": "no_detail", "c": "no_columns", "d": "kept", "e": "kept",
                       "v": "kept", "w": "no_detail", "tmp": "no_schema"}
    assert sorted(r.table_name for r in lake.delta.collect()) == ["a", "v"]
    all_kept = lake_catalog(sample(spark), cluster="c", delta_only=False)
    assert sorted(r.table_name for r in all_kept.delta.collect()) == ["a", "d", "e", "v"]


def test_records(spark):
    lake = lake_catalog(sample(spark), cluster="c", database="db")
    recs = {r.table_name: r for r in lake.table_records.collect()}
    assert recs["a"].description == "desc a" and recs["a"].is_view is False
    assert recs["v"].description == "a view" and recs["v"].is_view is True
    nested = {r.table_name: r.columns for r in R.nest_columns(lake.table_records, lake.column_records).collect()}
    assert [(c.name, c.col_type, c.description, c.sort_order) for c in nested["a"]] == [
        ("x", "int", None, 0), ("y", "string", "why", 1)]
    lu = {r.table_name: r.last_updated_time_epoch for r in lake.last_updated.collect()}
    assert lu == {"a": int(TS.replace(tzinfo=dt.timezone.utc).timestamp())}
    stream = R.number_records(lake.records).orderBy("emit_ord").collect()
    assert [(r.emit_ord, r.table_name, r.record_kind) for r in stream] == [
        (1, "a", "table_metadata"), (2, "a", "table_last_updated"), (3, "v", "table_metadata")]


def test_fractional_epoch(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 1, 0, 0, 1, 900000),)], "ts timestamp_ntz")
    from metaweave.functions.exprs import epoch_seconds
    assert df.select(epoch_seconds("ts").alias("e")).first().e == 1


def scope_inputs(spark):
    schemas = spark.createDataFrame([("s1",), ("s2",), ("S3",)], RAW_SCHEMAS)
    tables = tables_df(spark, [("s1", "a", 1, "MANAGED"), ("s2", "b", 2, "MANAGED"), ("S3", "c", 3, "VIEW")])
    return schemas, tables


def test_exclude_is_exact_and_case_sensitive(spark):
    schemas, tables = scope_inputs(spark)
    got = sorted(r.table_name for r in scope_exclude(schemas, tables, ["S1", "s2"]).collect())
    assert got == ["a", "c"]
    assert sorted(r.table_name for r in scope_exclude(schemas, tables, []).collect()) == ["a", "b", "c"]


def test_include_wins_and_repeats_once(spark):
    schemas, tables = scope_inputs(spark)
    got = [r.table_name for r in scope_include(schemas, tables, ["s1", "s1"], ["s1"]).collect()]
    assert got == ["a"]
    inc = spark.createDataFrame([("s2",), ("s2",)], RAW_SCHEMAS)
    assert [r.table_name for r in scope_include(schemas, tables, inc, ["s2"]).collect()] == ["b"]


def test_commit_log_detail(spark):
    rows = [(1, 1, dt.datetime(2020, 1, 1), "signup", "rev 1", "delta"),
            (1, 2, dt.datetime(2020, 1, 3), "click", None, None),
            (1, 3, dt.datetime(2020, 1, 2), "error", "rev 3", "parquet"),
            (2, 4, dt.datetime(2020, 1, 5), "click", None, None)]
    df = spark.createDataFrame(rows, "table_id long, version long, commit_ts timestamp_ntz, action string, "
                                     "description string, format string")
    got = {r.table_id: (r.last_modified, r.format, r.description) for r in X.commit_log_detail(df).collect()}
    assert got == {1: (dt.datetime(2020, 1, 3), "parquet", "rev 3"), 2: (dt.datetime(2020, 1, 5), None, None)}


def test_column_diff(spark):
    a = spark.createDataFrame([("s", "t", "x", "int", None, 0, False), ("s", "t", "y", "int", "d", 1, False)],
                              "schema_name string, table_name string, col_name string, data_type string, "
                              "description string, sort_order int, is_partition boolean")
    b = spark.createDataFrame([("s", "t", "x", "int", None, 0, False), ("s", "t", "z", "int", None, 1, False),
                               ("s", "t", "y", "int", None, 1, False)], a.schema)
    got = {r.col_name: r.change for r in R.column_diff(a, b).collect()}
    assert got == {"z": "added", "y": "changed"}
    assert R.column_diff(a, a).count() == 0


def test_commit_log_feeds_the_lake_pipeline(spark):
    commits = spark.createDataFrame(
        [(1, 1, dt.datetime(2020, 1, 1), "create", "first", "delta"),
         (1, 2, dt.datetime(2020, 1, 4), "write", None, None),
         (2, 3, dt.datetime(2020, 1, 2), "create", None, "parquet")],
        "table_id long, version long, commit_ts timestamp_ntz, action string, description string, format string")
    ids = spark.createDataFrame([(1, "s", "a"), (2, "s", "d")], "table_id long, schema_name string, table_name string")
    detail = X.commit_log_table_detail(commits, ids)
    lake = lake_catalog(sample(spark), cluster="c", table_detail=detail)
    reasons = {r.table_name: r.reason for r in lake.checked.collect()}
    assert reasons["a"] == "kept" and reasons["d"] == "kept" and reasons["e"] == "no_detail"
    recs = {r.table_name: r for r in lake.table_records.collect()}
    assert set(recs) == {"a", "v"}
    assert recs["a"].description == "first" and recs["a"].last_modified == dt.datetime(2020, 1, 4)
