"""Unit tables: one case per DESCRIBE / detail rule (FIXTURES.md section 4)."""

from metaweave.model import RAW_DESCRIBE, RAW_DESCRIBE_EXT
from metaweave.operators import describe as D


def describe(spark, rows, table="t"):
    data = [("s", table, i + 1, c, d, m) for i, (c, d, m) in enumerate(rows)]
    return spark.createDataFrame(data, RAW_DESCRIBE)


def columns_of(spark, rows, match=D.MATCH_DATA_TYPE_FIRST):
    ann = D.annotate_describe(describe(spark, rows))
    out = D.partition_columns(ann, match=match).orderBy("sort_order").collect()
    return [(r.col_name, r.data_type, r.description, r.sort_order, r.is_partition) for r in out]


def test_unpartitioned(spark):
    assert columns_of(spark, [("a", "int", None), ("b", "string", "")]) == [
        ("a", "int", None, 0, False), ("b", "string", None, 1, False)]


def test_spark3_partition_block(spark):
    rows = [("a", "bigint", "c1"), ("dt", "date", None), ("# Partition Information", "", ""),
            ("# col_name", "data_type", "comment"), ("dt", "date", None)]
    got = {c[0]: c[4] for c in columns_of(spark, rows)}
    assert got == {"a": False, "dt": True}


def test_spark2_delta_partition_block(spark):
    rows = [("a", "int", None), ("dt", "date", None), ("", "", ""), ("# Partitioning", "", ""),
            ("Part 0", "dt", "")]
    got = {c[0]: c[4] for c in columns_of(spark, rows)}
    assert got == {"a": False, "dt": True}


def test_partition_precedence(spark):
    rows = [("date", "string", None), ("dt", "date", None), ("# Partition Information", "", ""),
            ("# col_name", "data_type", "comment"), ("dt", "date", None)]
    default = {c[0]: c[4] for c in columns_of(spark, rows)}
    assert default == {"date": True, "dt": False}
    by_name = {c[0]: c[4] for c in columns_of(spark, rows, match=D.MATCH_NAME_FIRST)}
    assert by_name == {"date": False, "dt": True}


def test_hash_in_name_ends_columns(spark):
    rows = [("a", "int", None), ("b#1", "int", None), ("c", "int", None)]
    assert [c[0] for c in columns_of(spark, rows)] == ["a"]


def test_repeated_name_last_wins(spark):
    rows = [("a", "int", "x"), ("b", "int", None), ("a", "string", "")]
    assert columns_of(spark, rows) == [("b", "int", None, 1, False), ("a", "string", None, 2, False)]


def test_markers_only_no_columns(spark):
    assert columns_of(spark, [("", "", ""), ("# Partitioning", "", "")]) == []


def test_partition_row_naming_no_column(spark):
    rows = [("a", "int", None), ("# P", "", ""), ("zz", "yy", "")]
    assert columns_of(spark, rows) == [("a", "int", None, 0, False)]


def test_sections(spark):
    rows = [("a", "int", None), ("", "", ""), ("# Partitioning", "", ""), ("Part 0", "a", "")]
    got = [r.section for r in D.describe_sections(describe(spark, rows)).orderBy("row_no").collect()]
    assert got == ["column", "marker", "marker", "partition"]


def test_positions_across_blocks(spark):
    # A large table spread over many row blocks numbers its columns densely.
    rows = [(f"c{i}", "int", None) for i in range(50)] + [("# Partition Information", "", ""), ("c7", "int", "")]
    ann = D.annotate_describe(describe(spark, rows), block_size=4)
    out = D.partition_columns(ann).orderBy("sort_order").collect()
    assert [r.sort_order for r in out] == list(range(50))
    assert [r.col_name for r in out if r.is_partition] == ["c7"]


def ext(spark, rows, table="v"):
    data = [("s", table, i + 1, c, d) for i, (c, d) in enumerate(rows)]
    return spark.createDataFrame(data, RAW_DESCRIBE_EXT)


def test_view_without_marker_has_empty_detail(spark):
    e = ext(spark, [("a", "int")])
    assert D.describe_properties(e).count() == 0
    vd = D.view_details(e).collect()
    assert len(vd) == 1 and vd[0].format is None and vd[0].description is None


def test_repeated_view_property_last_wins(spark):
    e = ext(spark, [("a", "int"), ("# Detailed Table Information", ""), ("k", "1"), ("k", "2")])
    got = {r.prop_key: r.prop_value for r in D.describe_properties(e).collect()}
    assert got == {"k": "2"}


def test_marker_row_is_not_a_property(spark):
    e = ext(spark, [("# Detailed Table Information", ""), ("format", "delta"), ("description", "d")])
    vd = D.view_details(e).first()
    assert (vd.format, vd.description) == ("delta", "d")
    keys = {r.prop_key for r in D.describe_properties(e).collect()}
    assert "# Detailed Table Information" not in keys


def test_no_python_in_describe_plan(spark):
    rows = [("a", "int", None), ("# P", "", ""), ("a", "", "")]
    plan = D.partition_columns(D.annotate_describe(describe(spark, rows)))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan


def test_records_list_a_repeated_name_where_it_came_first(spark):
    """Last values, first place: in the record, its text and the signature."""
    from pyspark.sql import functions as F

    from metaweave.operators import records as R
    cols = D.partition_columns(D.annotate_describe(describe(spark, [("a", "int", "x"), ("b", "int", None), ("a", "string", "")])))
    assert [r.signature for r in R.table_signature(cols).collect()] == ["a:string,b:int"]
    records = cols.select(F.lit("d").alias("db"), F.lit("c").alias("cluster"), "schema_name", "table_name", "col_name", "description",
                          F.col("data_type").alias("col_type"), "sort_order", "first_order")
    tables = records.select("db", "cluster", "schema_name", "table_name").distinct()
    nested = R.nest_columns(tables, records).first().columns
    assert [(c.name, c.col_type, c.sort_order) for c in nested] == [("a", "string", 2), ("b", "int", 1)]
    assert R.columns_text(records).first().columns_text == "2:a:string:|1:b:int:"
