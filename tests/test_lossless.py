"""Nothing is lost or silently equal: record numbering, CSV, include lists, diffs, publishing, rejects."""

import pytest

from metaweave.functions.ordered import block_ordinal
from metaweave.operators import records as R
from metaweave.operators import scope
from metaweave.session import scratch_path
from metaweave.sources import exchange, index

RECORD = "table_ord long, kind_ord int, db string, cluster string, schema_name string, table_name string"


def test_null_and_sparse_ordinals_are_numbered(spark):
    rows = [(1, 0), (None, 0), (2, 0), (2, 1), (None, 1), (10**15, 0), (-(10**15), 0), (7, 0)]
    df = spark.createDataFrame([(o, k, "d", "c", "s", f"t{i}") for i, (o, k) in enumerate(rows)], RECORD)
    got = R.number_records(df).orderBy("emit_ord").collect()
    assert [r.emit_ord for r in got] == list(range(1, 9))
    assert [r.table_ord for r in got] == [None, None, -(10**15), 1, 2, 2, 7, 10**15]


def test_numbering_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", None), ("a", 5)], "g string, o long")
    assert {(r.g, r.o): r.ordinal for r in block_ordinal(df, ["g"], "o").collect()} == {(None, 1): 0, (None, 3): 1, ("a", None): 0, ("a", 5): 1}
    assert block_ordinal(df.limit(0), [], "o").count() == 0


@pytest.mark.parametrize("size", [10, 3000])
def test_sparse_ordinals_spread_over_blocks(spark, size):
    df = spark.range(size).selectExpr("id * id * 1000003 AS table_ord", "0 AS kind_ord", "'d' AS db", "'c' AS cluster", "'s' AS schema_name", "'t' AS table_name")
    got = R.number_records(df).select("emit_ord", "table_ord").collect()
    assert sorted(got, key=lambda r: r.table_ord) == sorted(got, key=lambda r: r.emit_ord) and {r.emit_ord for r in got} == set(range(1, size + 1))


def test_csv_is_lossless(spark):
    texts = ["  lead", " trail  ", "\\N", "\\\\N", "\\", "", None, 'q"uo"te', "new\nline", "\r\n", "a,b", "\t", "ü\\N",
             "\\n", "\\\n", "\\\\n\r\n\\", "\n", "\r", '\\"', '"\n"', "\\\\\\r"]
    nodes = spark.createDataFrame([(f"k{i}", "Table", t, t, t, i, None) for i, t in enumerate(texts)],
                                  "key string, label string, name string, description string, col_type string, sort_order int, is_view boolean")
    edges = spark.createDataFrame([(t or "none", f" {i} ", "HAS") for i, t in enumerate(texts)], "start_key string, end_key string, type string")
    out = scratch_path(spark, "csv-test")
    exchange.write_graph_csv(nodes, edges, out)
    back_nodes, back_edges = exchange.read_graph_csv(spark, out)
    assert sorted(map(tuple, back_nodes.select(nodes.columns).collect()), key=repr) == sorted(map(tuple, nodes.collect()), key=repr)
    assert sorted(map(tuple, back_edges.select(edges.columns).collect())) == sorted(map(tuple, edges.collect()))


def test_one_csv_file_is_read_by_many_tasks(spark):
    """Line breaks and quotes in every record: splits never cut a record."""
    rows = spark.range(0, 60_000, 1, 1).selectExpr("concat('k', id) AS key", "'Table' AS label", "concat('a\n\"b,', id, '\r\\\\') AS name",
                                                   "repeat(concat('x\n', id), 5) AS description", "CAST(NULL AS STRING) AS col_type", "CAST(id AS INT) AS sort_order", "true AS is_view")
    out = scratch_path(spark, "csv-split")
    exchange.write_nodes_csv(rows, out)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        back = exchange.read_nodes_csv(spark, out)
        assert len(back.inputFiles()) == 1 and back.rdd.getNumPartitions() > 4
        columns = sorted(back.columns)
        assert back.select(columns).exceptAll(rows.select(columns)).count() == 0 and back.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_include_list_without_entries_is_not_given(spark):
    schemas = spark.createDataFrame([("a",), ("b",)], "schema_name string")
    tables = spark.createDataFrame([("a", "t"), ("b", "u"), ("c", "v"), (None, "w")], "schema_name string, table_name string")
    names = lambda include: sorted(r.table_name for r in scope.scope_include(schemas, tables, include, ["b"]).collect())
    assert names(schemas.limit(0)) == names([]) == names(None) == ["t", "w"]
    assert names(schemas.where("schema_name = 'b'")) == names(["b"]) == ["u", "w"]
    pruned = scope.prune_to_scope(tables, schemas.limit(0), ["b"])
    assert sorted(r.table_name for r in pruned.collect()) == ["t", "v"]


def test_a_diff_refuses_missing_fields(spark):
    full = spark.createDataFrame([("s", "t", "c", "int", None, 0, False)],
                                 "schema_name string, table_name string, col_name string, data_type string, description string, sort_order int, is_partition boolean")
    assert R.column_diff(full, full).count() == 0
    with pytest.raises(ValueError, match="second snapshot lacks data_type, is_partition"):
        R.column_diff(full, full.drop("is_partition", "data_type"))
    with pytest.raises(ValueError, match="attributes"):
        R.column_diff(full, full.selectExpr("*", "map('a', '1') AS attributes"))
    a, b = (full.selectExpr("*", f"map('a', '{v}') AS attributes") for v in (1, 2))
    assert R.column_diff(a, a).count() == 0 and R.column_diff(a, b).first().change == "changed"


def test_a_reader_survives_the_next_publish(spark):
    alias, docs = "lossless_test_index", spark.range(5)
    index.publish_index(docs, alias=alias, prefix="lossless_")
    reader = index.read_index(spark, alias)
    targets = [index.publish_index(spark.range(n), alias=alias, prefix="lossless_") for n in (6, 7)]
    assert reader.count() == 5 and index.read_index(spark, alias).count() == 7
    for n in range(4):
        index.publish_index(spark.range(n), alias=alias, prefix="lossless_", keep_previous=2)
    assert not spark.catalog.tableExists(targets[0]) and index.read_index(spark, alias).count() == 3


def test_relational_rows_without_keys_are_rejected(spark):
    rows = [("cat", "public", "t", "c", "int", None, 1), (None, "public", "t", "d", "int", None, 2), ("cat", "public", None, "e", "int", None, 3), ("cat", "other", None, "f", "int", None, 4)]
    df = spark.createDataFrame(rows, "catalog_name string, schemaname string, table_name string, col_name string, col_type string, col_description string, col_sort_order int")
    assert [r.col_name for r in scope.relational_catalog(df).collect()] == ["c"]
    assert {r.col_name: r.reason for r in scope.relational_rejects(df).collect()} == {"d": "no_catalog", "e": "no_table"}
    assert scope.relational_catalog(df, cluster="x", catalog_as_cluster=False).count() == 2


def test_two_publishers_at_once_lose_nothing(spark, monkeypatch):
    """Another publisher commits between this one's look at the alias and its commit, and again before it repoints the view."""
    frames = [spark.createDataFrame([(n,)], "n string") for n in ("first", "mine", "theirs", "later")]
    first = index.publish_index(frames[0], alias="race_idx", prefix="race_")
    others, started = [], []

    def meanwhile(frame):
        if frame not in started:
            started.append(frame)
            others.append(index.publish_index(frames[frame], alias="race_idx", prefix="race_"))

    def raced(spark_, folder, version, text, commit=index.commit_version):
        meanwhile(2)
        return commit(spark_, folder, version, text)

    def overtaken(spark_, alias, repoint=index._repoint):
        if index._record(spark_, alias)[0] == 3:
            meanwhile(3)
        repoint(spark_, alias)

    monkeypatch.setattr(index, "_repoint", overtaken)
    monkeypatch.setattr(index, "commit_version", raced)
    mine = index.publish_index(frames[1], alias="race_idx", prefix="race_")
    theirs, later = others
    version, record = index._record(spark, "race_idx")
    assert version == 4 and [record["target"], *record["previous"]] == [later, mine, theirs, first]
    assert index.current_target(spark, "race_idx") == later and [r.n for r in index.read_index(spark, "race_idx").collect()] == ["later"]
    assert all(spark.catalog.tableExists(t) for t in (first, mine, theirs, later))
