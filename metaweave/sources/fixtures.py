"""Metadata-shaped test tables derived from the provided star-schema parquet.

The derivation rules are those of ``FIXTURES.md`` (the same rules are written
as DuckDB SQL in :mod:`metaweave.plans.oracle`).  Every table is a lazy
DataFrame over the parquet files, so its size grows with the scale factor.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metaweave.model import RAW_SCHEMAS, RAW_SCHEMAS_BY_NAME, S, TB
from metaweave.session import scratch_path
from metaweave.sources.landed import land_describe, write_landed

SOURCE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _txt(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


class Fixtures:
    """Lazily derived fixture tables for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- listings ---------------------------------------------------------------

    @cached_property
    def raw_schemas(self) -> DataFrame:
        return self.source("nation").select(F.col("n_name").alias(S))

    @cached_property
    def raw_tables(self) -> DataFrame:
        orders = self.source("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        customer = self.source("customer").select("c_custkey", "c_nationkey")
        nation = self.source("nation").select("n_nationkey", "n_name")
        table_type = (
            F.when(F.col("o_orderpriority") == "5-LOW", "VIEW")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
            .otherwise("MANAGED")
        )
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(
                F.col("n_name").alias(S),
                F.concat(F.lit("t"), _txt("o_orderkey")).alias(TB),
                F.col("o_orderkey").alias("table_ord"),
                table_type.alias("table_type"),
            )
        )

    # -- details ----------------------------------------------------------------

    @cached_property
    def raw_table_detail(self) -> DataFrame:
        orders = self.source("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        t = self.raw_tables
        k = F.col("o_orderkey")
        fmt = (
            F.when(F.col("o_orderstatus") == "F", "delta")
            .when(F.col("o_orderstatus") == "O", "DELTA")
            .otherwise("parquet")
        )
        description = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("orders of customer "), _txt("o_custkey"))
        )
        last_modified = F.when(k % 11 == 0, F.lit(None)).otherwise(
            F.col("o_orderdate") + F.expr("INTERVAL 1500 MILLISECONDS")
        )
        return (
            orders.join(t, k == t.table_ord)
            .where((F.col("table_type") == "MANAGED") & (k % 13 != 0))
            .select(S, TB, fmt.alias("format"), description.alias("description"),
                    last_modified.alias("last_modified"))
        )

    @cached_property
    def raw_describe(self) -> DataFrame:
        li = self.source("lineitem").select(
            "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey",
            "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax")
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
            "l_discount", "l_tax")
        data_type = (
            F.when(F.col("l_returnflag") == "A", "bigint")
            .when(F.col("l_returnflag") == "N", "string")
            .otherwise("decimal(10,2)")
        )
        comment = F.when(F.col("l_linestatus") == "O", "").otherwise(
            F.concat(F.lit("part "), _txt("l_partkey")))
        column_rows = li.select(
            F.col("l_orderkey").alias("k"),
            F.row_number().over(w).cast("int").alias("row_no"),
            F.concat(F.lit("c"), _txt("l_linenumber")).alias("col_name"),
            data_type.alias("data_type"),
            comment.alias("comment"),
        )

        def row(no, name, dtype, comment_):
            return F.struct(F.lit(no).alias("row_no"), F.lit(name).alias("col_name"),
                            F.lit(dtype).alias("data_type"), F.lit(comment_).alias("comment"))

        # Partition blocks: Spark-3 style for key % 3 = 0, Spark-2 / Delta style for = 1.
        spark3 = F.array(row(1001, "# Partition Information", "", ""),
                         row(1002, "# col_name", "data_type", "comment"),
                         row(1003, "c1", "bigint", ""))
        spark2 = F.array(row(1001, "", "", ""),
                         row(1002, "# Partitioning", "", ""),
                         row(1003, "Part 0", "c2", ""))
        k = F.col("o_orderkey")
        marker_rows = (
            self.source("orders").select("o_orderkey")
            .where(k % 3 != 2)
            .select(k.alias("k"), F.inline(F.when(k % 3 == 0, spark3).otherwise(spark2)))
        )
        t = self.raw_tables
        # Column rows lie by order as their window left them, so they meet their table without another exchange.
        joined = [rows.join(t, rows.k == t.table_ord) for rows in (column_rows, marker_rows)]
        return joined[0].unionByName(joined[1]).select(S, TB, "row_no", "col_name", "data_type", "comment")

    @cached_property
    def raw_describe_ext(self) -> DataFrame:
        t = self.raw_tables
        o = F.col("table_ord")
        v = t.where((F.col("table_type").isNull() | (F.col("table_type") == "VIEW")) & (o % 17 != 0))

        def row(no, name, value):
            return F.struct(F.lit(no).alias("row_no"), F.lit(name).alias("col_name"), value.alias("data_type"))

        rows = F.filter(
            F.array(
                row(1, "c1", F.lit("bigint")),
                row(2, "", F.lit("")),
                row(3, "# Detailed Table Information", F.lit("")),
                row(4, "Type", F.lit("VIEW")),
                row(5, "Comment", F.concat(F.lit("view "), F.col(TB))),
                F.when(o % 5 == 0, row(6, "description", F.concat(F.lit("old "), F.col(TB)))),
                F.when(o % 5 == 0, row(7, "description", F.concat(F.lit("desc "), F.col(TB)))),
                F.when(o % 4 == 0, row(8, "format", F.lit("Delta"))),
            ),
            lambda x: x.isNotNull(),
        )
        return v.select(S, TB, F.inline(rows))

    # -- other sources ------------------------------------------------------------

    @cached_property
    def raw_commits(self) -> DataFrame:
        e = F.col("event_type")
        return self.source("events").select(
            F.col("user_id").alias("table_id"),
            F.col("event_id").alias("version"),
            F.col("ts").alias("commit_ts"),
            e.alias("action"),
            F.when(e.isin("signup", "error"), F.concat(F.lit("rev "), _txt("event_id"))).alias("description"),
            F.when(e == "signup", "delta").when(e == "error", "parquet").alias("format"),
        )

    @cached_property
    def _log_versions(self) -> DataFrame:
        """Events as commits of one table per user: version, action times and the table's checkpoint versions."""
        own = Window.partitionBy("user_id")
        u, v = F.col("user_id"), F.col("v")
        last = F.floor((F.col("top") + 1) / 10).cast("long") * 10 - 1
        return (
            self.source("events").select("user_id", "event_id", "event_type", "ts")
            .withColumns({"v": F.row_number().over(own.orderBy("event_id")).cast("long") - 1, "top": F.count(F.lit(1)).over(own) - 1})
            .withColumns({
                "cp": F.when(last >= 9, last),
                "parts": F.when(u % 3 == 0, 2).otherwise(1),
                "ms": F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")),
                "next_type": F.lead("event_type").over(own.orderBy("event_id")),
                "table": F.concat(F.lit("lake/u"), _txt("user_id")),
                "file": F.concat(F.lit("f"), _txt(v), F.lit(".parquet"))})
        )

    @cached_property
    def raw_log_lines(self) -> DataFrame:
        """Lines of the commit files that are still there: some are lost, old ones have been cleaned up."""
        e, v = F.col("event_type"), F.col("v")

        def line(name, value):
            return F.to_json(F.struct(value.alias(name)))

        ms = F.col("ms")
        lines = F.array_compact(F.array(
            line("commitInfo", F.struct(ms.alias("timestamp"), e.alias("operation"))),
            F.when(e.isin("signup", "error"), line("metaData", F.struct(
                F.col("table").alias("id"), F.concat(F.lit("rev "), _txt("event_id")).alias("description"),
                F.struct(F.when(e == "signup", "delta").otherwise("parquet").alias("provider")).alias("format")))),
            line("add", F.struct(F.col("file").alias("path"), (F.col("event_id") * 10 + 1).alias("size"), ms.alias("modificationTime"))),
            F.when((e == "purchase") & (v > 0), line("remove", F.struct(
                F.concat(F.lit("f"), _txt(v - 1), F.lit(".parquet")).alias("path"), ms.alias("deletionTimestamp"))))))
        there = (F.col("event_id") % 97 != 0) & (F.col("cp").isNull() | (v >= F.col("cp") - 12))
        return self._log_versions.where(there).select(
            F.concat(F.col("table"), F.lit("/_delta_log/"), F.lpad(_txt(v), 20, "0"), F.lit(".json")).alias("file_path"),
            F.explode(lines).alias("line"))

    @cached_property
    def raw_log_checkpoints(self) -> DataFrame:
        """Rows of the last two checkpoints of each table, in one or two parts; every fifth table lacks the last part of its last."""
        e, v, k = F.col("event_type"), F.col("v"), F.col("k")
        at = self._log_versions.where("cp IS NOT NULL").withColumn("k", F.explode(F.array("cp", F.col("cp") - 10))).where((k >= 9) & (v <= k))
        live = at.where(~((F.col("next_type") == "purchase") & (v < k)) | F.col("next_type").isNull()).select(
            "user_id", "table", "cp", "k", "parts", (v % F.col("parts") + 1).cast("int").alias("part"),
            F.lit(None).cast("struct<id:string,description:string,format:struct<provider:string>>").alias("metaData"),
            F.struct(F.col("file").alias("path"), (F.col("event_id") * 10 + 1).alias("size"), F.col("ms").alias("modificationTime")).alias("add"))
        meta = at.where(e.isin("signup", "error")).groupBy("user_id", "table", "cp", "k", "parts").agg(
            F.max_by(F.struct(F.col("table").alias("id"), F.concat(F.lit("rev "), _txt("event_id")).alias("description"),
                              F.struct(F.when(e == "signup", "delta").otherwise("parquet").alias("provider")).alias("format")), v).alias("metaData"))
        meta = meta.select("user_id", "table", "cp", "k", "parts", F.lit(1).alias("part"), "metaData",
                           F.lit(None).cast("struct<path:string,size:bigint,modificationTime:bigint>").alias("add"))
        number = F.when(F.col("parts") > 1, F.concat(F.lit("."), F.lpad(_txt("part"), 10, "0"), F.lit("."), F.lpad(_txt("parts"), 10, "0"))).otherwise("")
        lost = (F.col("user_id") % 5 == 0) & (k == F.col("cp")) & (F.col("part") == F.col("parts"))
        return live.unionByName(meta).where(~lost).select(
            F.concat(F.col("table"), F.lit("/_delta_log/"), F.lpad(_txt(k), 20, "0"), F.lit(".checkpoint"), number, F.lit(".parquet")).alias("file_path"),
            "metaData", "add", F.lit(None).cast("struct<path:string,deletionTimestamp:bigint>").alias("remove"))

    @cached_property
    def table_paths(self) -> DataFrame:
        """Which table of the listing each log belongs to."""
        users = self.source("events").select("user_id").distinct()
        return self.raw_tables.join(users, F.col("table_ord") == F.col("user_id")).select(
            F.concat(F.lit("lake/u"), _txt("user_id")).alias("table_path"), S, TB)

    @cached_property
    def pg_columns(self) -> DataFrame:
        size = F.col("p_size")
        return self.source("part").select(
            F.lit("wh").alias("catalog_name"),
            F.when(size % 3 == 0, "public").when(size % 3 == 1, "audit").otherwise("staging").alias("schemaname"),
            F.col("p_type").alias(TB),
            F.concat(F.lit("col"), _txt("p_partkey")).alias("col_name"),
            F.when(size < 25, "integer").otherwise("text").alias("col_type"),
            F.col("p_name").alias("col_description"),
            F.col("p_partkey").cast("int").alias("col_sort_order"),
        )

    @cached_property
    def exclude_list(self) -> DataFrame:
        return self.source("nation").where(F.col("n_regionkey") == 3).select(F.col("n_name").alias(S))

    @cached_property
    def schema_list(self) -> DataFrame:
        return self.source("nation").where(F.col("n_regionkey") == 1).select(F.col("n_name").alias(S))

    def columns_b(self, columns_a: DataFrame) -> DataFrame:
        """Second column snapshot for ``column_diff`` (``columns_a`` = partition_columns output)."""
        so, carried = F.col("sort_order"), "attributes" in columns_a.columns
        changed = columns_a.where(so != 5).select(
            S, TB, "col_name",
            F.when(so == 2, "double").otherwise(F.col("data_type")).alias("data_type"),
            F.when(so == 3, F.lit(None).cast("string")).otherwise(F.col("description")).alias("description"),
            so, "is_partition",
            *([F.when(so == 4, F.create_map(F.lit("note"), F.lit("b"))).otherwise(F.col("attributes")).alias("attributes")] if carried else []),
        )
        added = self.raw_tables.where(F.col(TB).like("%7")).select(
            S, TB, F.lit("c_new").alias("col_name"), F.lit("string").alias("data_type"),
            F.lit(None).cast("string").alias("description"), F.lit(99).alias("sort_order"),
            F.lit(False).alias("is_partition"),
            *([F.create_map().cast("map<string,string>").alias("attributes")] if carried else []),
        )
        return changed.unionByName(added)

    def all_raw(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in LANDED_NAMES}

    def lake_raw(self) -> dict[str, DataFrame]:
        """The tables that the lake pipeline reads."""
        return {n: getattr(self, n) for n in LAKE_NAMES}


LANDED_NAMES = ["raw_schemas", "raw_tables", "raw_table_detail", "raw_describe", "raw_describe_ext",
                "raw_commits", "raw_log_lines", "raw_log_checkpoints", "table_paths", "pg_columns", "exclude_list", "schema_list"]
LAKE_NAMES = ["raw_schemas", "raw_tables", "raw_table_detail", "raw_describe", "raw_describe_ext"]
LANDED_SCHEMAS = {**RAW_SCHEMAS_BY_NAME, "exclude_list": RAW_SCHEMAS, "schema_list": RAW_SCHEMAS}


class LandedFixtures(Fixtures):
    """The fixture tables as landed parquet: what the catalog pipeline reads in
    production.  Each is derived once per Spark application and data directory, when it is first read."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, there: set[str] | None = None):
        super().__init__(spark, sf_dir)
        self.root, self.there = root, set() if there is None else there  # names of the tables below ``root``

    def landed(self, name: str) -> DataFrame:
        described = name == "raw_describe"
        if name not in self.there:
            df = getattr(Fixtures(self.spark, self.sf_dir), name)
            if described:
                land_describe(df, describe_table(self.root), f"{self.root}/{name}")
            else:
                write_landed({name: df}, self.root)
            self.there.add(name)
        if described:
            return self.spark.table(describe_table(self.root))
        return self.spark.read.schema(LANDED_SCHEMAS[name]).parquet(f"{self.root}/{name}")


def _when_read(name: str) -> cached_property:
    prop = cached_property(lambda self: self.landed(name))
    prop.__set_name__(LandedFixtures, name)
    return prop


for _name in LANDED_NAMES:
    setattr(LandedFixtures, _name, _when_read(_name))

# (application id, data directory) -> folder holding the landed fixture tables, and which it holds.
_LANDED: dict[tuple[str, str], tuple[str, set[str]]] = {}


def describe_table(root: str) -> str:
    """Name of the saved table that holds the landed DESCRIBE rows of ``root``."""
    return "mw_describe_" + root.rsplit("-", 1)[-1]


def landed_fixtures(spark: SparkSession, sf_dir: str) -> LandedFixtures:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _LANDED:
        _LANDED[key] = (scratch_path(spark, "landed"), set())
    return LandedFixtures(spark, sf_dir, *_LANDED[key])
