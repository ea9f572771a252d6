"""Landed raw metadata tables and the relational catalog source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.functions.ordered import DEFAULT_BLOCK, block_of
from metaweave.functions.sizing import tasks_for
from metaweave.model import RAW_SCHEMAS_BY_NAME, ROW_BLOCK
from metaweave.session import shuffles_removed


def read_landed(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Read landed raw tables (one parquet folder per table) with their fixed schemas."""
    names = list(names or RAW_SCHEMAS_BY_NAME)
    return {n: spark.read.schema(RAW_SCHEMAS_BY_NAME[n]).parquet(f"{root.rstrip('/')}/{n}") for n in names}


MAX_RECORDS_PER_FILE = 5_000_000


def write_landed(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite",
                 files: int | None = None) -> None:
    """Land raw tables as parquet folders under ``root``.

    Per-table inputs are range-partitioned on (schema, table[, row_no]) into
    ``files`` partitions (default: by the size of the input, the cluster's parallelism at least) and sorted
    within each: a table's rows sit together and in order, readers get one
    split per file, and a table too big for one file is cut at row
    boundaries across several writers instead of landing in one task.
    ``maxRecordsPerFile`` bounds every file.
    """
    for name, df in tables.items():
        n = files or tasks_for(df)
        keys = [c for c in ("schema_name", "table_name", "row_no") if c in df.columns]
        out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) if keys else df.repartition(n)
        with shuffles_removed(df.sparkSession):
            (out.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
             .parquet(f"{root.rstrip('/')}/{name}"))


def land_describe(raw_describe: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Land DESCRIBE rows as the saved table ``table`` under ``path``, in buckets of (schema, table, block of lines).

    Sections and positions are computed per (table, block), so a reader of the landed table shuffles none of its rows
    for them; a table with very many lines has many blocks and lies in many buckets.  A bucket is what one task reads and
    numbers, so there are as many as the size of the input asks for.
    """
    n = buckets or tasks_for(raw_describe)
    blocked = raw_describe.withColumn(ROW_BLOCK, block_of("row_no", DEFAULT_BLOCK))
    keys = ["schema_name", "table_name", ROW_BLOCK]
    # One task a bucket: its rows are sorted once and lie in one file.
    with shuffles_removed(raw_describe.sparkSession):
        (blocked.repartition(n, *keys).write.mode("overwrite").option("path", path).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
         .bucketBy(n, *keys).sortBy(*keys, "row_no").saveAsTable(table))
    return raw_describe.sparkSession.table(table)


def relational_columns_jdbc(
    spark: SparkSession,
    url: str,
    schemas: Sequence[str] = ("public",),
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Column rows of a PostgreSQL-style catalog, shaped like ``pg_columns``.

    The schema IN-list is a DataFrame filter, which the JDBC source pushes
    into the remote WHERE clause.  ``num_partitions`` splits the read on the
    column ordinal.  Needs the JDBC driver jar on the classpath.
    """
    query = (
        "SELECT current_database() AS catalog_name, st.schemaname, st.relname AS table_name, "
        "a.attname AS col_name, format_type(a.atttypid, a.atttypmod) AS col_type, "
        "col_description(st.relid, a.attnum) AS col_description, a.attnum::int AS col_sort_order "
        "FROM pg_catalog.pg_statio_all_tables st "
        "JOIN pg_catalog.pg_attribute a ON a.attrelid = st.relid "
        "WHERE a.attnum > 0 AND NOT a.attisdropped"
    )
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS cols")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if num_partitions:
        reader = (reader.option("partitionColumn", "col_sort_order").option("lowerBound", "1")
                  .option("upperBound", "2000").option("numPartitions", str(num_partitions)))
    return reader.load().where(F.col("schemaname").isin(*schemas))
