"""Items 20 and 23: CSV hand-off of the graph, JSON hand-off of search documents.

CSV is lossless and splittable: nulls are written as ``\\N`` and empty strings as ``""``; inside texts a backslash becomes
``\\\\``, a line feed ``\\n`` and a carriage return ``\\r`` (so a literal ``\\N`` is not a null); every field is quoted and keeps
its outer blanks, and the reader uses the same options and an explicit schema.  A record is one line, so a large file is
read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaweave.model import EDGES, NODES, SEARCH_DOCS

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "\\N",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
MAX_RECORDS_PER_FILE = 5_000_000
_BACKSLASH = "\\"


def _escaped(c: Column) -> Column:
    for plain, mark in ((_BACKSLASH, _BACKSLASH), ("\n", "n"), ("\r", "r")):
        c = F.replace(c, F.lit(plain), F.lit(_BACKSLASH + mark))
    return c


def _plain(c: Column) -> Column:
    """Inverse of :func:`_escaped`: every second of two backslashes is told from the mark of a line break by the split."""
    def line_breaks(part):
        return F.replace(F.replace(part, F.lit(_BACKSLASH + "n"), F.lit("\n")), F.lit(_BACKSLASH + "r"), F.lit("\r"))

    # Doubled backslashes are read left to right, so what lies between them holds none of their halves.
    pieces = F.transform(F.split(c, r"\\\\"), line_breaks)
    return F.when(F.contains(c, F.lit(_BACKSLASH)), F.array_join(pieces, _BACKSLASH)).otherwise(c)


def _texts(df: DataFrame, but: str | None, change) -> DataFrame:
    """``df`` with ``change`` applied to its string columns, the partition column excepted."""
    return df.select(*[
        change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) and f.name != but else F.col(f.name)
        for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, partition_by: str | None = None,
              max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    escaped = _texts(df, partition_by, _escaped)
    writer = escaped.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None) -> DataFrame:
    return _texts(spark.read.options(**CSV_OPTIONS).schema(schema).csv(path), partition_by, _plain)


def write_nodes_csv(nodes: DataFrame, out_dir: str) -> None:
    """Nodes under ``out_dir/nodes`` partitioned by label."""
    write_csv(nodes, f"{out_dir}/nodes", "label")


def write_edges_csv(edges: DataFrame, out_dir: str) -> None:
    """Relationships under ``out_dir/relationships`` partitioned by type."""
    write_csv(edges, f"{out_dir}/relationships", "type")


def read_nodes_csv(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_csv(spark, f"{out_dir}/nodes", NODES, "label").select(*NODES.fieldNames())


def read_edges_csv(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_csv(spark, f"{out_dir}/relationships", EDGES, "type").select(*EDGES.fieldNames())


def write_graph_csv(nodes: DataFrame, edges: DataFrame, out_dir: str) -> None:
    write_nodes_csv(nodes, out_dir)
    write_edges_csv(edges, out_dir)


def read_graph_csv(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    return read_nodes_csv(spark, out_dir), read_edges_csv(spark, out_dir)


def write_json(df: DataFrame, path: str) -> None:
    """Search documents as JSON lines, replacing the previous run's output."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType = SEARCH_DOCS) -> DataFrame:
    return spark.read.schema(schema).json(path)
