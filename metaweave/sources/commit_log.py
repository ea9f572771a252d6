"""Commit logs of lake tables: one JSON file per version, and Parquet checkpoints that sum up all versions before them.

A table's log lies in ``<table>/_delta_log``: ``<version>.json`` holds one action a line, ``<version>.checkpoint.parquet`` (or
``<version>.checkpoint.<part>.<parts>.parquet``) holds the state at a version.  Versions have twenty digits.  Only the fields
that table details need are read.  :func:`read_commit_logs` reads the logs of many tables in one scan each; logs that a
crawler has landed as lines (``file_path``, ``line``) go through :func:`parse_landed_lines` and give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_INFO = "commitInfo struct<timestamp:bigint,operation:string>"
STATE = ("metaData struct<id:string,description:string,format:struct<provider:string>>, "
         "add struct<path:string,size:bigint,modificationTime:bigint>, remove struct<path:string,deletionTimestamp:bigint>")
ACTIONS = f"{COMMIT_INFO}, {STATE}"
STATE_FIELDS = ["metaData", "add", "remove"]

COMMIT_FILE = r"^(.*)/_delta_log/([0-9]{20})\.json$"
CHECKPOINT_FILE = r"^(.*)/_delta_log/([0-9]{20})\.checkpoint(?:\.([0-9]{10})\.([0-9]{10}))?\.parquet$"


def _decoded(path: str) -> F.Column:
    """File paths of scans are URI-encoded; a plus sign in them is a plus sign."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def commit_rows(actions: DataFrame, path: str = "file_path") -> DataFrame:
    """``(table_path, version, commitInfo, metaData, add, remove)`` of actions with the path of their commit file.

    Files of other names (checksums, compacted logs) are left out."""
    named = actions.where(F.col(path).rlike(COMMIT_FILE))
    return named.select(F.regexp_extract(path, COMMIT_FILE, 1).alias("table_path"),
                        F.regexp_extract(path, COMMIT_FILE, 2).cast("long").alias("version"), "commitInfo", *STATE_FIELDS)


def checkpoint_rows(actions: DataFrame, path: str = "file_path") -> DataFrame:
    """``(table_path, version, part, parts, metaData, add, remove)`` of actions with the path of their checkpoint file."""
    named = actions.where(F.col(path).rlike(CHECKPOINT_FILE))

    def number(group: int) -> F.Column:
        return F.coalesce(F.nullif(F.regexp_extract(path, CHECKPOINT_FILE, group), F.lit("")).cast("int"), F.lit(1))

    return named.select(
        F.regexp_extract(path, CHECKPOINT_FILE, 1).alias("table_path"), F.regexp_extract(path, CHECKPOINT_FILE, 2).cast("long").alias("version"),
        number(3).alias("part"), number(4).alias("parts"), *STATE_FIELDS)


def parse_landed_lines(lines: DataFrame) -> DataFrame:
    """Landed log lines ``(file_path, line)`` as :func:`commit_rows`; a line that is no JSON object has no action."""
    parsed = lines.select("file_path", F.from_json("line", ACTIONS).alias("a")).select("file_path", "a.*")
    return commit_rows(parsed)


def read_commit_logs(spark: SparkSession, tables: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(commits, checkpoints)`` of the logs of ``tables``, in the shapes of :func:`commit_rows` and :func:`checkpoint_rows`.

    ``tables`` are table folders or globs of them (``/lake/*/*``): Spark's listing passes over folders that begin with
    an underscore unless they are named."""
    logs = [f"{t.rstrip('/')}/_delta_log" for t in tables]
    commits = spark.read.option("pathGlobFilter", "*.json").schema(ACTIONS).json(logs)
    checkpoints = spark.read.option("pathGlobFilter", "*.checkpoint*.parquet").schema(STATE).parquet(*logs)
    return (commit_rows(commits.select("_metadata.file_path", "commitInfo", *STATE_FIELDS).withColumn("file_path", _decoded("file_path"))),
            checkpoint_rows(checkpoints.select("_metadata.file_path", *STATE_FIELDS).withColumn("file_path", _decoded("file_path"))))
