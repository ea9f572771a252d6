"""Item 24: publish search documents behind a stable name.

Each run writes a new, uniquely named table.  What the alias shall point at is then committed as the next version of a small
record in the warehouse (``sources.versions``): the writer names the version it builds on, and if another publisher has
committed meanwhile it reads that one's record and tries again, so the record lists every published table and none is lost.
The alias itself is a persistent view, repointed in one catalog operation to the newest committed version, so readers see the
old or the new documents, never a mix; a publisher that was overtaken repoints it to the newer version.  The
``keep_previous`` tables before the current one stay, so that a reader that is still at one of them can finish; older ones go.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from metaweave.sources.versions import commit_version, read_version, versions

TARGET_PROPERTY = "metaweave.target"
#: Earlier targets that still exist, newest first, comma-separated.
PREVIOUS_PROPERTY = "metaweave.previous"
VERSION_PROPERTY = "metaweave.version"
KEEP_PREVIOUS = 3
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _check_ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def _properties(spark: SparkSession, alias: str) -> dict[str, str]:
    if not spark.catalog.tableExists(_check_ident(alias)):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {alias}").collect()}


def current_target(spark: SparkSession, alias: str) -> str | None:
    """The table the alias points at, or None when the alias does not exist."""
    return _properties(spark, alias).get(TARGET_PROPERTY)


def _record_folder(spark: SparkSession, alias: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_aliases/{_check_ident(alias).lower()}"


def _record(spark: SparkSession, alias: str) -> tuple[int, dict]:
    """The newest committed version of an alias and its record: ``target`` and earlier targets, newest first."""
    folder = _record_folder(spark, alias)
    newest = max(versions(spark, folder), default=0)
    if newest:
        return newest, json.loads(read_version(spark, folder, newest))
    own = _properties(spark, alias)  # an alias without a record: its view tells
    return 0, {"target": own.get(TARGET_PROPERTY), "previous": [t for t in own.get(PREVIOUS_PROPERTY, "").split(",") if t]}


def _repoint(spark: SparkSession, alias: str) -> None:
    """Point the view at the newest committed version, also if that changes meanwhile."""
    shown = None
    while (now := _record(spark, alias)) != shown:
        version, record = shown = now
        spark.sql(
            f"CREATE OR REPLACE VIEW {alias} TBLPROPERTIES ('{TARGET_PROPERTY}' = '{record['target']}', "
            f"'{PREVIOUS_PROPERTY}' = '{','.join(record['previous'])}', '{VERSION_PROPERTY}' = '{version}') AS SELECT * FROM {record['target']}")


def publish_index(
    docs: DataFrame,
    run_id: str | None = None,
    alias: str = "table_search_index",
    prefix: str = "tables_",
    keep_previous: int = KEEP_PREVIOUS,
) -> str:
    spark = docs.sparkSession
    run_id = run_id or uuid.uuid4().hex
    target = _check_ident(f"{prefix}{run_id}")
    _check_ident(alias)
    docs.write.mode("errorifexists").format("parquet").saveAsTable(target)
    while True:
        version, before = _record(spark, alias)
        earlier = [t for t in [before["target"], *before["previous"]] if t and t != target]
        record = json.dumps({"target": target, "previous": earlier[:keep_previous]})
        if commit_version(spark, _record_folder(spark, alias), version + 1, record):
            break
    _repoint(spark, alias)
    for table in earlier[keep_previous:]:
        spark.sql(f"DROP TABLE IF EXISTS {_check_ident(table)}")
    return target


def read_index(spark: SparkSession, alias: str = "table_search_index") -> DataFrame:
    return spark.table(_check_ident(alias))
