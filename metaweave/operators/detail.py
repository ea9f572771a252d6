"""Items 4, 9-12: table / view details, rejects and the delta filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.functions.exprs import is_delta_format, is_view_type
from metaweave.model import (
    REASON_KEPT,
    REASON_NO_COLUMNS,
    REASON_NO_DETAIL,
    REASON_NO_SCHEMA,
    S,
    TABLE_KEYS,
)


def commit_log_detail(raw_commits: DataFrame) -> DataFrame:
    """Item 4: table detail from a commit log, one row per ``table_id``.

    ``last_modified`` is the newest commit; ``format`` and ``description`` come
    from the latest commit that carries metadata (a non-null format).
    One partial aggregate: a table with very many commits never sits in one task.
    """
    meta = F.expr("max_by(struct(format, description), version) FILTER (WHERE format IS NOT NULL)")
    return (
        raw_commits.groupBy("table_id")
        .agg(F.max("commit_ts").alias("last_modified"), meta.alias("_m"))
        .select("table_id", "last_modified", F.col("_m.format").alias("format"),
                F.col("_m.description").alias("description"))
    )


def commit_log_table_detail(raw_commits: DataFrame, table_ids: DataFrame) -> DataFrame:
    """Commit-log detail in the shape of ``raw_table_detail`` (schema_name,
    table_name, format, description, last_modified), for ``lake_catalog(...,
    table_detail=...)``.  ``table_ids`` maps ``table_id`` to ``schema_name``,
    ``table_name``; tables without commits get no detail row."""
    return commit_log_detail(raw_commits).join(table_ids.select("table_id", *TABLE_KEYS), "table_id").select(
        *TABLE_KEYS, "format", "description", "last_modified")


def route_kind(raw_tables: DataFrame) -> DataFrame:
    """Item 9: ``is_view`` is true for a null, empty or ``view`` (any case) type."""
    return raw_tables.withColumn("is_view", is_view_type("table_type"))


def attach_details(routed: DataFrame, table_detail: DataFrame, view_detail: DataFrame) -> DataFrame:
    """Item 10: pick ``format``, ``description``, ``last_modified`` from the table
    detail (tables) or the view properties (views); ``has_detail`` says whether
    the applicable detail exists.  A view's last-modified is never read
    (its properties hold text), so it is null.
    """
    td = table_detail.select(
        *TABLE_KEYS,
        F.col("format").alias("_t_format"),
        F.col("description").alias("_t_description"),
        F.col("last_modified").alias("_t_last_modified"),
        F.lit(True).alias("_t_has"),
    )
    vd = view_detail.select(
        *TABLE_KEYS,
        F.col("format").alias("_v_format"),
        F.col("description").alias("_v_description"),
        F.lit(True).alias("_v_has"),
    )
    v = F.col("is_view")
    return (
        routed.join(td, TABLE_KEYS, "left")
        .join(vd, TABLE_KEYS, "left")
        .withColumns({
            "has_detail": F.when(v, F.coalesce("_v_has", F.lit(False))).otherwise(F.coalesce("_t_has", F.lit(False))),
            "format": F.when(v, F.col("_v_format")).otherwise(F.col("_t_format")),
            "description": F.when(v, F.col("_v_description")).otherwise(F.col("_t_description")),
            "last_modified": F.when(~v, F.col("_t_last_modified")),
        })
        .drop("_t_format", "_t_description", "_t_last_modified", "_t_has", "_v_format", "_v_description", "_v_has")
    )


def column_counts(columns: DataFrame) -> DataFrame:
    return columns.groupBy(*TABLE_KEYS).agg(F.count(F.lit(1)).cast("int").alias("n_columns"))


def drop_unscrapable(scraped: DataFrame, columns: DataFrame) -> DataFrame:
    """Item 11: every scraped entry with ``n_columns`` and a ``reason``:
    ``no_schema``, ``no_detail``, ``no_columns`` (tested in that order) or ``kept``.

    ``kept(...)`` / ``rejects(...)`` split the result.
    """
    n = F.coalesce(F.col("n_columns"), F.lit(0))
    reason = (
        F.when(F.col(S).isNull(), REASON_NO_SCHEMA)
        .when(~F.col("has_detail"), REASON_NO_DETAIL)
        .when(n == 0, REASON_NO_COLUMNS)
        .otherwise(REASON_KEPT)
    )
    return (
        scraped.join(column_counts(columns), TABLE_KEYS, "left")
        .withColumn("n_columns", n.cast("int"))
        .withColumn("reason", reason)
    )


def kept(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason") == REASON_KEPT)


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason") != REASON_KEPT)


def delta_filter(kept_tables: DataFrame, delta_only: bool = True) -> DataFrame:
    """Item 12: with ``delta_only`` keep rows whose format is ``delta`` (any case)."""
    return kept_tables.where(is_delta_format("format")) if delta_only else kept_tables
