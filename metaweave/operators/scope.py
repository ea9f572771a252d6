"""Items 1-3: which tables are in scope, and the relational catalog source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.model import S, TB

SchemaSet = DataFrame | Sequence[str] | None


def _restrict(df: DataFrame, schemas: DataFrame | Sequence[str], keep: bool) -> DataFrame:
    """Keep (or drop) rows whose ``schema_name`` is in ``schemas``; exact, case-sensitive.

    A Python list becomes a literal IN filter that reaches the parquet scan; a
    DataFrame becomes a semi/anti join that AQE turns into a broadcast join
    only when the runtime size of the list is under the broadcast threshold.
    """
    if isinstance(schemas, DataFrame):
        return df.join(schemas.select(S), S, "left_semi" if keep else "left_anti")
    names = sorted(set(schemas))
    if not names:
        return df.where(F.lit(not keep))
    cond = F.col(S).isin(*names)
    return df.where(cond if keep else ~cond)


def _with_unnamed(scoped: DataFrame, raw_tables: DataFrame) -> DataFrame:
    # Entries without a schema (temporary views) are listed under every schema;
    # they stay in scope once so that ``drop_unscrapable`` can reject them.
    return scoped.unionByName(raw_tables.where(F.col(S).isNull()))


def in_scope(df: DataFrame, raw_schemas: DataFrame, include: SchemaSet = None, exclude: SchemaSet = None) -> DataFrame:
    """Rows of any table keyed by ``schema_name`` whose schema is in scope.

    Applied to the big DESCRIBE tables before any other work, so tables out
    of scope are never shuffled (a list filter even reaches the scan).
    """
    if isinstance(include, DataFrame):
        # Only a list with entries wins; whether it has any is a subquery, not a job of its own.
        fallback = in_scope(df, raw_schemas, None, exclude).where(~include.exists())
        return _restrict(df, include, keep=True).unionByName(fallback)
    if include:
        return _restrict(df, include, keep=True)
    kept = raw_schemas.select(S)
    if exclude is not None:
        kept = _restrict(kept, exclude, keep=False)
    return df.join(kept, S, "left_semi")


def prune_to_scope(df: DataFrame, include: SchemaSet = None, exclude: SchemaSet = None) -> DataFrame:
    """Drop rows of big per-table inputs (DESCRIBE output, details) outside the
    include / exclude lists before any shuffle.  Without a list nothing is
    pruned: the scoped listing decides which tables appear in the results.
    """
    if isinstance(include, DataFrame):
        fallback = prune_to_scope(df, None, exclude).where(~include.exists())
        return _restrict(df, include, keep=True).unionByName(fallback)
    if include:
        return _restrict(df, include, keep=True)
    if exclude is not None and (isinstance(exclude, DataFrame) or len(exclude) > 0):
        return _restrict(df, exclude, keep=False)
    return df


def scope_exclude(raw_schemas: DataFrame, raw_tables: DataFrame, exclude: SchemaSet = None) -> DataFrame:
    """Tables of every listed schema that is not excluded (item 1)."""
    return _with_unnamed(in_scope(raw_tables, raw_schemas, None, exclude), raw_tables)


def scope_include(
    raw_schemas: DataFrame,
    raw_tables: DataFrame,
    include: SchemaSet = None,
    exclude: SchemaSet = None,
) -> DataFrame:
    """Tables in scope (item 2): a given include list wins outright over the exclude list.

    An include list without entries, be it a Python list or a DataFrame,
    counts as not given.  Repeated include entries select a table once.
    """
    return _with_unnamed(in_scope(raw_tables, raw_schemas, include, exclude), raw_tables)


def relational_catalog(
    pg_columns: DataFrame,
    schemas: Sequence[str] = ("public",),
    database: str = "postgres",
    cluster: str | None = None,
    catalog_as_cluster: bool = True,
) -> DataFrame:
    """Relational catalog column rows in the model's shape (item 3).

    Output: db, cluster, schema_name, table_name, col_name, col_type,
    description, sort_order.  With ``catalog_as_cluster`` the catalog name is
    the cluster; otherwise ``cluster`` is required.  Rows without a catalog,
    table or column name can form no key and are left to
    :func:`relational_rejects`.
    """
    if not catalog_as_cluster and cluster is None:
        raise ValueError("cluster is required when catalog_as_cluster is False")
    cluster_col = F.col("catalog_name") if catalog_as_cluster else F.lit(cluster)
    return pg_columns.where(F.col("schemaname").isin(*schemas) & _reject_reason(catalog_as_cluster).isNull()).select(
        F.lit(database).alias("db"),
        cluster_col.alias("cluster"),
        F.col("schemaname").alias(S),
        F.col(TB),
        F.col("col_name"),
        F.col("col_type"),
        F.col("col_description").alias("description"),
        F.col("col_sort_order").alias("sort_order"),
    )


def _reject_reason(catalog_as_cluster: bool):
    reason = F.when(F.col(TB).isNull(), "no_table").when(F.col("col_name").isNull(), "no_column")
    return reason.when(F.col("catalog_name").isNull(), "no_catalog") if catalog_as_cluster else reason


def relational_rejects(pg_columns: DataFrame, schemas: Sequence[str] = ("public",), catalog_as_cluster: bool = True) -> DataFrame:
    """Rows of the chosen schemas that :func:`relational_catalog` leaves out, with their ``reason``."""
    return pg_columns.where(F.col("schemaname").isin(*schemas)).withColumn("reason", _reject_reason(catalog_as_cluster)).where("reason IS NOT NULL")
