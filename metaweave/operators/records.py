"""Items 13-17: metadata records, last-updated records, the record stream,
schema signatures and snapshot diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaweave.functions.exprs import epoch_seconds
from metaweave.functions.ordered import ordered_collect, ordered_join, range_ordinal
from metaweave.model import KIND_LAST_UPDATED, KIND_TABLE_METADATA, S, TABLE_KEYS, TB

#: Position of a column name's first row, where the snapshot knows it.
FIRST_ORDER = "first_order"


def table_metadata(tables: DataFrame, columns: DataFrame, database: str, cluster: str) -> tuple[DataFrame, DataFrame]:
    """Item 13: the metadata record of every table, normalised.

    Returns ``(table_records, column_records)``: one row per table
    (db, cluster, schema_name, table_name, description, is_view, table_ord,
    last_modified, n_columns) and one row per column of those tables
    (db, cluster, schema_name, table_name, col_name, description, col_type,
    sort_order).  ``is_partition`` is not part of the record.  Use
    :func:`nest_columns` for the nested record shape.
    """
    table_records = tables.select(
        F.lit(database).alias("db"), F.lit(cluster).alias("cluster"),
        S, TB, "description", "is_view", "table_ord", "last_modified", "n_columns")
    return table_records, column_records_of(columns, tables, database, cluster)


def column_records_of(columns: DataFrame, tables: DataFrame, database: str, cluster: str) -> DataFrame:
    """Column records (see :func:`table_metadata`) of the columns of ``tables``."""
    return columns.join(tables.select(*TABLE_KEYS), TABLE_KEYS, "left_semi").select(
        F.lit(database).alias("db"), F.lit(cluster).alias("cluster"),
        S, TB, "col_name", "description", F.col("data_type").alias("col_type"), "sort_order",
        *[c for c in columns.columns if c == FIRST_ORDER])


def _listed(columns: DataFrame) -> str:
    """The column that orders a record's columns: a repeated name stands where it came first, with its last values."""
    return FIRST_ORDER if FIRST_ORDER in columns.columns else "sort_order"


def nest_columns(table_records: DataFrame, column_records: DataFrame) -> DataFrame:
    """Table records with ``columns: array<struct<name, description, col_type, sort_order>>``
    in the order of their first rows (two-level ordered collect, see ``functions.ordered``)."""
    item = F.struct(F.col("col_name").alias("name"), "description", "col_type", "sort_order")
    nested = ordered_collect(column_records, TABLE_KEYS, _listed(column_records), item, "columns")
    return table_records.join(nested, TABLE_KEYS, "left")


def columns_text(column_records: DataFrame, name: str = "columns_text", sep: str = "|") -> DataFrame:
    """(schema_name, table_name, columns_text): ``sort_order:name:col_type:description``
    per column, in column order."""
    item = F.concat_ws(":", F.col("sort_order").cast("string"), "col_name", "col_type",
                       F.coalesce(F.col("description"), F.lit("")))
    return ordered_join(column_records, TABLE_KEYS, _listed(column_records), item, name, sep)


def table_last_updated(table_records: DataFrame) -> DataFrame:
    """Item 14: (db, cluster, schema_name, table_name, last_updated_time_epoch) for
    tables with a last-modified time; whole seconds, fraction dropped."""
    return table_records.where(F.col("last_modified").isNotNull()).select(
        "db", "cluster", S, TB, last_modified_epoch(table_records).alias("last_updated_time_epoch"))


def last_modified_epoch(table_records: DataFrame) -> Column:
    """Epoch seconds of ``last_modified``, which may be a naive time or an instant."""
    naive = isinstance(table_records.schema["last_modified"].dataType, T.TimestampNTZType)
    return epoch_seconds("last_modified", naive=naive)


def emit_records(table_records: DataFrame, last_updated: DataFrame | None = None) -> DataFrame:
    """Item 15: one record stream, each table's metadata record followed by its
    last-updated record, ordered by ``(table_ord, kind_ord)``.

    Both records come from the table's own row, without a join; last-updated
    records of another origin can be given as ``last_updated`` and then join
    their tables.  No total sort happens here; :func:`number_records` adds a
    dense ``emit_ord`` when a caller needs it.
    """
    meta = F.struct(
        F.lit(0).alias("kind_ord"), F.lit(KIND_TABLE_METADATA).alias("record_kind"),
        "description", "is_view", F.lit(None).cast("long").alias("last_updated_time_epoch"))
    updated = F.struct(
        F.lit(1).alias("kind_ord"), F.lit(KIND_LAST_UPDATED).alias("record_kind"),
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("boolean").alias("is_view"),
        F.col("last_updated_time_epoch"))
    if last_updated is None:
        tables = table_records.withColumn("last_updated_time_epoch", last_modified_epoch(table_records))
    else:
        tables = table_records.join(last_updated.select(*TABLE_KEYS, "last_updated_time_epoch"), TABLE_KEYS, "left")
    records = F.when(F.col("last_updated_time_epoch").isNull(), F.array(meta)).otherwise(F.array(meta, updated))
    out = tables.select("table_ord", "db", "cluster", S, TB, F.inline(records))
    return out.select("table_ord", "kind_ord", "record_kind", "db", "cluster", S, TB, "description", "is_view", "last_updated_time_epoch")


def number_records(records: DataFrame, name: str = "emit_ord") -> DataFrame:
    """Dense 1-based stream position in the order ``(table_ord, table, kind_ord)``.

    Ordinals may be sparse, repeated or null (null ordinals come first): ranges
    are cut on the whole order key, so records that share one ordinal, or are
    equal altogether, spread over as many tasks as any others; a table's records
    stay side by side."""
    key = ["table_ord", "db", "cluster", S, TB, "kind_ord"]
    numbered = range_ordinal(records, [], key, "_mw_pos")
    return numbered.select((F.col("_mw_pos") + 1).alias(name), *records.columns)


def table_signature(columns: DataFrame) -> DataFrame:
    """Item 16: (full_name, signature): ``schema.table`` and ``name:type,...`` in column order."""
    item = F.concat_ws(":", "col_name", "data_type")
    sig = ordered_join(columns, TABLE_KEYS, _listed(columns), item, "signature", ",")
    return sig.select(F.concat_ws(".", S, TB).alias("full_name"), "signature")


def with_attributes(columns: DataFrame) -> DataFrame:
    """Columns with the model's ``attributes``, empty where a snapshot has none of its own."""
    return columns if "attributes" in columns.columns else columns.withColumn("attributes", F.create_map().cast("map<string,string>"))


COMPARED = ["data_type", "description", "sort_order", "is_partition"]


def column_diff(columns_a: DataFrame, columns_b: DataFrame, include_same: bool = False) -> DataFrame:
    """Item 17: (schema_name, table_name, col_name, change) between two column
    snapshots: ``added`` / ``removed`` / ``changed`` (``same`` on request).
    Equality is null-safe on every compared field, ``attributes`` included
    when the snapshots carry it (compared as sorted entries).  A compared field
    that a snapshot lacks is an error, never silently equal."""
    keys = [*TABLE_KEYS, "col_name"]
    for side, columns in (("first", columns_a), ("second", columns_b)):
        missing = [c for c in [*keys, *COMPARED] if c not in columns.columns]
        if missing:
            raise ValueError(f"the {side} snapshot lacks {', '.join(missing)}")
    if ("attributes" in columns_a.columns) != ("attributes" in columns_b.columns):
        raise ValueError("only one snapshot carries attributes")
    fields = COMPARED
    extra = ["attributes"] if "attributes" in columns_a.columns else []
    a = columns_a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in fields],
                         *[F.array_sort(F.map_entries(c)).alias(f"a_{c}") for c in extra],
                         F.lit(True).alias("_a"))
    b = columns_b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in fields],
                         *[F.array_sort(F.map_entries(c)).alias(f"b_{c}") for c in extra],
                         F.lit(True).alias("_b"))
    same = F.lit(True)
    for c in fields + extra:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    change = (
        F.when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed")
        .when(same, "same")
        .otherwise("changed")
    )
    out = a.join(b, keys, "full_outer").select(*keys, change.alias("change"))
    return out if include_same else out.where(F.col("change") != "same")
