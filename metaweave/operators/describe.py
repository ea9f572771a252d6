"""Items 5-8: ordered DESCRIBE rows -> typed column metadata and view properties.

Order carries meaning in DESCRIBE output, so every rule is expressed through
``row_no``; nothing relies on file or partition order.

Skew: a table may own any share of all DESCRIBE rows.  The positional rules
therefore never put a whole table into one window partition: rows are
numbered per (table, block of line numbers), and only per-block summaries
are combined per table.  Last-wins and partition flags are aggregates keyed
by (table, column name), partially aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metaweave.functions.exprs import is_describe_marker
from metaweave.functions.ordered import DEFAULT_BLOCK, block_of
from metaweave.functions.sizing import tasks_for
from metaweave.model import DETAILED_TABLE_MARKER, ROW_BLOCK, S, TABLE_KEYS, TB

SECTION_COLUMN = "column"
SECTION_MARKER = "marker"
SECTION_PARTITION = "partition"

MATCH_DATA_TYPE_FIRST = "data_type_first"
MATCH_NAME_FIRST = "name_first"

_BLK, _OFF, _FIRST = "_mw_blk", "_mw_off", "_mw_first_marker"


def annotate_describe(raw_describe: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """DESCRIBE rows + ``section`` and, for column rows, the 0-based ``sort_order``.

    A row is a ``marker`` when its name is empty or contains ``#``.  From the
    first marker on the table is in partition mode for good: later non-marker
    rows are ``partition`` rows.  ``sort_order`` counts column rows from 0.

    Rows are numbered per (table, block of ``block_size`` line numbers).  A
    row of a table's first block needs nothing else: its offset is 0 and the
    table's first marker, if it lies in that block, is the block's own.  Rows
    of later blocks get the count of rows and the first marker of all earlier
    blocks from a per-block summary; that summary only has rows for tables
    spanning several blocks, so the lookup is a join with a small table.
    Input landed in buckets of (table, block) (``sources.landed.land_describe``)
    is numbered where it lies, without a shuffle of its rows.
    """
    marker = is_describe_marker("col_name")
    landed = ROW_BLOCK in raw_describe.columns and block_size == DEFAULT_BLOCK
    d = raw_describe.withColumnRenamed(ROW_BLOCK, _BLK) if landed else raw_describe.withColumn(_BLK, block_of("row_no", block_size))
    per_block = d.groupBy(*TABLE_KEYS, _BLK).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(marker, F.col("row_no"))).alias("_mk"),
    )
    before = Window.partitionBy(*TABLE_KEYS).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    later_blocks = (
        per_block.select(
            *TABLE_KEYS, _BLK,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF),
            F.min("_mk").over(before).alias("_mw_marker_before"),
        )
        .where(F.col(_OFF) > 0)
    )
    block = Window.partitionBy(*TABLE_KEYS, _BLK)
    local = d.withColumns({
        "_mw_rn": F.row_number().over(block.orderBy("row_no")),
        "_mw_marker_here": F.min(F.when(marker, F.col("row_no"))).over(block),
    })
    first_marker = F.coalesce(F.col("_mw_marker_before"), F.col("_mw_marker_here"))
    section = (
        F.when(marker, SECTION_MARKER)
        .when(first_marker.isNotNull() & (F.col("row_no") > first_marker), SECTION_PARTITION)
        .otherwise(SECTION_COLUMN)
    )
    # Every row before the first marker is a column row, so a column row's
    # position among all rows of its table is its position among column rows.
    return (
        local.join(later_blocks, [*TABLE_KEYS, _BLK], "left")
        .withColumn("section", section)
        .withColumn(
            "sort_order",
            F.when(F.col("section") == SECTION_COLUMN,
                   (F.coalesce(F.col(_OFF), F.lit(0)) + F.col("_mw_rn") - 1).cast("int")),
        )
        .drop(_BLK, ROW_BLOCK, _OFF, "_mw_rn", "_mw_marker_here", "_mw_marker_before")
    )


def describe_sections(raw_describe: DataFrame) -> DataFrame:
    """Item 5: (schema_name, table_name, row_no, section)."""
    return annotate_describe(raw_describe).select(*TABLE_KEYS, "row_no", "section")


def describe_columns(annotated: DataFrame) -> DataFrame:
    """Item 6: one row per (table, column name) of the column section.

    A repeated name keeps the values of its last row, ``sort_order`` included
    (earlier rows still advanced the numbering, so gaps are legal).  An empty
    comment is a null description.  ``first_order`` is the position of its first
    row, where a record lists it.
    """
    last = F.max_by(
        F.struct(
            F.col("data_type"),
            F.nullif(F.col("comment"), F.lit("")).alias("description"),
            F.col("sort_order"),
        ),
        F.col("row_no"),
    )
    return (
        annotated.where(F.col("section") == SECTION_COLUMN)
        .groupBy(*TABLE_KEYS, "col_name")
        .agg(last.alias("_v"), F.min("sort_order").alias("first_order"))
        .select(*TABLE_KEYS, "col_name", "_v.data_type", "_v.description", "_v.sort_order", "first_order")
    )


def partition_columns(annotated: DataFrame, match: str = MATCH_DATA_TYPE_FIRST) -> DataFrame:
    """Item 7: the columns of :func:`describe_columns`, ``first_order`` last, + ``is_partition``.

    Each partition-section row marks one column: by default the column named
    by its ``data_type`` (Spark-2 / Delta style ``('Part 0', 'dt')``), else the
    column named by its ``col_name`` (Spark-3 style ``('dt', 'date')``).
    ``match="name_first"`` tries the name first.
    """
    if match not in (MATCH_DATA_TYPE_FIRST, MATCH_NAME_FIRST):
        raise ValueError(f"unknown match rule {match!r}")
    section = F.col("section")
    named, typed = F.col("col_name"), F.col("data_type")
    first, second = (typed, named) if match == MATCH_DATA_TYPE_FIRST else (named, typed)
    payload = F.struct(
        F.col("row_no"), F.col("data_type"),
        F.nullif(F.col("comment"), F.lit("")).alias("description"), F.col("sort_order"),
    )
    column = section == SECTION_COLUMN
    # Rows without a schema or table name belong to no table.
    keyed = F.col(S).isNotNull() & F.col(TB).isNotNull()
    # A column row gives its name; a partition row asks whether its first candidate is a column, and brings its second.
    # Struct order: the highest row_no wins.
    entries = (
        annotated.where(keyed & (section != SECTION_MARKER))
        .select(*TABLE_KEYS, F.when(column, named).otherwise(first).alias("name"),
                (~column).alias("asks"), F.when(~column, second).alias("second"), F.when(column, payload).alias("payload"),
                "sort_order")
        .groupBy(*TABLE_KEYS, "name", "asks", "second").agg(F.max("payload").alias("payload"), F.min("sort_order").alias("first_order"))
    )
    # One row a name and question by now, dealt by the size of the input: what a task sorts does not grow with it.
    tasks = tasks_for(annotated)
    entries = entries.repartition(tasks, *TABLE_KEYS, "name")
    # The name's own entry and all questions about it meet: the last of its values and whether it was asked for.
    same = Window.partitionBy(*TABLE_KEYS, "name")
    met = entries.withColumns({"is_column": F.max(~F.col("asks")).over(same), "asked": F.max("asks").over(same)})
    # A column keeps its row; a question about no column becomes a mark on the second candidate.
    marks = F.col("asks") & ~F.col("is_column")
    return (
        met.where(~F.col("asks") | marks)
        .select(*TABLE_KEYS, F.when(marks, F.col("second")).otherwise(F.col("name")).alias("col_name"),
                "payload", "first_order", F.when(marks, True).otherwise(F.col("asked")).alias("is_partition"))
        .repartition(tasks, *TABLE_KEYS, "col_name")
        .groupBy(*TABLE_KEYS, "col_name")
        .agg(F.max("payload").alias("last"), F.min("first_order").alias("first_order"), F.max("is_partition").alias("is_partition"))
        .where(F.col("last").isNotNull())
        .select(
            *TABLE_KEYS, "col_name",
            F.col("last.data_type").alias("data_type"),
            F.col("last.description").alias("description"),
            F.col("last.sort_order").alias("sort_order"),
            "is_partition", "first_order",
        )
    )


def _first_marker():
    return F.min(F.when(F.col("col_name").contains(DETAILED_TABLE_MARKER), F.col("row_no")))


def describe_properties(raw_describe_ext: DataFrame) -> DataFrame:
    """Item 8: DESCRIBE EXTENDED rows after the first ``# Detailed Table`` row as
    (schema_name, table_name, prop_key, prop_value); a repeated key keeps its
    last value.  A table without the marker has no properties.

    The last value of a key is a property if its row comes after the marker,
    so rows are reduced to one per (table, key) first and only those meet the
    marker; no raw row is gathered on its table.
    """
    last = raw_describe_ext.groupBy(*TABLE_KEYS, F.col("col_name").alias("prop_key")).agg(
        F.max(F.struct("row_no", F.col("data_type").alias("v"))).alias("_v"), _first_marker().alias("_own"))
    first = last.groupBy(*TABLE_KEYS).agg(F.min("_own").alias(_FIRST))
    return (
        last.join(first, TABLE_KEYS)
        .where(F.col("_v.row_no") > F.col(_FIRST))
        .select(*TABLE_KEYS, "prop_key", F.col("_v.v").alias("prop_value"))
    )


def view_details(raw_describe_ext: DataFrame) -> DataFrame:
    """One row per view that has DESCRIBE EXTENDED output, with the detail keys
    the model reads pivoted out (``format``, ``description``; last value wins).

    A view with output but without properties still has a (empty) detail.
    One aggregate per view with partial results per (view, block of lines), no
    join: the last row of a key counts if it comes after the view's marker.
    """
    def last_row(key: str):
        return F.max(F.when(F.col("col_name") == key, F.struct("row_no", F.col("data_type").alias("v"))))

    def after(c: str):
        return F.when(F.col(f"{c}.row_no") > F.col(_FIRST), F.col(f"{c}.v"))

    return (
        raw_describe_ext.where(F.col(S).isNotNull() & F.col(TB).isNotNull())
        # Partial results sort what a task holds; a scan task may hold far more than one part of these.
        .repartition(tasks_for(raw_describe_ext), *TABLE_KEYS, block_of("row_no", DEFAULT_BLOCK))
        .groupBy(*TABLE_KEYS)
        .agg(_first_marker().alias(_FIRST), last_row("format").alias("_f"), last_row("description").alias("_d"))
        .select(*TABLE_KEYS, after("_f").alias("format"), after("_d").alias("description"))
    )
