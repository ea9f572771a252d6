"""Skew-safe ordered helpers.

A group (one table's DESCRIBE rows, one table's columns, the whole record
stream) can be arbitrarily large, so nothing here puts a whole group into one
window partition or one ``collect_list``.  Each group is split into blocks by
the value of its integer order column: ``block = floor(order / block_size)``.
When the order column is unique inside a group (a line number, a sort order,
a listing ordinal) a block holds at most ``block_size`` rows, whatever the
size of the group.  Per-block work runs in parallel; only per-block summaries
(one row per block) are combined per group.  Where order values may repeat, be
null or be sparse, :func:`range_ordinal` cuts ranges of the data instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metaweave.functions.sizing import broadcast_if_small
from metaweave.session import materialize

DEFAULT_BLOCK = 1 << 14

_BLK, _CNT, _OFF = "_mw_blk", "_mw_cnt", "_mw_off"
_TIE, _PLACE, _RANGE, _FIRST = "_mw_tie", "_mw_place", "_mw_range", "_mw_first"
#: Lower bits of ``monotonically_increasing_id``: the place in the partition, whose number stands above them.
_PLACE_BITS = 33


def block_of(order: str, block_size: int):
    return F.floor(F.col(order) / F.lit(block_size)).cast("long")


def range_ordinal(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the 0-based dense position of each row in its ``by`` group by ``order``.

    Rows are dealt into ranges of ``(by, order)``, sorted inside each range and
    written to the shared folder; a row's place in its range plus the number of
    rows of its group in earlier ranges is its position, so nothing is shuffled
    again.  The place in the input is the last order column: rows whose order
    columns are all equal still spread over ranges, and a group or a tie of any
    size is shared by many tasks.  Null groups and null order values come first.

    The input should be a scan or a written hand-off with row-wise steps on top:
    the place of a row is then the same when a lost task runs again.
    """
    by, columns = list(by), df.columns
    order = [c if isinstance(c, Column) else F.col(c) for c in order]
    dealt = [*[F.col(c) for c in by], *order, F.col(_TIE)]
    placed = df.withColumn(_TIE, F.monotonically_increasing_id())
    placed = placed.repartitionByRange(partitions, *dealt) if partitions else placed.repartitionByRange(*dealt)
    placed = placed.sortWithinPartitions(*dealt).withColumn(_PLACE, F.monotonically_increasing_id()).drop(_TIE)
    placed = materialize(placed, "ordinals").withColumns({
        _RANGE: F.shiftright(_PLACE, _PLACE_BITS), _PLACE: F.col(_PLACE).bitwiseAND((1 << _PLACE_BITS) - 1)})
    ranges = placed.groupBy(*by, _RANGE).agg(F.count(F.lit(1)).alias(_CNT), F.min(_PLACE).alias(_FIRST))
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"_mw_key{i}" for i in range(len(by))]
    offsets = ranges.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(_RANGE).alias("_mw_of"),
        (F.coalesce(F.sum(_CNT).over(before), F.lit(0)) - F.col(_FIRST)).alias(_OFF))
    same = F.col(_RANGE) == F.col("_mw_of")
    for c, k in zip(by, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    # One row a range and group: few, unless there are very many groups.
    return placed.join(broadcast_if_small(offsets), same).withColumn(name, F.col(_OFF) + F.col(_PLACE)).select(*columns, name)


def block_ordinal(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    name: str = "ordinal",
    block_size: int = DEFAULT_BLOCK,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: the 0-based position of each row in its ``by`` group by ``order``.

    Equivalent to ``row_number() OVER (PARTITION BY by ORDER BY order) - 1``
    (nulls first, null group keys form a group), but the window runs per (group, block).  With an empty
    ``by`` this is a dense global numbering whose only single-task step sees
    one row per block.
    """
    by = list(by)
    numbered = df.withColumn(_BLK, F.coalesce(block_of(order, block_size), F.lit(-(1 << 62))))
    counts = numbered.groupBy(*by, _BLK).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.partitionBy(*by).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"_mw_key{i}" for i in range(len(by))]
    offsets = counts.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(_BLK).alias("_mw_block"),
                            F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    same = F.col(_BLK) == F.col("_mw_block")
    for c, k in zip(by, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    w = Window.partitionBy(*by, _BLK).orderBy(order, *tiebreak)
    return (
        numbered.join(offsets, same)
        .withColumn(name, F.col(_OFF) + F.row_number().over(w) - 1)
        .drop(_BLK, _OFF, "_mw_block", *keys)
    )


def ordered_collect(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value,
    name: str,
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """``by`` + ``name``: array of ``value`` in ``order`` order, nulls kept.

    Two-level: sorted per-block arrays first, then one concatenation of the
    (ordered) block arrays per group.
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    per_block = df.groupBy(*by, block_of(order, block_size).alias(_BLK)).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))),
            lambda x: x["v"],
        ).alias("_mw_part")
    )
    return per_block.groupBy(*by).agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(_BLK).alias("b"), F.col("_mw_part").alias("p")))),
                lambda x: x["p"],
            )
        ).alias(name)
    )


def ordered_join(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    text,
    name: str,
    sep: str,
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """``by`` + ``name``: ``text`` values joined by ``sep`` in ``order`` order.

    Null texts are skipped.  Two-level like :func:`ordered_collect`, but the
    per-block step already produces a string, so the final step concatenates
    one string per block.
    """
    by = list(by)
    text = F.col(text) if isinstance(text, str) else text
    per_block = (
        df.where(text.isNotNull())
        .groupBy(*by, block_of(order, block_size).alias(_BLK))
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("v")))),
                    lambda x: x["v"],
                ),
                sep,
            ).alias("_mw_part")
        )
    )
    return per_block.groupBy(*by).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(_BLK).alias("b"), F.col("_mw_part").alias("p")))),
                lambda x: x["p"],
            ),
            sep,
        ).alias(name)
    )
