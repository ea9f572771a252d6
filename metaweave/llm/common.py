"""Helpers shared by the operators: shared-folder hand-offs, column names, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.session import CLEANUP as CLEANUP
from metaweave.session import scratch_path, shuffles_removed


def free_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` with every column that clashes with one of ``names`` renamed ``in_<name>``.

    Names compare without case, as Spark resolves them; ``in_`` is repeated until the new
    name is free.
    """
    taken = {n.lower() for n in names}
    columns = []
    used = {c.lower() for c in df.columns} | taken
    for c in df.columns:
        new = c
        if c.lower() in taken:
            new = f"in_{c}"
            while new.lower() in used:
                new = f"in_{new}"
            used.add(new.lower())
        columns.append(new)
    return df.toDF(*columns)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, which keeps nested expressions small."""
    return F.transform(F.array(value), then)[0]


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read back: cuts the lineage, survives lost executors.

    Nothing reads the write's shuffle files again, so they go with it and the disk holds those of one write at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write.option("compression", compression) if compression else df.write
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.parquet(path)


#: Bits of the bitmap of ``maybe_among``, in pieces of 32768: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25


def maybe_among(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among ``wanted_key``'s values; none that is gets lost.

    The wanted keys set bits of a bitmap whose size is fixed, so it can be broadcast.  Put before a join it keeps most rows
    that would not match out of the exchange; beyond about ``bits`` wanted keys it lets most rows through.
    """
    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(bits)) + 1  # from 1: the bitmap functions begin their pieces there

    bitmap = wanted.groupBy(F.bitmap_bucket_number(slot(wanted_key)).alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot(wanted_key))).alias("_bits"))
    place = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("int")) != 0
    return df.join(F.broadcast(bitmap), (F.bitmap_bucket_number(slot(key)) == F.col("_piece")) & is_set, "left_semi")


def sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal first columns of sorted batches, whole even where a run crosses batches."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        key = np.asarray(table.column(0).combine_chunks())
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        edges = [0, *cut.tolist()]
        table = table.combine_chunks()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield table.slice(a, b - a)
        rest = table.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; component is the smallest node connected to it.

    Alternates large-star and small-star steps (every node points at the smallest node it
    sees) until the edges no longer change.  Each step is a minimum per node, with map-side
    combine, joined back to the edges; every round is written to the shared folder.  The
    driver only compares one count and one checksum a round.
    """
    e = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
    e = e.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        # Large star: each larger neighbour of u links to the smallest of u and its neighbours.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: u and its smaller neighbours link to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
