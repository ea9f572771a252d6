"""Sharding by a hypergeometric communication matrix, with Spark expressions only.

A uniform shuffle into shards whose row counts differ by at most one, without a global sort:

1. Rows get a stable row number (written once, with the row or with its place in the file it is read from) and a hash of it
   deals them to ``2**k`` blocks.
2. The communication matrix, block by shard, is drawn exactly: how many rows of each block a
   uniform permutation would send to each shard.  Blocks are halved again and again; at each
   split the left half's part of every shard's remaining capacity is drawn from the
   hypergeometric distribution, so rows and columns of the matrix add up to the block and shard sizes.
3. Each block permutes its rows locally (ranks under a hash) and cuts them by its matrix row.
4. After the exchange each shard permutes again: rows are dealt to cells of the shard by a hash,
   ranked in their cell, and a cell's slots follow those of the cells before it.

Blocks and cells have a bounded expected size, however many rows there are and whatever they
hold; only row numbers take part, and the rows themselves are joined back once.

Defined results: an empty table gives no rows; rows that repeat (ids, whole rows) are dealt
independently; nulls and texts play no part; with fewer rows than shards some stay empty.
Input columns named like an output column are renamed ``in_<name>``.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaweave.llm.common import free_names, let, written

SHARDS = 24
SEED = 6174
#: Expected rows of a block and of a cell, and the least number of blocks.
BLOCK_ROWS = 65_536
MIN_BLOCKS = 64


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(2.0**53)


def _ln_factorials(xs: Column) -> Column:
    """ln(x!) of an array of numbers by Stirling's series, shifted by eight so that it holds to double precision from 0 on."""
    def one(x: Column) -> Column:
        z = x + 9.0
        inverse = 1 / (z * z)
        series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + (
            F.lit(1 / 12.0) - (F.lit(1 / 360.0) - (F.lit(1 / 1260.0) - F.lit(1 / 1680.0) * inverse) * inverse) * inverse) / z
        product = x + 1.0
        for k in range(2, 9):
            product = product * (x + float(k))
        return series - F.ln(product)
    return F.transform(xs, one)


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Number of marked elements among ``draws`` from ``population``: the inverse distribution function at ``u``.

    The search covers twelve standard deviations either side of the mean, beyond which the
    probabilities vanish in double precision.
    """
    def search(v: Column) -> Column:
        n, m, d, first = v["n"], v["m"], v["d"], v["first"]

        def run(f: Column) -> Column:
            start = F.exp(f[0] - f[1] - f[2] + f[3] - f[4] - f[5] - f[6] + f[7] + f[8])

            def step(s: Column, _: Column) -> Column:
                p = s["p"] * (m - s["k"]) * (d - s["k"]) / ((s["k"] + 1) * (n - m - d + s["k"] + 1))
                return F.when(s["c"] > v["u"], s).otherwise(
                    let(p, lambda q: F.struct((s["k"] + 1).alias("k"), q.alias("p"), (s["c"] + q).alias("c"))))

            steps = F.when(v["last"] > first, F.sequence(F.lit(1).cast("long"), (v["last"] - first).cast("long"))).otherwise(
                F.array().cast("array<long>"))
            begin = let(start, lambda p: F.struct(first.alias("k"), p.alias("p"), p.alias("c")))
            return F.aggregate(steps, begin, step)["k"].cast("long")

        return let(_ln_factorials(F.array(m, first, m - first, n - m, d - first, n - m - d + first, n, d, n - d)), run)

    def bound(v: Column) -> Column:
        n, m, d = v["n"], v["m"], v["d"]
        mean = F.when(n > 0, d * m / n).otherwise(0.0)
        variance = F.when(n > 1, d * m / n * (1 - m / n) * (n - d) / (n - 1)).otherwise(0.0)

        def clip(w: Column) -> Column:
            low, high = F.greatest(F.lit(0.0), d + m - n), F.least(d, m)
            return F.struct(
                n.alias("n"), m.alias("m"), d.alias("d"), v["u"].alias("u"),
                F.greatest(low, F.floor(w["mean"] - w["spread"]).cast("double")).alias("first"),
                F.least(high, F.ceil(w["mean"] + w["spread"]).cast("double")).alias("last"))

        return let(F.struct(mean.alias("mean"), (12 * F.sqrt(F.greatest(F.lit(0.0), variance)) + 12).alias("spread")), clip)

    given = F.struct(population.cast("double").alias("n"), marked.cast("double").alias("m"), draws.cast("double").alias("d"), u.alias("u"))
    return let(let(given, bound), search)


def communication_matrix(blocks: DataFrame, rows: int, shards: int, levels: int, seed: int = SEED) -> DataFrame:
    """``block`` and ``to`` (rows it sends to each shard) from ``block`` and ``n`` of all ``2**levels`` blocks."""
    caps = [rows // shards + (s < rows % shards) for s in range(shards)]
    # One row of 2**levels counts, in block order; blocks hold at least thousands of rows each.
    tree = blocks.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "n"))), lambda x: x["n"]).alias("counts"))
    tree = tree.select(F.lit(1).cast("long").alias("node"), "counts", F.array(*[F.lit(c).cast("long") for c in caps]).alias("to"))

    for level in range(levels):
        half = 1 << (levels - level - 1)
        left = F.slice("counts", 1, half)
        begin = F.struct(
            F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("left_over"),
            F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("draws"), F.array().cast("array<long>").alias("to"))

        def deal(state, shard):
            cap = F.element_at(F.col("to"), shard + 1)
            k = hypergeometric(state["left_over"], cap, state["draws"], _uniform(F.lit(seed), F.col("node"), shard))
            return let(k, lambda x: F.struct(
                (state["left_over"] - cap).alias("left_over"), (state["draws"] - x).alias("draws"), F.concat(state["to"], F.array(x)).alias("to")))

        drawn = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), begin, deal)["to"]
        tree = tree.select("node", "counts", "to", drawn.alias("mine")).select(F.inline(F.array(
            F.struct((F.col("node") * 2).alias("node"), left.alias("counts"), F.col("mine").alias("to")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.slice("counts", half + 1, half).alias("counts"),
                     F.zip_with("to", "mine", lambda a, b: a - b).alias("to")))))
        if level >= 7:
            tree = tree.repartition("node")  # deep trees are drawn by many tasks
    return tree.select((F.col("node") - (1 << levels)).alias("block"), "to")


def _places(df: DataFrame) -> DataFrame | None:
    """``df`` with ``_row``, the file and the place in it that each row was read from; nothing if that does not name a row once."""
    try:
        placed = df.withColumn("_row", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")))
        return placed if placed.groupBy("_row").count().where("count > 1").isEmpty() else None
    except AnalysisException:  # not read from files
        return None


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS, stored: bool = False) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (its place in the shard, gapless from 0).

    With ``stored``, rows that files hold as they are get no second copy: only their places are written beside their numbers.
    """
    spark = df.sparkSession
    free = free_names(df, ["shard", "slot", "_row"])
    base = _places(free) if stored else None
    number = F.monotonically_increasing_id()
    if base is not None:
        dealt = written(base.select("_row", number.alias("number")), "row-numbers", compression="zstd")
    else:
        base = written(free.withColumn("_row", number), "numbered-rows", compression="zstd")
        dealt = base.select("_row", F.col("_row").alias("number"))
    rows = dealt.count()
    levels = max(int(math.log2(MIN_BLOCKS)), math.ceil(math.log2(max(1, rows / block_rows))))
    block = F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(1 << levels))
    dealt = dealt.select("_row", "number", block.alias("block"))
    sizes = spark.range(1 << levels).select(F.col("id").alias("block")).join(
        dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "block", "left")
    matrix = communication_matrix(sizes.select("block", F.coalesce("n", F.lit(0)).alias("n")), rows, shards, levels, seed)
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice("to", 1, i), F.lit(0).cast("long"), lambda a, x: a + x))
    matrix = written(matrix.select("block", upto.alias("upto")), "communication-matrix")

    cells = max(1, math.ceil(rows / shards / block_rows))
    here = W.partitionBy("block").orderBy(F.xxhash64("number", F.lit(seed + 1)), "number")
    ranked = dealt.withColumn("rank", F.row_number().over(here) - 1).join(matrix, "block")
    sent = ranked.select("_row", "number", F.size(F.filter("upto", lambda c: c <= F.col("rank"))).alias("shard"),
                         F.pmod(F.xxhash64("number", F.lit(seed + 2)), F.lit(cells)).alias("cell"))
    sent = written(sent, "sent-rows")
    filled = sent.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    filled = filled.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    there = W.partitionBy("shard", "cell").orderBy(F.xxhash64("number", F.lit(seed + 3)), "number")
    placed = sent.withColumn("rank", F.row_number().over(there) - 1).join(filled, ["shard", "cell"])
    placed = placed.select("_row", "shard", (F.col("before") + F.col("rank")).alias("slot"))
    return base.join(placed, "_row").drop("_row")
