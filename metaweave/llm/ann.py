"""Approximate nearest neighbours with a permutation index.

Vectors that are near see the same pivots near.  Every distinct vector is represented by its
``PREFIX`` nearest of ``PIVOTS`` pivots in order, and each block of vectors posts them in one
inverted file a pivot.  A query walks the files of its own nearest pivots and ranks the block's
vectors by the footrule distance of the two orders (a pivot missing from an order counts as if
it stood at its end); the best ``RERANK`` part of each block, ``LEAST`` at least, is scored exactly.

Equal vectors are merged first.  Of one vector's ids the k + 1 smallest are enough to answer any
query exactly, since ties go to the smaller id and a query leaves out one id at most; they
are cut down before the exchange.  Queries (a stated set) meet the vectors in blocks of bounded
size; only each block's best rows leave it.

Each length of vectors is an index of its own, since a cosine needs two of one length.  Its pivots are a
sample: the ``PIVOTS`` distinct vectors with the smallest hash.  Every vector is indexed; a length of at most
``LEAST`` vectors is scored whole and needs no pivots, so the pivots held are a part of the vectors
with a bound for each length only.  Before squaring, vectors are scaled by a power of two, which leaves every cosine
the same to the bit and keeps huge and tiny components from overflowing.

Defined results: null, empty, zero vectors and vectors with null or non-finite components take
no part, nor do rows without an id; rows that repeat an id and vector count once; fewer candidates
(of the query's length) than k are all returned; no vectors, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaweave.functions.sizing import broadcast_if_small
from metaweave.llm.common import sorted_groups, written

PIVOTS = 512
PREFIX = 128
RERANK = 0.16
LEAST = 256
VECTOR_BLOCK = 8192
QUERY_BLOCK = 512


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, the largest component of each between a half and one."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])


def _matrix(column) -> np.ndarray:
    """Vectors of one length, scaled."""
    flat = np.asarray(column.flatten(), np.float64)
    return scaled(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


def _prefixes(pivots, length: int):
    """``mapInArrow``: appends each vector's nearest pivots of its length, in order, as bytes (16 bits each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("vec"))
            dims, prefix = np.asarray(pc.list_value_length(column)), [b""] * len(column)
            for d in np.unique(dims).tolist():
                if d in pivots.value:
                    at = np.flatnonzero(dims == d)
                    x = _matrix(column.take(pa.array(at)))
                    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ pivots.value[d].T
                    order = np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.uint16)
                    for i, own in zip(at.tolist(), order, strict=True):
                        prefix[i] = own.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prefix, pa.binary())], names=[*batch.schema.names, "prefix"])
    return run


def postings(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverted files of a block: rows and positions ordered by pivot, and where each pivot's file begins."""
    rows, length = prefix.shape
    pivot = prefix.ravel().astype(np.int64)
    order = np.argsort(pivot, kind="stable")
    begins = np.searchsorted(pivot[order], np.arange(pivot.max(initial=0) + 2))
    return order // length, order % length, begins


def closeness(own: np.ndarray, files, rows: int) -> np.ndarray:
    """For each row of a block how far its order's footrule distance from ``own`` is below the largest, halved.

    Two orders of ``length`` pivots with ``p`` and ``q`` as the positions of a common pivot are
    ``sum(2 * (length - max(p, q)))`` over the common pivots closer than orders without one.
    """
    row, position, begins = files
    length, score = len(own), np.zeros(rows, np.int32)
    for at, pivot in enumerate(own.tolist()):
        if pivot + 1 < len(begins):
            a, b = begins[pivot], begins[pivot + 1]
            score[row[a:b]] += (length - np.maximum(position[a:b], at)).astype(np.int32)
    return score


def _search(k: int, rerank: float, least: int):
    """``mapInArrow`` over tasks (a block of vectors and a block of queries): each query's best k + 1 ids of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            query = np.asarray(group.column("is_query"))
            x = _matrix(group.column("vec").combine_chunks())
            prefix = np.frombuffer(b"".join(group.column("prefix").to_pylist()), np.uint16).reshape(len(x), -1)
            key, ids = np.asarray(group.column("key")), group.column("ids").to_pylist()
            at = np.flatnonzero(~query)
            if not len(at) or not query.any():
                continue
            files, vectors = postings(prefix[at]), x[at]
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            take = min(len(at), max(least, math.ceil(rerank * len(at))))
            keys, found, scores = [], [], []
            for q in np.flatnonzero(query).tolist():
                best = np.arange(len(at))
                if take < len(at):
                    best = np.argpartition(-closeness(prefix[q], files, len(at)), take - 1)[:take]
                score = (vectors[best] * x[q]).sum(axis=1) / (norms[best] * np.sqrt((x[q] * x[q]).sum()))
                cut = np.partition(score, -min(k + 1, take))[-min(k + 1, take)]  # all that tie with the last
                rows = sorted((-score[i], v) for i in np.flatnonzero(score >= cut).tolist() for v in ids[at[best[i]]])[:k + 1]
                keys += [key[q]] * len(rows)
                found += [v for _, v in rows]
                scores += [-s for s, _ in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())],
                                             names=["key", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: F.Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
            pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, least: int = LEAST) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (cosine) of the k nearest found for each row that ``queries`` selects."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("_query", F.coalesce(queries, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), "_query", F.col(embedding).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0)).where(finite & F.exists("vec", lambda v: v != 0))
    rows = written(rows.withColumn("key", F.xxhash64("vec")).withColumn("d", F.size("vec")), "vectors")

    smallest = W.partitionBy("vec").orderBy("vec_id")
    once = rows.withColumn("rn", F.dense_rank().over(smallest)).where(F.col("rn") <= k + 1)
    distinct = written(once.groupBy("vec").agg(
        F.first("key").alias("key"), F.first("d").alias("d"), F.sort_array(F.collect_set("vec_id")).alias("ids")), "distinct-vectors")
    counts = distinct.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    drawn = distinct.withColumn("rn", F.row_number().over(W.partitionBy("d").orderBy("key", "vec"))).where(F.col("rn") <= pivots)
    sample: dict[int, list] = {}
    for r in drawn.join(counts, "d", "left_semi").select("d", "vec").collect():
        sample.setdefault(r["d"], []).append(r["vec"])
    unit = {d: x / np.linalg.norm(x, axis=1, keepdims=True) for d, x in ((d, scaled(np.array(v))) for d, v in sample.items())}
    fields = "vec array<double>, key long, d int, ids array<long>, prefix binary"
    indexed = written(distinct.select("vec", "key", "d", "ids").mapInArrow(
        _prefixes(spark.sparkContext.broadcast(unit), prefix), fields), "permutations")

    asked = rows.where("_query").select("vec_id", "key").distinct()
    wanted = indexed.join(asked.select("key").distinct(), "key", "left_semi")
    # One row a length: its blocks of vectors and of queries, and the number of its first task.
    sizes = indexed.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / VECTOR_BLOCK).alias("vector_blocks")).join(
        wanted.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks")), "d")
    n_tasks = F.col("vector_blocks") * F.col("query_blocks")
    sizes = written(sizes.withColumn("base", F.sum(n_tasks).over(W.orderBy("d").rowsBetween(W.unboundedPreceding, 0)) - n_tasks), "lengths")
    total = sizes.agg(F.sum(n_tasks)).first()[0] or 1

    def dealt(df: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        df = df.join(broadcast_if_small(sizes), "d").withColumn("_b", F.pmod(F.xxhash64("key", F.lit(is_query)), F.col(own)))
        df = df.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        query, vector = ("_b", "_o") if is_query else ("_o", "_b")
        return df.select((F.col("base") + F.col(query) * F.col("vector_blocks") + F.col(vector)).alias("task"),
                         F.lit(is_query).alias("is_query"), "key", "ids", "vec", "prefix")

    tasks = dealt(indexed, "vector_blocks", "query_blocks", False).unionByName(dealt(wanted, "query_blocks", "vector_blocks", True))
    tasks = tasks.repartition(min(total, 20_000), "task").sortWithinPartitions("task")
    best = tasks.mapInArrow(_search(k, rerank, least), "key long, vec_id long, score double")
    order = W.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1)
    answers = asked.withColumnRenamed("vec_id", "query_id").join(best, "key").where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: DataFrame, queries: list[int], k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> dict[int, list[int]]:
    """Exact answers for a few queries, on the driver; for measuring recall on fixtures."""
    rows = [(r[0], np.array(r[1], np.float64)) for r in vectors.select(vec_id, embedding).collect()
            if r[0] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        out[q] = [int(ids[i]) for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
    return out
