import math

import pytest
from pyspark.sql import functions as F

from metaweave.llm import sharding as S


@pytest.mark.parametrize("population,marked,draws", [(50, 12, 20), (30, 25, 20), (9, 4, 9), (7, 0, 3), (100_000, 4_000, 30_000)])
def test_hypergeometric(spark, population, marked, draws):
    n = 4000
    u = S._uniform(F.lit(11), F.col("id"))
    got = spark.range(n).select(S.hypergeometric(F.lit(population), F.lit(marked), F.lit(draws), u).alias("k")).groupBy("k").count().collect()
    low, high = max(0, draws + marked - population), min(draws, marked)
    assert all(low <= r.k <= high for r in got)
    mean = draws * marked / population
    spread = math.sqrt(max(0, mean * (1 - marked / population) * (population - draws) / max(1, population - 1)))
    assert abs(sum(r.k * r["count"] for r in got) / n - mean) <= 5 * spread / math.sqrt(n) + 1e-9
    if population < 1000:
        for r in got:
            p = math.comb(marked, r.k) * math.comb(population - marked, draws - r.k) / math.comb(population, draws)
            assert abs(r["count"] - n * p) < 5 * math.sqrt(n * p) + 3


def test_matrix_adds_up(spark):
    sizes = [17, 0, 230, 41, 3, 88, 0, 120]
    blocks = spark.createDataFrame(list(enumerate(sizes)), "block long, n long")
    rows = S.communication_matrix(blocks, sum(sizes), 5, 3).collect()
    assert [sum(r.to) for r in sorted(rows, key=lambda r: r.block)] == sizes
    assert [sum(r.to[s] for r in rows) for s in range(5)] == [100, 100, 100, 100, 99]


def test_sizes_slots_and_spread(spark):
    out = S.shard_rows(spark.range(10_001), block_rows=200).toPandas()
    by = out.groupby("shard").slot
    assert sorted(by.count()) == [416] * 7 + [417] * 17
    assert all(sorted(s) == list(range(len(s))) for _, s in by) and out.id.nunique() == 10_001
    # Neighbours in the input fall into all shards, and a slot says nothing about the id.
    low = out[out.id < 2000].groupby("shard").id.count()
    assert abs(low - 2000 / 24).max() < 5 * math.sqrt(2000 / 24)
    assert abs(out.id.corr(out.slot)) < 0.05


def test_same_input_same_result(spark):
    df = spark.range(500).repartition(3)
    a, b = (sorted(map(tuple, S.shard_rows(df, block_rows=50).collect())) for _ in range(2))
    assert a == b


def test_odd_rows(odd_docs, no_docs, spark):
    out = S.shard_rows(odd_docs, shards=5)
    assert {"in_Shard", "in_slot"} <= set(out.columns)
    got = out.collect()
    assert len(got) == odd_docs.count() and sorted(sum(r.shard == s for r in got) for s in range(5)) == [2, 2, 2, 3, 3]
    assert S.shard_rows(no_docs).count() == 0
    assert [(r.shard, r.slot) for r in S.shard_rows(spark.range(1)).collect()] == [(0, 0)]


def test_stored_rows_get_no_second_copy(spark, tmp_path, monkeypatch):
    from metaweave.llm import common

    spark.range(3000).selectExpr("id % 700 AS id", "repeat('x', 50) AS text", "id AS _row").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    copied = sorted(map(tuple, S.shard_rows(docs, block_rows=200).collect()))
    columns = []
    monkeypatch.setattr(S, "written", lambda df, *a, **k: columns.append(df.columns) or common.written(df, *a, **k))
    assert sorted(map(tuple, S.shard_rows(docs, block_rows=200, stored=True).collect())) == copied
    assert columns and not any("text" in c for c in columns)
    # Rows that files hold once but the table several times have no place of their own, rows of no file have none at all.
    assert S._places(docs.selectExpr("id", "explode(array(1, 2)) AS k")) is None and S._places(spark.range(5)) is None
