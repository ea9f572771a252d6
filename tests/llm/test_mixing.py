import math
from collections import Counter

import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from metaweave.llm import mixing as M


@pytest.fixture
def corpus(spark):
    rows = [(i, prose(20, i), "aa", "hot" if i % 3 == 0 else f"s{i % 7}", 1) for i in range(3000)]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_are_met(corpus):
    weights = {"hot": 0.5, "s1": 0.3, "s2": 0.2}
    out = M.poisson_mixture(corpus, weights, total=400_000)
    got = {r.source: r.b for r in out.groupBy("source").agg(F.sum(F.octet_length("text")).alias("b")).collect()}
    assert set(got) == set(weights)
    assert all(abs(got[s] - w * 400_000) < 0.12 * w * 400_000 for s, w in weights.items())


def test_counts_follow_the_inverse_distribution(corpus, spark):
    out = M.poisson_mixture(corpus, {"hot": 1.0}, total=150_000)
    got = Counter(r.doc_id for r in out.select("doc_id").collect())
    rate = M.source_rates(corpus, {"hot": 1.0}, 150_000).where("src = 'hot'").first().rate
    hot = corpus.where("source = 'hot'").select("doc_id", M.uniform(F.lit(M.SEED), F.col("doc_id"), F.lit(1)).alias("u")).collect()
    assert got == Counter({r.doc_id: k for r in hot if (k := M.inverse_poisson(rate, r.u))})
    seen = Counter(got.get(r.doc_id, 0) for r in hot)
    for k in range(4):
        p = math.exp(-rate) * rate**k / math.factorial(k)
        assert abs(seen[k] - 1000 * p) < 5 * math.sqrt(1000 * p) + 2


def test_large_rates_and_copy_numbers(spark):
    df = spark.createDataFrame([(i, "abc", "aa", "x", 3) for i in range(40)], SCHEMA)
    out = M.poisson_mixture(df, total=40 * 3 * 200.0).select("doc_id", "copy_no").collect()
    assert abs(len(out) - 8000) < 500
    by = Counter(r.doc_id for r in out)
    assert all(sorted(r.copy_no for r in out if r.doc_id == d) == list(range(1, n + 1)) for d, n in by.items())


def test_the_shuffle_is_global_and_repeats(corpus):
    a, b = M.poisson_mixture(corpus), M.poisson_mixture(corpus.repartition(5))
    key = lambda r: (r.doc_id, r.copy_no)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    order = [r.doc_id for r in a.collect()]
    rises = sum(x < y for x, y in zip(order, order[1:], strict=False)) / len(order)
    assert 0.4 < rises < 0.6
    parts = a.groupBy(F.spark_partition_id()).agg(F.avg((F.col("source") == "hot").cast("double")).alias("h"), F.count("*").alias("n")).where("n > 100").collect()
    assert max(r.h for r in parts) - min(r.h for r in parts) < 0.35


def test_odd_rows(odd_docs, no_docs):
    out = M.poisson_mixture(odd_docs, total=200_000 * 10)
    assert {"in_copy_no", "in_rate"} <= set(out.columns) and out.count() > 0
    got = Counter((r.doc_id, r.source) for r in out.collect())
    assert got[(1, "s0")] % 2 == 0  # repeated rows are drawn alike
    assert M.poisson_mixture(no_docs).count() == 0
    assert M.source_rates(odd_docs).where("src IS NULL").first().rate > 0
