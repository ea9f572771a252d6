import os

import pytest

import corpus_pipeline as P
from metaweave.llm import decontaminate, ngram_join

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_join", "decontaminate", "mixing", "sharding"]
    rows = {}
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = P.written(stage(spark, docs, SF), f"test-{name}")
        after = [r.doc_id for r in docs.collect()]
        rows[name] = len(after)
        if name == "ngram_join":
            kept = ngram_join.brute_force(before)
            assert sorted(after) == sorted({c for c, _ in kept.values()})
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert sorted(after) == sorted(r[0] for r in decontaminate.brute_force(before, items) if r[2] == 0)
        elif name == "mixing":
            assert set(after) <= {d for d, _ in before} and 0.7 * len(before) < len(after) < 1.4 * len(before)
        elif name == "language_id":
            letters = {d for d, t in before if t and any(c.isalpha() for c in t)}
            assert set(after) <= letters and len(after) >= 0.97 * len(letters)
        else:
            assert sorted(after) == sorted(d for d, _ in before)
        assert docs.columns == (columns if name != "sharding" else [*columns, "shard", "slot"])
    assert P.run(spark, SF).count() == rows["sharding"]


def test_odd_rows_pass_through_every_stage(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns == given.columns if name != "sharding" else len(out.columns) == len(given.columns) + 2
            docs = P.written(out, f"odd-{name}")
            if name == "mixing" and given is odd_docs:
                assert {r.score for r in docs.collect()} == {"extra score"} == {r.n_hit.replace("n_hit", "score") for r in docs.collect()}
        sizes = [r["count"] for r in docs.groupBy("shard").count().collect()]
        assert max(sizes, default=0) - min(sizes, default=0) <= 1
