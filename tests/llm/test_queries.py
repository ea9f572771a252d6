"""The registered queries against DuckDB and the contracts' columns on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from metaweave.llm.oracle import ORACLE
from metaweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

COLUMNS = {
    "op2_suffix_dedup": ["doc_id bigint", "n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string"],
    "op3_warc": ["page_id bigint", "payload_bytes bigint", "payload_digest string", "record_type string", "refers_to bigint"],
    "op4_language_id": ["doc_id bigint", "held_out boolean", "lang_pred string", "score double"],
    "op6_sharding": ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"],
    "op7_toxicity": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op8_ann": ["query_id bigint", "rank int", "vec_id bigint", "score double"],
    "op10_decontaminate": ["doc_id bigint", "n_words bigint", "n_hit bigint", "n_items bigint", "items_sha256 string", "contaminated boolean"],
    "op11_quality_rules": ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint", "n_repeat_words bigint",
                           "base_failed boolean", "kept boolean"],
    "op12_merkle_manifest": ["doc_id bigint", "leaf string", "subroot string", "root string", "proof_sha256 string", "folded_root string", "verified boolean"],
    "op13_embedding_whitening": ["vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double", "identity_error double"],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    got = [f"{c} {t}" for c, t in QUERIES[name](spark, SF).dtypes]
    assert got[:len(COLUMNS[name])] == COLUMNS[name]


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_mixing", "op6_sharding", "op11_quality_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoopJoin"))


def test_every_document_has_its_row(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_line_dedup", "op2_suffix_dedup", "op4_language_id", "op6_sharding", "op7_toxicity", "op9_ngram_join", "op10_decontaminate", "op11_quality_rules", "op12_merkle_manifest"):
        assert QUERIES[name](spark, SF).count() == n, name
