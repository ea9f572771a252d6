"""Queries whose terms are all common: each posting is exchanged once, by document, and the rows stay the same."""

from pyspark.sql import functions as F

from metaweave.operators import search as Q


def ranked(spark, tmp_path, name):
    none = F.lit(None).cast("string")
    docs = spark.range(400).select(
        F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("t"), "id").alias("name"),
        F.concat_ws(" ", F.lit("customer"), F.when(F.col("id") % 2 == 0, "part"), F.when(F.col("id") % 3 == 0, "part"), F.when(F.col("id") == 7, "rare")).alias("description"),
        F.array(F.concat(F.lit("c"), F.col("id") % 5)).alias("column_names"), F.array(none).alias("column_descriptions"))
    index = Q.search_index(docs, 4).write(str(tmp_path / name))
    queries = spark.createDataFrame([(i, f"customer part c{i % 5} {word}") for i, word in enumerate(["rare", "t11", "", "nowhere", "rare t12"])], "query_id int, text string")
    queries.write.parquet(str(tmp_path / f"{name}-queries"))  # a size that the planner knows
    return Q.search_rank(spark.read.parquet(str(tmp_path / f"{name}-queries")), index, k=10)


def test_common_terms_are_exchanged_by_document(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "MAX_CANDIDATES", 1 << 40)
    want = sorted(ranked(spark, tmp_path, "a").collect())
    assert len(want) == 50
    monkeypatch.setattr(Q, "MAX_CANDIDATES", 0)
    got = ranked(spark, tmp_path, "b")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert any("RepartitionByExpression [key" in line for line in plan.splitlines()), plan
    assert sorted(got.collect()) == want
