"""One table owning most DESCRIBE rows: results stay exact and its rows are
numbered by several tasks, not one."""

from pyspark.sql import functions as F

from metaweave.operators import describe as D


def hot_describe(spark, n_hot=60_000, n_small=200):
    hot = spark.range(n_hot).select(
        F.lit("s").alias("schema_name"), F.lit("hot").alias("table_name"),
        (F.col("id") + 1).cast("int").alias("row_no"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("col_name"),
        F.lit("int").alias("data_type"), F.lit(None).cast("string").alias("comment"))
    tail = spark.createDataFrame(
        [("s", "hot", n_hot + 1, "# Partition Information", "", ""),
         ("s", "hot", n_hot + 2, "# col_name", "data_type", "comment"),
         ("s", "hot", n_hot + 3, "c42", "int", "")],
        hot.schema)
    small = spark.range(n_small).select(
        F.lit("s").alias("schema_name"), F.concat(F.lit("t"), (F.col("id") % 50).cast("string")).alias("table_name"),
        ((F.col("id") / 50).cast("int") + 1).alias("row_no"),
        F.concat(F.lit("x"), (F.col("id") / 50).cast("int").cast("string")).alias("col_name"),
        F.lit("string").alias("data_type"), F.lit("").alias("comment"))
    return hot.unionByName(tail).unionByName(small)


def test_hot_table_is_exact_and_split(spark):
    d = hot_describe(spark)
    annotated = D.annotate_describe(d, block_size=4096)
    tasks = (annotated.where(F.col("table_name") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert tasks > 1
    cols = D.partition_columns(annotated)
    hot = cols.where(F.col("table_name") == "hot")
    stats = hot.agg(F.count(F.lit(1)).alias("n"), F.min("sort_order").alias("lo"), F.max("sort_order").alias("hi"),
                    F.sum(F.col("is_partition").cast("int")).alias("parts")).first()
    assert (stats.n, stats.lo, stats.hi, stats.parts) == (60_000, 0, 59_999, 1)
    assert hot.where(F.col("is_partition")).first().col_name == "c42"
    assert cols.where(F.col("table_name") != "hot").count() == 50 * 4
