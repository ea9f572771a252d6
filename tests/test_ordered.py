"""The block-split helpers equal their single-window / single-collect definitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from metaweave.functions import ordered
from metaweave.functions.ordered import block_ordinal, ordered_collect, ordered_join, range_ordinal


def data(spark, n=400, groups=3, seed=7):
    rnd = random.Random(seed)
    orders = rnd.sample(range(10_000), n)
    rows = [(f"g{rnd.randrange(groups)}", o, f"v{o}") for o in orders]
    return spark.createDataFrame(rows, "g string, o long, v string")


def test_block_ordinal_matches_row_number(spark):
    df = data(spark)
    w = Window.partitionBy("g").orderBy("o")
    want = {(r.g, r.o): r.p for r in df.select("g", "o", (F.row_number().over(w) - 1).alias("p")).collect()}
    got = {(r.g, r.o): r.ordinal for r in block_ordinal(df, ["g"], "o", block_size=16).collect()}
    assert got == want


def test_global_block_ordinal_is_dense(spark):
    df = data(spark)
    got = sorted((r.o, r.ordinal) for r in block_ordinal(df, [], "o", block_size=32).collect())
    assert [p for _, p in got] == list(range(len(got)))


def test_ordered_collect_and_join(spark):
    df = data(spark)
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        want.setdefault(r.g, []).append(r.v)
    got = {r.g: r.vs for r in ordered_collect(df, ["g"], "o", "v", "vs", block_size=8).collect()}
    assert got == want
    joined = {r.g: r.s for r in ordered_join(df, ["g"], "o", "v", "s", ",", block_size=8).collect()}
    assert joined == {g: ",".join(v) for g, v in want.items()}


def test_range_ordinal_matches_row_number(spark):
    """Repeated, sparse and null order values, null and empty groups."""
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 0, 0, 1, 10**15, -5]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, o long, i long")
    want = {}
    for g, o, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        want.setdefault(g, []).append(i)
    got = {}
    for r in range_ordinal(df, ["g"], ["o", "i"], "p", partitions=7).orderBy("p").collect():
        got.setdefault(r.g, []).append(r.i)
        assert r.p == len(got[r.g]) - 1
    assert got == want
    assert range_ordinal(df.limit(0), ["g"], ["o"]).count() == 0


def test_range_ordinal_spreads_equal_rows(spark, monkeypatch):
    """A million records of one ordinal: no task sorts more than twice its share."""
    placed = []
    write = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, name: placed.append(write(df, name)) or placed[-1])
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit(None).cast("long").alias("o"))
    got = range_ordinal(df, [], ["o"], "p", partitions=16)
    assert got.agg(F.countDistinct("p"), F.min("p"), F.max("p")).first() == (1_000_000, 0, 999_999)
    per_task = [r["count"] for r in placed[0].groupBy(F.input_file_name()).count().collect()]
    assert len(per_task) == 16 and max(per_task) < 2 * 1_000_000 / 16
