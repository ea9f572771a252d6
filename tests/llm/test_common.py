import glob
import os
import time

from metaweave.llm import common


def test_a_write_leaves_no_shuffle_files(spark):
    """Shuffle files of a hand-off go with it, and the session's setting is as before."""
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for top in local for f in glob.glob(os.path.join(top, "*", "shuffle_*"))}

    before, setting = files(), spark.conf.get(common.CLEANUP, None)
    out = common.written(spark.range(1000).repartition(7, "id"), "some-rows")
    end = time.time() + 20  # Spark removes them beside the query
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 1000 and spark.conf.get(common.CLEANUP, None) == setting
