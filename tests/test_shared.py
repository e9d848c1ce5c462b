"""Scratch storage: what a written frame shuffled is let go."""

import time

from pyspark.sql import functions as F

from catalogue.sources.shared import LET_GO, settle


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_written_frame_lets_go_of_its_shuffle(spark):
    before, setting = shuffle_files(spark), spark.conf.get(LET_GO)
    df = spark.range(50_000).withColumn("x", F.xxhash64("id")).repartition(4, "x")
    got = settle(df, "moved")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(LET_GO) == setting and got.count() == 50_000 and got.dtypes == df.dtypes
    # the frame itself can still be read
    assert df.count() == 50_000
