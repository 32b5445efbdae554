from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerlens import scratch


def _session(master, current=None, named=None):
    found = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: found["dir"],
        setCheckpointDir=lambda path: found.update(dir=path),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named or default))


def test_the_clusters_folder_is_used():
    assert scratch.shared_dir(_session("yarn", current="hdfs:///c/1")) == "hdfs:///c/1"
    assert scratch.shared_dir(_session("yarn", named="hdfs:///c")) == "hdfs:///c"


def test_a_cluster_without_a_folder_is_an_error_and_a_local_session_gets_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(_session("yarn"))
    assert scratch.shared_dir(_session("local[4]"))


def test_durable_rows_keep_their_order_of_columns_types_and_slices(spark):
    df = spark.range(1000).repartitionByRange(6, "id").withColumn("slice", F.spark_partition_id())
    kept = scratch.durable(df)
    assert kept.dtypes == df.dtypes
    ranges = kept.groupBy("slice").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("slice").collect()
    assert len(ranges) == 6 and all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
    assert kept.count() == 1000 and kept.collect() == kept.collect()
