from types import SimpleNamespace

import pytest

from kinfold.sources import staging


def session(master, folder=None):
    said = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=said.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context), said


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            staging.shared_dir(session(master)[0])
        spark, said = session(master, "hdfs://shared/x")
        assert staging.shared_dir(spark) == "hdfs://shared/x" and said == ["hdfs://shared/x"]
    assert staging.shared_dir(session("local[4]")[0])


def test_stored_rows_have_no_lineage(spark):
    df = staging.stored(spark.range(10).withColumnRenamed("id", "a b"))
    assert sorted(r[0] for r in df.collect()) == list(range(10)) and "Range" not in df._jdf.queryExecution().toString()


def test_stored_rows_leave_no_shuffle_files(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before = shuffles()
    df = staging.stored(spark.range(1000).repartition(3, "id"))
    assert not shuffles() - before and df.count() == 1000 and spark.conf.get(staging.CLEANUP) == "false"
