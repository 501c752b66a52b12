import pytest

from airshed import session


def test_checkpoint_dir_comes_from_the_session(spark):
    d = session.ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    assert session.shared_path(spark, "staging", "x").startswith(d)


def test_shuffle_partitions_for_volume():
    tb = 1024 ** 4
    assert session.shuffle_partitions_for(20 * tb) == 81_920
    assert session.shuffle_partitions_for(1) == 200
    assert session.CLUSTER_CONF["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)


def test_without_a_shared_folder_only_local_sessions_run():
    assert session.checkpoint_dir_for("hdfs://x/ckpt", "yarn") == "hdfs://x/ckpt"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.checkpoint_dir_for(None, master)
    assert session.checkpoint_dir_for(None, "local[2]")
