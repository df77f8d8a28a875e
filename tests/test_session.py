import pytest

from tillroll.scratch import Scratch, list_folders, shared_folder
from tillroll.session import MIB, cluster_conf, folder_bytes, require_session

TIB = 1 << 40


def test_small_inputs_use_every_core():
    assert cluster_conf(1 << 30, cores=64)["spark.sql.shuffle.partitions"] == "128"


def test_task_sizes_grow_only_when_task_counts_would_explode():
    ten = cluster_conf(10 * TIB, cores=1000)
    assert ten["spark.sql.files.maxPartitionBytes"] == str(256 * MIB)
    assert ten["spark.sql.shuffle.partitions"] == "40000"
    hundred = cluster_conf(100 * TIB, cores=8000)
    assert 100 * TIB / int(hundred["spark.sql.files.maxPartitionBytes"]) <= 100_001
    assert hundred["spark.sql.shuffle.partitions"] == "40000"
    # A key with a third of the rows is still noticed in every scan task.
    block = int(hundred["spark.shuffle.accurateBlockThreshold"])
    assert int(hundred["spark.sql.files.maxPartitionBytes"]) / 3 > 4 * block


def test_bounds_can_be_moved():
    conf = cluster_conf(100 * TIB, cores=8000, max_scan_tasks=1_000_000, max_shuffle_partitions=200_000)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 * MIB)
    assert conf["spark.sql.shuffle.partitions"] == "200000"


def test_size_of_a_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text("12345")
    (tmp_path / "deep" / "b.csv").write_text("123")
    assert folder_bytes(spark, str(tmp_path)) == 8


@pytest.mark.parametrize("name", ["spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"])
def test_a_session_that_would_lose_values_or_choke_on_hot_keys_is_refused(spark, name):
    session = spark.newSession()
    session.conf.set(name, "false")
    with pytest.raises(RuntimeError, match=name):
        require_session(session)


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Cluster)


def test_scratch_folders_do_not_meet_and_are_cleared_one_by_one(spark):
    first, second = Scratch(spark), Scratch(spark)
    for scratch in (first, second):
        assert scratch.cut(spark.range(3), "t").count() == 3
    first.clear()
    assert list_folders(spark, first.path) == []
    assert len(list_folders(spark, second.path)) == 1
    second.clear()
