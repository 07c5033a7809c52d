"""The shared folder is asked for, and must be one that a cluster shares."""

from types import SimpleNamespace

import pytest

from hourgrid import session


def fake(master, **settings):
    conf = {k.replace("_", "."): v for k, v in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), sparkContext=SimpleNamespace(master=master))


def test_a_missing_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("local[2]"))


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,2,1024]", "yarn"])
def test_a_cluster_names_the_file_system(master):
    with pytest.raises(ValueError, match="file system"):
        session.shared_folder(fake(master, spark_checkpoint_dir="/tmp/x"))
    assert session.shared_folder(fake(master, spark_checkpoint_dir="hdfs://n/x/")) == "hdfs://n/x"
    assert session.shared_folder(fake(master, spark_checkpoint_dir="file:///mnt/shared")) == "file:///mnt/shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_machine_may_use_its_own_folder(master):
    assert session.shared_folder(fake(master, spark_checkpoint_dir="/tmp/x/")) == "/tmp/x"
    assert session.scratch_path(fake(master, spark_checkpoint_dir="/tmp/x"), "a") != session.scratch_path(fake(master, spark_checkpoint_dir="/tmp/x"), "a")


def as_on_a_cluster(spark, folder):
    """The session, said to run on a cluster with a folder whose file system is not named."""
    context = SimpleNamespace(master="spark://host:7077", applicationId=spark.sparkContext.applicationId, defaultParallelism=4)
    conf = SimpleNamespace(get=lambda key, default=None: {"spark.checkpoint.dir": folder}.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=context, range=spark.range, read=spark.read)


def test_a_folder_that_proves_to_be_shared_needs_no_file_system(spark, tmp_path):
    cluster = as_on_a_cluster(spark, f"{tmp_path}/kept/")
    path = session.scratch_path(cluster, "a")
    assert path.startswith(f"{tmp_path}/kept/hourgrid/a-")
    session.scratch_path(cluster, "b")
    assert len(list((tmp_path / "kept/hourgrid").iterdir())) == 1  # asked once


def test_a_folder_that_some_do_not_reach_is_refused(spark, tmp_path):
    (tmp_path / "file").touch()
    with pytest.raises(ValueError, match="file system"):
        session.scratch_path(as_on_a_cluster(spark, f"{tmp_path}/file"), "a")
    # tasks that write to disks of their own: the driver finds part of what they wrote
    cluster = as_on_a_cluster(spark, f"{tmp_path}/own")
    cluster.range = lambda start, end, step, parts: spark.range(start, end - 1, step, parts)
    with pytest.raises(ValueError, match="file system"):
        session.scratch_path(cluster, "a")
