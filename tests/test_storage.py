from types import SimpleNamespace

import pytest

from gapweave import storage


def session(master, setting=None, given=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: given)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_setting_comes_first_then_the_folder_of_the_context():
    assert storage.shared_folder(session("spark://x", "hdfs://a/b/", "hdfs://c")) == "hdfs://a/b"
    assert storage.shared_folder(session("spark://x", None, "hdfs://c/")) == "hdfs://c"


@pytest.mark.parametrize("master", ["spark://x:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session(master))


def test_a_local_session_may_do_without(tmp_path, monkeypatch):
    monkeypatch.setattr(storage.tempfile, "mkdtemp", lambda prefix: f"{tmp_path}/{prefix}x")
    assert storage.shared_folder(session("local[4]")).startswith(str(tmp_path))


def test_scratch_can_be_removed(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x")
    storage.remove_scratch(spark, f"{tmp_path}/x")
    assert list(tmp_path.iterdir()) == []
