from types import SimpleNamespace

import pytest

from presslake import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def fake(master, folder=None, **settings):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=Conf(settings), sparkContext=context)


def test_the_configured_folder_is_used():
    configured = fake("spark://host", **{"spark.checkpoint.dir": "s3a://lake/tmp/"})
    assert session.shared_dir(configured) == "s3a://lake/tmp"
    assert session.fresh_path(configured, "x").startswith("s3a://lake/tmp/x-")


@pytest.mark.parametrize("master", ["spark://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake(master))


def test_the_contexts_folder_is_used_where_none_is_configured():
    assert session.shared_dir(fake("spark://host", "hdfs://h/c/")) == "hdfs://h/c"


@pytest.mark.parametrize("path, shared", [
    ("file:/lake/tmp/a", True), ("file:///lake/tmp/a/b", True), ("/lake/tmp/a", True),
    ("file:/lake/tmpx/a", False), ("file:/lake/tmp/../a", False), ("file:/elsewhere", False), ("s3a://lake/tmp/a", False),
])
def test_what_lies_in_the_shared_folder(path, shared):
    assert session.is_shared(fake("spark://host", **{"spark.checkpoint.dir": "file:///lake/tmp/"}), path) == shared
    assert session.is_shared(fake("spark://host", "file:/lake/tmp"), path) == shared
    assert not session.is_shared(fake("spark://host"), path)


def test_a_local_session_falls_back_to_one_folder():
    assert session.shared_dir(fake("local[2]")) == session.shared_dir(fake("local[2]"))


def test_materialized_tables_keep_their_schema(spark):
    frame = spark.range(3).selectExpr("id", "array(struct(id AS x)) AS nested")
    stored = session.materialize(frame, "test")
    assert stored.schema.simpleString() == frame.schema.simpleString()
    assert stored.count() == 3


@pytest.mark.parametrize("rows, parts", [(1, 1), (4_000, 2), (10**6, 4), (10**8, 20)])
def test_spread(spark, rows, parts):
    assert session.spread(spark.range(10), "id", rows).rdd.getNumPartitions() == parts
