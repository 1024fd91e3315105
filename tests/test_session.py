import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from labelloom import session


def test_scratch_tables_go_with_their_job(spark):
    with pytest.raises(ZeroDivisionError), session.scratch(spark):
        path = session.new_path(spark, "t")
        spark.range(3).write.parquet(path)
        staged = session.stage(spark.range(5))
        assert staged.count() == 5 and session.is_directory(spark, path)
        raise ZeroDivisionError
    assert not session.path_exists(spark, path)
    kept = session.stage(spark.range(5))  # outside a job nothing is dropped
    assert kept.count() == 5


def test_row_ids_are_unique_and_stable(spark):
    df = session.stage_with_row_id(spark.range(100).repartition(7))
    first = {(r.id, r[session.ROW_ID]) for r in df.collect()}
    assert len({i for _, i in first}) == 100
    assert {(r.id, r[session.ROW_ID]) for r in df.repartition(3).collect()} == first


class StubSession:
    """Just what ``shared_dir`` reads: the setting is fixed once a session runs."""

    def __init__(self, master, folder):
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")
        self.conf = {session.CHECKPOINT_CONF: folder} if folder else {}


def test_the_shared_folder_is_the_configured_one(spark):
    assert session.shared_dir(StubSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    local = StubSession("local[4]", None)
    assert session.shared_dir(local) == session.shared_dir(local)
    for master in ("yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            session.shared_dir(StubSession(master, None))
    configured = spark.conf.get(session.CHECKPOINT_CONF, None)
    if configured:
        path = session.new_path(spark, "x")
        assert path.startswith(f"{configured.rstrip('/')}/labelloom/{spark.sparkContext.applicationId}/x-")


def test_settings_grow_with_the_data():
    small = session.cluster_settings(1 << 30, 8)
    large = session.cluster_settings(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) > 200_000


def test_stage_drops_its_shuffles(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(k).getName() for k in range(found.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(session.CLEANUP_CONF, None)
    staged = session.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):  # Spark removes them in the background
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session.CLEANUP_CONF, None) == setting
    assert staged.agg(F.sum("count")).first()[0] == 1000
