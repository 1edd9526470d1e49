"""Where queries that write put their tables, and the settings they rely on."""

from types import SimpleNamespace

import pytest

from storeledger.session import SETTINGS, configure, scratch_dir


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_used(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "raw").startswith(shared + "/storeledger/raw-")
    assert scratch_dir(session("yarn", "hdfs://x/y/"), "raw").startswith("hdfs://x/y/storeledger/raw-")
    assert scratch_dir(spark, "raw") != scratch_dir(spark, "raw")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "raw")


def test_settings(spark):
    configure(spark)
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_page_texts_are_read_in_small_batches(spark):
    """4,096 texts of 100 kB, with the room that the reader adds, would be over a GB for each task."""
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
