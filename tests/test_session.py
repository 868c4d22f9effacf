from types import SimpleNamespace

import pytest

from pulsegrid.session import pin_utc, shared_dir


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    core = SimpleNamespace(get=lambda key, default=None: settings.get("core:" + key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: core))


def test_shared_dir_follows_the_session(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cluster_must_name_its_folder():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"), "x")
    named = session("spark://host:7077", **{"core:spark.checkpoint.dir": "hdfs://data/shared/"})
    assert shared_dir(named, "x").startswith("hdfs://data/shared/x-")
    assert "pulsegrid-" in shared_dir(session("local[2]"), "x")


def test_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
