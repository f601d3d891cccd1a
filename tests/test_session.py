from types import SimpleNamespace

import pytest

from jobweave import session


def fake(master, setting=None, app="app-1"):
    conf = SimpleNamespace(get=lambda key, default=None: setting)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("spark://host:7077", "hdfs://shared/cp/")) == "hdfs://shared/cp"


def test_only_local_sessions_get_their_own_folder():
    first = session.shared_folder(fake("local[2]"))
    assert session.shared_folder(fake("local[2]")) == first
    assert session.shared_folder(fake("local[2]", app="app-2")) != first
    with pytest.raises(ValueError):
        session.shared_folder(fake("yarn"))


def test_materialized_rows_are_read_back(spark):
    stored = session.materialize(spark.range(5), "range")
    assert sorted(r.id for r in stored.collect()) == [0, 1, 2, 3, 4]
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()
