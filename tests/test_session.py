"""Written tables: read again, given back, and never in a machine's own folder on a cluster."""

import os

import pytest

from lavra import session


def test_written_and_released(spark):
    t = session.written(spark.range(10), "ten")
    assert t.count() == 10
    path = t.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.exists("/" + path.lstrip("/"))
    session.released(t)
    assert not os.path.exists("/" + path.lstrip("/"))
    session.released(t)  # twice is once


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master, applicationId = "spark://host:7077", "none"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[3,2,1024]")
