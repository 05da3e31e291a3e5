import pytest

from vericorpus import session


class Named:
    """What ``shared_folder`` asks of a session."""

    def __init__(self, master, conf=None, given=None):
        self.master, self.named, self.given = master, conf, given
        self.sparkContext = self.conf = self._jsc = self

    def getConf(self):
        return {"spark.checkpoint.dir": self.named} if self.named else {}

    def get(self, key, default=None):
        return default

    def sc(self):
        return self

    def getCheckpointDir(self):
        class Option:
            isDefined = staticmethod(lambda: self.given is not None)
            get = staticmethod(lambda: self.given)

        return Option


def test_the_shared_folder():
    assert session.shared_folder(Named("spark://x:7077", "hdfs://a/b/")) == "hdfs://a/b"
    assert session.shared_folder(Named("spark://x:7077", None, "hdfs://given")) == "hdfs://given"
    assert session.shared_folder(Named("local[4]")).startswith("file:///")
    for master in ("yarn", "spark://x:7077", "local-cluster[3,2,3000]"):
        with pytest.raises(ValueError):
            session.shared_folder(Named(master))


def test_staged_tables_are_released(spark):
    kept = list(session._STAGED)
    session._STAGED.clear()
    try:
        rows = session.staged(spark.range(5), "test")
        path = session._STAGED[0].removeprefix("file://")
        assert rows.count() == 5
        session.release()
        import os

        assert not os.path.exists(path) and not session._STAGED
    finally:
        session._STAGED.extend(kept)
