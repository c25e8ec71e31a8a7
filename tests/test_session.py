import pytest

from inkspan import session


class Settings:
    def __init__(self, base, master):
        self.base, self.master = base, master
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.base or default


def test_shared_folder():
    named = session.shared_folder(Settings("s3a://bucket/tmp/", "yarn"), "pages")
    assert named.startswith("s3a://bucket/tmp/inkspan/pages-")
    assert named != session.shared_folder(Settings("s3a://bucket/tmp", "yarn"), "pages")
    local = session.shared_folder(Settings(None, "local[2]"), "pages")
    assert "/inkspan/pages-" in local
    with pytest.raises(ValueError):
        session.shared_folder(Settings(None, "yarn"), "pages")


def test_discard(spark):
    path = session.shared_folder(spark, "test")
    spark.range(3).write.parquet(path)
    session.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.discard(spark, "/tmp/elsewhere")


def test_spread(spark):
    few = spark.range(10).coalesce(1)
    assert session.spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert session.spread(many, "id") is many
