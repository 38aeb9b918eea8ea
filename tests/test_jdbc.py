"""JDBC calls without a database: what is handed to the reader and the writer."""

import pytest

from tickward.sources import jdbc
from tickward.streaming.sinks import jdbc_append_sink, jdbc_replace_sink


class Recorder:
    def __init__(self):
        self.calls = {}
        self.read = self.write = self

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def options(self, **given):
        self.calls["options"] = given
        return self

    def load(self):
        return self

    def save(self):
        self.calls["saved"] = True

    def first(self):
        return (1, 9)


def test_plain_scan():
    spark = Recorder()
    jdbc.jdbc_table(spark, "jdbc:x", "t", user="u", password="p", driver="d", fetchsize=1000)
    assert spark.calls["format"] == "jdbc"
    assert spark.calls["options"] == {
        "url": "jdbc:x",
        "dbtable": "t",
        "user": "u",
        "password": "p",
        "driver": "d",
        "fetchsize": "1000",
    }


def test_parallel_scan():
    spark = Recorder()
    jdbc.jdbc_table(spark, "jdbc:x", "t", partition_column="id", bounds=(1, 9), num_partitions=4)
    got = spark.calls["options"]
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("id", "1", "9", "4")
    with pytest.raises(ValueError):
        jdbc.jdbc_table(spark, "jdbc:x", "t", partition_column="id")


def test_bounds_are_computed_by_the_database():
    spark = Recorder()
    assert jdbc.jdbc_bounds(spark, "jdbc:x", "t", "id") == (1, 9)
    assert "MIN(id)" in spark.calls["options"]["dbtable"]


def test_append_and_replace():
    df = Recorder()
    jdbc_append_sink("jdbc:x", "t", user="u")(df, 0)
    assert df.calls["mode"] == "append" and "truncate" not in df.calls["options"] and df.calls["saved"]
    df = Recorder()
    jdbc_replace_sink("jdbc:x", "t")(df, 0)
    assert df.calls["mode"] == "overwrite" and df.calls["options"]["truncate"] == "true"
