"""JDBC option wiring, checked with a recording reader (no database is
started here, so the real driver path is not exercised)."""

import pytest

from dockhand.sources import tables
from dockhand.sources.tables import Source, import_query, import_table


class Recorder:
    def __init__(self, spark, log):
        self.spark, self.log, self.opts = spark, log, {}

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        if "query" in self.opts and "min(" in self.opts["query"]:
            return self.spark.createDataFrame([(3, 99)], "lo bigint, hi bigint")
        return self.spark.range(1)


@pytest.fixture
def log(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(Source, "reader", lambda self, sp: Recorder(sp, calls).option("url", "jdbc:x"))
    return calls


def test_import_table_pushes_subquery_and_splits(spark, log):
    import_table(spark, "sales.orders", Source(format="jdbc"), columns=["id", "amount"], where="day = '2024-01-01'",
                 split_by="id", num_partitions=4, fetch_size=500)
    bounds, read = log
    assert bounds["query"].startswith("SELECT min(id) AS lo, max(id) AS hi FROM (SELECT id, amount FROM sales.orders")
    assert read["dbtable"] == "(SELECT id, amount FROM sales.orders WHERE day = '2024-01-01') import_src"
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == (
        "id", "3", "99", "4")
    assert read["fetchsize"] == "500"


def test_import_query_split_uses_dbtable(spark, log):
    import_query(spark, "SELECT * FROM t", Source(format="jdbc"), split_by="id", num_partitions=2)
    assert log[-1]["dbtable"] == "(SELECT * FROM t) import_q" and "query" not in log[-1]
    import_query(spark, "SELECT * FROM t", Source(format="jdbc"))
    assert log[-1]["query"] == "SELECT * FROM t" and "partitionColumn" not in log[-1]


def test_jdbc_write_options(spark, monkeypatch):
    from dockhand.sinks.jdbc import jdbc_write
    seen = {}

    class W:
        def format(self, f):
            seen["format"] = f
            return self

        def mode(self, m):
            seen["mode"] = m
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def save(self):
            seen["saved"] = True

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: W()))
    jdbc_write(spark.range(10), "jdbc:x", "stage.t", batch_size=200, num_partitions=2)
    assert seen == {"format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "stage.t", "batchsize": "200",
                    "isolationLevel": "READ_COMMITTED", "saved": True}
