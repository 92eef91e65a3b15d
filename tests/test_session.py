"""Size checks and folders."""

import pytest
from pyspark.sql import functions as F

from corpusforge import session


def test_only_small_tables_are_broadcast(spark):
    few = spark.createDataFrame([(1, "a")], "k long, v string")
    plan = lambda df: spark.range(9).toDF("k").join(session.small(df, 1 << 10), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(few)
    assert "strategy=broadcast" not in plan(spark.range(1 << 20).select(F.col("id").alias("k"), F.lit("a").alias("v")))


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": staticmethod(lambda: type("D", (), {"isDefined": staticmethod(lambda: False)}))})

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})

    with pytest.raises(ValueError, match="share"):
        session.ensure_checkpoint_dir(Session)
