from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quakeframe.session import local_session

    session = local_session(4, "4g", **{
        "spark.sql.maxMetadataStringLength": "2000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    from compare import duck

    return duck("/root/testdata/sf0.001")


@pytest.fixture
def column(spark):
    """The values of an expression over a list of inputs."""
    from pyspark.sql import functions as F

    def evaluate(values, kind, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]

    return evaluate


@pytest.fixture
def quake_rows(spark):
    """Events from (id, second, magnitude) with optional further columns."""
    from pyspark.sql import functions as F

    def build(rows, **columns):
        rows = [(i, float(second), mag) for i, second, mag in rows]
        df = spark.createDataFrame(rows, "id string, second double, mag double").withColumn(
            "event_time", F.timestamp_micros((F.col("second") * 1_000_000).cast("bigint")))
        defaults = {
            "updated": F.col("event_time"), "latitude": F.lit(1.0), "longitude": F.lit(2.0),
            "depth": F.lit(10.0), "magType": F.lit("mb"), "place": F.lit("x, Chile"),
        }
        return df.withColumns({**defaults, **columns}).drop("second")

    return build
