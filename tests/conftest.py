import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("checkpoint"))
    s = (
        SparkSession.builder.master("local[4,2]")  # 2 attempts per task: failure-injection tests
        .appName("wxstar-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def obs_rows(spark, rows):
    """Raw long observations from tuples of 8 text fields (shorter tuples are padded)."""
    from wxstar.schemas import OBSERVATION_SCHEMA

    padded = [tuple(list(r) + [None] * (8 - len(r))) for r in rows]
    return spark.createDataFrame(padded, OBSERVATION_SCHEMA)


def plan_text(df) -> str:
    """The formatted physical plan as printed by ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
