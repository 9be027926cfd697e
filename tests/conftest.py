import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from giftledger.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one_value(spark):
    """Evaluate a column expression on literal values, one row each, in order."""
    from pyspark.sql import functions as F

    def evaluate(expression, values, dtype="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"n int, v {dtype}")
        return [row["r"] for row in df.select("n", expression(F.col("v")).alias("r")).orderBy("n").collect()]

    return evaluate
