import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from coverlens.session import build_session  # noqa: E402

# Started on import: test modules build column expressions at module level.
SPARK = build_session(
    "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__default__parallelism="4",
    spark__checkpoint__dir=tempfile.mkdtemp(prefix="coverlens-tests-"),
    spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SPARK
    SPARK.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over a column ``v`` of strings (or of ``type``)."""
    def run(values, expression, type="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type}")
        return [r["out"] for r in rows.select("i", expression.alias("out")).orderBy("i").collect()]
    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
