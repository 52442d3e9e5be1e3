import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from jobtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluates a column expression over a list of texts and returns the results in order."""

    def run(expression, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", expression.alias("y"))
        return [r.y for r in sorted(df.collect(), key=lambda r: r.i)]

    return run
