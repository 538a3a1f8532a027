import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from caselode.session import clear_staged, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, name="tests")
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over given texts, in order."""
    from pyspark.sql import functions as F

    def run(expression, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(3)
        out = rows.select("n", expression(F.col("t")).alias("x")).collect()
        return [r.x for r in sorted(out, key=lambda r: r.n)]

    return run
