import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quarrysql.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("quarrysql-tests", cores="8", shuffle=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def value(spark):
    """Evaluates a column function on a list of texts."""

    def run(make, texts, schema="x string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(make("x")).collect()]

    return run
