import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tarnlake.session import build_session

    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(root / "warehouse"), spark__checkpoint__dir=str(root / "shared"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def plan():
    """Physical plan text of a DataFrame."""
    def text(df, mode="simple"):
        import contextlib
        import io

        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain(mode=mode)
        return out.getvalue()
    return text


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and skew limits small enough for test data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
