import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Builds a frame from a DDL schema and tuples."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def settings(spark):
    before = {}

    def put(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def as_set(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    found = [tuple(r) for r in picked.collect()]
    assert len(found) == len(set(found)), "repeated rows"
    return set(found)
