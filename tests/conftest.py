import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

AT = datetime(2024, 2, 1, 3)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tidemark-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df, *columns):
    """Rows as sorted tuples, NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])


def ts(text):
    return datetime.fromisoformat(text)


def exploded(df):
    """Final physical plan text after running ``df``."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()
