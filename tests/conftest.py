import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquetry.session import local_session  # noqa: E402

# Columns can only be built with a session, and test parameters hold columns.
SPARK = local_session(8, "tests")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture
def one(spark):
    """Evaluate one column over a row of literal columns."""

    def evaluate(column, **values):
        schema = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items())
        row = tuple(value for _, value in values.values())
        df = spark.createDataFrame([row], schema) if values else spark.range(1)
        return df.select(column.alias("r")).collect()[0]["r"]

    return evaluate


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
