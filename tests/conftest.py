import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hoardline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "hoardline-tests")


@pytest.fixture
def frame(spark):
    """``frame(schema, *rows)`` as a DataFrame."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make
