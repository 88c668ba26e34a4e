import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd(spark):
    """The table of odd rows, written so that it rereads in one order."""
    from helpers import SCHEMA, odd_rows

    from tidemark.llm.common import written

    return written(spark.createDataFrame(odd_rows(), SCHEMA).coalesce(2), "odd")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
