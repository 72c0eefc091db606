import os
import sys

import pytest

from paths import SF01

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from threatlake.session import get_spark
    s = get_spark("local[8]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    from threatlake.oracle.compare import duckdb_connection
    from threatlake.sources.bindings import TABLES
    return duckdb_connection(SF01, TABLES)
