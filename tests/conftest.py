import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from kilovela.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = make_session("tests", cores=4, shuffle_partitions=4, driver_memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame(ddl, rows): a DataFrame; frame.rows(df): its rows as a sorted list of tuples."""

    def make(ddl, rows=()):
        return spark.createDataFrame(list(rows), ddl)

    make.rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    return make
