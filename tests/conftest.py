import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from listenkpi.session import drop_scratch, local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="listenkpi-tests")
    yield s
    drop_scratch(s)
    s.stop()


PLAYS_SCHEMA = "user_id string, track_id string, listen_time string"
SONGS_SCHEMA = ("track_id string, track_name string, artists string, track_genre string, "
                "duration_ms bigint, popularity bigint")


@pytest.fixture
def make(spark):
    def _make(plays=None, songs=None):
        p = spark.createDataFrame(plays or [], PLAYS_SCHEMA)
        s = spark.createDataFrame(songs or [], SONGS_SCHEMA)
        return p, s
    return _make


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (NULLs first)."""
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
