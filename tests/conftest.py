import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trackcast.session import get_session
    s = get_session("local[4]", app="trackcast-tests", extra={"spark.sql.shuffle.partitions": "4"})
    # tests run without a cluster: only here is a private checkpoint folder set
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trackcast-ckpt-"))
    yield s


def rows(df, *cols):
    """Collected rows as tuples (small test frames only)."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
