import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from voxelflow.session import build_session
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    extra = {}
    if active is None or not active.conf.get("spark.checkpoint.dir", None):
        # tests only: the checkpoint folder is unset, so take a fresh scratch one
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="vf-test-ckpt-")
    s = build_session("local[8]", shuffle_partitions=8, extra=extra)
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
