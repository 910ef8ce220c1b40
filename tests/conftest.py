import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from impactspark.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="impactspark-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples (None sorts first)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
