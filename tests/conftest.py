import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from blotter.session import ensure_checkpoint_dir, local_session
    s = local_session(4, 4, app="blotter-tests", driver_memory="4g", extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="blotter-test-ckpt-")})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (of ``cols`` if given)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
