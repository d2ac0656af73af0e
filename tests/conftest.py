from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from perkline.session import build_session

    extra = {"spark.ui.showConsoleProgress": "false"}
    session = build_session("local[4]", 8, app_name="perkline-tests", extra=extra)
    # tests only: a private checkpoint folder when the session names none
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        d = tempfile.mkdtemp(prefix="perkline-test-ckpt-")
        session.conf.set("spark.checkpoint.dir", d)
        session.sparkContext.setCheckpointDir(d)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as tuples (sorted), for small test frames only."""
    sel = df.select(*cols) if cols else df
    got = [tuple(r) for r in sel.collect()]
    try:
        return sorted(got, key=lambda t: tuple((x is None, x) for x in t))
    except TypeError:
        return sorted(got, key=repr)
