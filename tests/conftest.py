from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from cohortloom.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cohortloom-wh-")})
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="cohortloom-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cohortloom-test-")
