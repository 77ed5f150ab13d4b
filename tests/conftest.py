import os
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plantmetrics.session import build_session  # noqa: E402


# The published figures aren't part of the repository; the same jobs are held against SQL in test_whole_run.py.
collect_ignore = [] if os.environ.get("PLANTMETRICS_GOLDEN_DIR") else ["test_golden.py"]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def same_rows():
    def check(left, right):
        """Equal as multisets, whatever the column order."""
        rows = [Counter(frame.select(*left.columns).collect()) for frame in (left, right)]
        assert (rows[0] - rows[1], rows[1] - rows[0]) == (Counter(), Counter())

    return check
