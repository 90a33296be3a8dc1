import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vitrine-test-"))
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    """An instant in UTC."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Sorted tuples of a small result, with timestamps as UTC text."""
    picked = df.select(*columns) if columns else df
    out = []
    for r in picked.collect():
        cells = []
        for v in r:
            if isinstance(v, dt.datetime):
                v = v.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S") if v.tzinfo else str(v)
            elif isinstance(v, dt.date):
                v = v.isoformat()
            cells.append(v)
        out.append(tuple(cells))
    return sorted(out, key=lambda t: tuple((c is not None, str(type(c)), c) for c in t))
