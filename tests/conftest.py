import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, app="tests", **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        }
    )
    yield session
    session.stop()


def rows(frame, *columns):
    """Rows as sorted tuples, dates as ISO text."""
    frame = frame.select(*columns) if columns else frame

    def plain(v):
        return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v

    return sorted((tuple(plain(v) for v in r) for r in frame.collect()), key=repr)
