import datetime as dt

import pytest
from pyspark.sql import SparkSession

REVISIONS = (
    "article_title STRING, revid BIGINT, user STRING, userid BIGINT, edit_timestamp TIMESTAMP, "
    "content_length BIGINT, is_revert BOOLEAN"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("quillwatch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return dt.datetime.fromisoformat(text)


def later(seconds, start="2024-01-01T00:00:00"):
    return at(start) + dt.timedelta(seconds=seconds)


@pytest.fixture
def revisions(spark):
    """Build a revision table from (title, revid, user, time[, length[, is_revert]])."""

    def build(rows):
        full = []
        for title, revid, user, time, *rest in rows:
            length = rest[0] if rest else 100
            revert = rest[1] if len(rest) > 1 else False
            userid = 0 if user is None or user.startswith("ip") else 1
            full.append((title, revid, user, userid, time, length, revert))
        return spark.createDataFrame(full, REVISIONS)

    return build
