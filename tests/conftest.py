import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from townpulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("*")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Run a function under several shuffle partition counts and give back the results."""

    def under_each(fn, counts=(1, 7, 64)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            results = []
            for n in counts:
                spark.conf.set("spark.sql.shuffle.partitions", str(n))
                results.append(sorted(tuple(r) for r in fn().collect()))
            return results
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    return under_each
