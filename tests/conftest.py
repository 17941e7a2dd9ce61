import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from loamflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("loamflow-tests", "8", "6g", **{"spark.sql.shuffle.partitions": "4"})
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def conf(spark):
    """Session settings that are put back after the test."""
    saved = {}

    def change(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
