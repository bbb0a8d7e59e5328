import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topicloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("local[8]", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Texts as a frame with ids from 0."""

    def make(*rows):
        return spark.createDataFrame(list(enumerate(rows)), "prompt_id long, raw_text string")

    return make


@pytest.fixture
def apply(texts):
    """A column function over texts, as a list of results in order."""
    from pyspark.sql import functions as F

    def run(fn, *rows):
        done = texts(*rows).select("prompt_id", fn(F.col("raw_text")).alias("v")).orderBy("prompt_id")
        return [r.v for r in done.collect()]

    return run
