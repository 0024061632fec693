import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bandlore.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session(8, "tests", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=folder,
                            spark__driver__memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def signals(spark, small):
    from bandlore.sources.signals import embedding_signals

    return embedding_signals(spark, f"{small}/embeddings.parquet").cache()
