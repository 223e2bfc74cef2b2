import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellbulk.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cpus=8, memory="8g", partitions=4,
                            shared=f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
