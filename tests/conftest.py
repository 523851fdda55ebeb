import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    small = {"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2"}
    session = local_session("8", "tests", **{"spark.checkpoint.dir": str(shared)}, **small)
    yield session
    session.stop()
