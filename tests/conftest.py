import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Embedders and parsers that tests define live in test modules; workers find them here.
os.environ["PYTHONPATH"] = str(HERE)

from inkspan.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
