import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from roadlens.session import build_session

    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "roadlens-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "checkpoints"),
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="5000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
