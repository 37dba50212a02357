import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerweave.operators.workspace import Workspace  # noqa: E402
from ledgerweave.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8)


@pytest.fixture
def ws(spark):
    return Workspace(spark, "test")
