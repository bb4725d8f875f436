import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from panelrisk.session import local_session
    log = tempfile.mkdtemp(prefix="panelrisk-events-")
    s = local_session("*", 8, app="panelrisk-tests", spark__eventLog__enabled="true",
                      spark__eventLog__dir=f"file://{log}", spark__eventLog__rolling__enabled="false",
                      spark__eventLog__compress="false")
    yield s
    s.stop()


@pytest.fixture
def df(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
