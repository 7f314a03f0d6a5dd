import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import checkpoint_root, get_spark
    s = get_spark("vigil-tests", "local[4]", 8, extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a local one only when the session has none
    yield s
