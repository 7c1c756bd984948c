import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillpoint.session import get_spark
    s = get_spark(master="local[4]", app="tillpoint-tests", shuffle_partitions=4,
                  extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    from tillpoint.session import checkpoint_dir
    checkpoint_dir(s)  # configured folder, or a local one when unset
    yield s
    s.stop()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="tillpoint-test-out-")
