import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session, checkpoint_dir
    s = get_session("local[8]", app="tessera-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s
    s.stop()
