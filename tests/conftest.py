import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marsad.session import local_session

    os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ.setdefault("MARSAD_DRIVER_MEMORY", "4g")
    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
