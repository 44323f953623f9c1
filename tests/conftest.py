import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
for folder in (ROOT, HERE):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session

    session = get_session(master="local[*]", shuffle_partitions=8)
    env = session.sparkContext.environment  # Python workers import the library from any working folder
    env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    return session
