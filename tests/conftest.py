import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tarweave.session import local_session, ship_package

    session = local_session("tests", cpus=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    # Plug-ins of the tests have to be importable in the workers too.
    for name in ("helpers.py", "test_jobs.py"):
        session.sparkContext.addPyFile(os.path.join(ROOT, "tests", name))
    yield session
    session.stop()
