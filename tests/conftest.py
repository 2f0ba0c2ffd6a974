import os
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers

import pytest  # noqa: E402

from chronicell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app="chronicell-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session
