import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from entres.session import local_session

    return local_session(4, spark__sql__shuffle__partitions="4")
