import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from riskloom.session import local_session

    checkpoints = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(
        "tests", cores=4, **{"spark.checkpoint.dir": checkpoints}
    )
    yield session
    session.stop()
