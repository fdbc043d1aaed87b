import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tarmac.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
