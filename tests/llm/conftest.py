import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest  # noqa: E402

from hitledger.llm.common import ready  # noqa: E402


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    ready(spark)
