import os

import pytest


@pytest.fixture(scope="session")
def sf():
    """The small tables of the driver."""
    return os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
