"""What the tests of this folder share."""

import pytest

from tickward.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    """Tasks import the package wherever the tests are run from."""
    ship(spark)
