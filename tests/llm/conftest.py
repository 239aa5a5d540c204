import pytest

from burstline.llm.common import prepare


@pytest.fixture(autouse=True)
def shipped(spark):
    prepare(spark)
