from __future__ import annotations

import pytest
from tests_llm import ODD_TEXTS, documents


@pytest.fixture
def odd(spark):
    return documents(spark, ODD_TEXTS)


@pytest.fixture
def empty(spark):
    return documents(spark, [])
