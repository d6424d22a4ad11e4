from __future__ import annotations

import pytest

from forumlens.llm.common import ship

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The given documents of the smallest size."""
    return "/root/testdata/sf0.001"
