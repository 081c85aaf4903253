"""A session whose workers find the package, and small tables of documents."""

import pytest

from flowmetrics.llm.shipping import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def session(spark):
    ship_package(spark)
    return spark


@pytest.fixture
def documents(session):
    """Builds a documents table of (doc_id, text) rows, spread over some partitions."""

    def build(rows, partitions=3):
        full = [(i, t, "en", f"src{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
        return session.createDataFrame(full, DOCS).repartition(partitions)

    return build
