import random

import pytest


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) as a table of documents with more columns, some of whose names could clash with an operator's own."""

    def make(rows, source=lambda i: "s"):
        schema = "doc_id long, text string, source string, score double, size long, class string, row int, hash long, copies int, Slot int, Host int, Licence int, `a.b` int"
        own = [(d, t, source(i), 0.5, 7, "x", 1, 2, 3, 4, 5, 6, 7) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(own, schema)

    return make
