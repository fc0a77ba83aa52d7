"""What the tests of the operators share."""

import pytest

SF001 = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture
def documents(spark):
    """documents from rows (doc_id, text[, lang, source]) with every column nullable."""

    def make(rows):
        full = [(*r, *([None] * (4 - len(r)))) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string")

    return make
