import pytest

from tidewatch.llm.shared import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SMALL, "documents").cache()


@pytest.fixture
def frame(spark):
    """docs(*texts): documents 0, 1, ... with these texts and a column that clashes with inner names."""

    def make(*texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, None, None, "x") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string")

    return make
