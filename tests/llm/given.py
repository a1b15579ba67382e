"""Tables that the tests of several operators share, as fixtures to import."""

from collections import Counter
from pathlib import Path

import pytest
from plain import TEXTS
from pyspark.sql import Row

from aerometry.llm.documents import share_library
from aerometry.session import shared_root

DOCUMENT = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words long, score double, digest string, packed string, spans string, "
    "features string, band string, quality int, `__id` long, start int, cell string"
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents with columns whose names the operators use too."""
    share_library(spark)

    def make(texts):
        rows = [
            (i, t, None, "s", None if t is None else len(t), -1, -1.0, "d", "p", "s", "f", "b", 7, 1, 1, "c")
            for i, t in texts
        ]
        return spark.createDataFrame(rows, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def edges(documents):
    return documents(TEXTS)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])


@pytest.fixture(scope="session")
def labels(spark):
    def make(marks):
        rows = [Row(doc_id=i, quality=q, toxic=0) for i, q in marks]
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


@pytest.fixture
def stays(spark):
    """What a call leaves in the shared folder, by purpose: its result, and the tables it kept."""

    def tables():
        root = Path(shared_root(spark))
        return Counter(p.name.rpartition("-")[0] for p in root.iterdir()) if root.exists() else Counter()

    def run(call):
        before = tables()
        found = call()
        return found, tables() - before

    return run
