import os

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, repeated rows and ids, a long unbroken text, a clashing extra column.
ODD_TEXTS = [
    (1, "a plain text of a few words"), (1, "a plain text of a few words"), (2, None), (3, ""), (None, "an unnamed text"),
    (None, None), (4, " \n\t "), (5, "x" * 60_000), (6, "日本語のテキスト"), (7, "!!! ??? ..."), (1, "another text under a repeated id"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", "s", 0 if t is None else len(t), "mine") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
