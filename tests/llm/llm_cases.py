"""Frames with awkward rows; test modules import these fixtures."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "d long, h long, k string, p int, drop string, line string, score double, doc string, "
          "`a.b` int, copy_of_smaller_id long")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with extra columns whose names the operators use inside."""
    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t), 1, 2, "x", 3, "y", "z", 0.5, "w", 4, 5)
                for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


#: nulls in id and text, empty texts, repeats and a very long word
NASTY = [(1, "Hello there, a first line of text\nshort\nHello there, a first line of text"),
         (2, None), (3, ""), (None, "text without an id, and a first line of text"),
         (None, None), (4, "hello THERE, a first line of text \n\n"),
         (4, "hello THERE, a first line of text \n\n"), (5, "\n\n"), (6, "x" * 3000),
         (7, "1234 5678 !!"), (8, "café Été 你好 \U0001f600")]


@pytest.fixture(scope="session")
def nasty(docs_of):
    return docs_of(NASTY)


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
