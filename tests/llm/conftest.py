import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, fp string"


@pytest.fixture()
def make_docs(spark):
    """documents with extra columns whose names clash with the operators' own; every column may be NULL."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None, None, None, None) for i, t in rows], DOC_SCHEMA)
    return make


@pytest.fixture()
def odd_docs(make_docs):
    return make_docs(ODD)


LONG = "lorem ipsum dolor " * 20_000
#: NULL and empty texts, white space only, a very long text, repeated rows, a NULL id
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "One two three four."), (5, "One two three four."),
       (None, "One two three four."), (6, "tab\tand\x0bfeed ünï 東京 😀 <|endoftext|> ▁x  y "), (7, "a")]
