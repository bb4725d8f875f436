import pytest

#: Texts with nulls, blanks, ties, repeats and one very long line.
ODD_TEXTS = [None, "", " ", "\n\t", "a", "A a", "word " * 40, "x" * 20_000, "ẞtraße ΣΑΣ é", "The same text.",
             "The same  text.", "The same text.", "0 1 2 3 4 5 6 7 8 9 10 11"]


@pytest.fixture
def odd_docs(spark):
    """Odd texts under ids with a null and a repeated row, and extra columns
    whose names clash with what the operators make."""
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else "s", "keep", 1.5)
            for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "en", "s", "x", 0.0), rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, _salt double")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
