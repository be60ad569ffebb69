import pytest

#: rows that every operator has to take: nulls, empty and blank texts, repeated rows, a null id, a very long text
ODD_TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"), (None, "no id at all"), (None, None),
             (5, "word " * 40_000), (6, "x" * 50_000), (7, "Ünï çødé — 中文 😀 ͸"), (7, "another text under the same id")]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd rows with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"src{k % 3}", len(t or ""), "a", 0.5, k) for k, (i, t) in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, _row long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
