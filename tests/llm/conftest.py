import pytest

#: Texts with their ids: null, empty, white space, repeated rows, marks, other scripts, a long one, a null id.
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "The cat sat on the mat."), (4, "The cat sat on the mat."), (5, "!!! 12 ..."), (6, "Ünïcode 日本語 textE ǅ"), (7, "word " * 5000), (8, "the cat sat on the mat and then the dog ran off to the old red barn"), (None, "no id at all")]


@pytest.fixture
def docs(spark):
    """Documents with columns whose names the operators use themselves."""
    data = [(i, t, "en" if n % 2 else None, None if n == 3 else f"s{n % 2}", len(t or ""), n, "x", 1.0) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, h long, row string, score double")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
