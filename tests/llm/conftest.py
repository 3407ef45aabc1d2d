import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, node string, label int, key string, grp string, score double, `group` long, n long"


def rows_of(texts, first=1):
    """Rows with the documents' columns and others whose names operators use inside."""
    return [(k, t, "en", "src0", len(t or ""), 7, "x", 1, "k", "g", 0.5, 3, 9) for k, t in enumerate(texts, first)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a null id, a long text, odd characters."""
    texts = [None, "", " \n\t ", "one", "a plain little text of seven words", "x" * 30_000, "word " * 40_000, "ünïcode ﬁ 漢字 \x1c   ok"]
    rows = rows_of(texts)
    rows += [rows[4], rows[4], (None, *rows[4][1:]), (None, None, None, None, None, *rows[4][5:])]
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(2)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, first=1: spark.createDataFrame(rows_of(texts, first), ODD_SCHEMA)
