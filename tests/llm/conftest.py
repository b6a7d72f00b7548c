import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(*rows):
        return spark.createDataFrame([(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows], DOCS)

    return build


@pytest.fixture
def clashing():
    """The table with extra columns that operators use as names inside."""
    names = "size block ids texts class label n cell key log_weight target score copies mix_source words start base".split()

    def add(df):
        for name in names:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return add
