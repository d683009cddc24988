import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", 1) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        names = ("keep_id", "kept", "size", "token", "n", "doc", "host", "rank", "text_sha256")
        for name in names:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def as_dict():
    def make(df, key="doc_id"):
        return {r[key]: r.asDict() for r in df.collect()}

    return make
