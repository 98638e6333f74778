import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def documents(spark):
    """A documents table from (doc_id, text, source) rows."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], schema)
    return make


@pytest.fixture()
def table_dir(spark, tmp_path):
    """A folder of tables, written from DataFrames."""
    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
