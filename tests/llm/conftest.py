import pytest

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents():
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet' ORDER BY doc_id")
    return [(i, t or "", lang) for i, t, lang in rows.fetchall()]
