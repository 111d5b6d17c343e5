import pytest


@pytest.fixture
def docs_of(spark, tmp_path_factory):
    """Write rows as a documents table of several files and read it back."""
    def make(rows, columns="doc_id long, text string, lang string, source string, n_chars long", parts=3):
        width = len(columns.split(","))
        rows = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(rows, columns).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)
    return make
