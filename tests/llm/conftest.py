import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, ...) as a table, with columns whose names clash with results."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("doc_id", "text", "'x' AS component_id", "1 AS `odd name`", "true AS kept") if extra else df
    return make


@pytest.fixture(scope="session")
def small(spark):
    import pathlib
    folder = pathlib.Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("test tables are not here")
    return lambda name: spark.read.parquet(str(folder / f"{name}.parquet"))
