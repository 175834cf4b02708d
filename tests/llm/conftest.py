import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows and a DDL schema."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def table_dir(spark, tmp_path_factory):
    """Writes small tables as parquet and returns their folder, as queries read it."""
    def make(**tables):
        path = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.coalesce(1).write.parquet(str(path / f"{name}.parquet"))
        return str(path)
    return make
