import pytest


@pytest.fixture()
def frame(spark):
    """A DataFrame of rows, dealt over several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return make


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
