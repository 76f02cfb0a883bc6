import numpy as np
import pytest

np.seterr(over="ignore")


@pytest.fixture()
def frame(spark):
    """Rows as a DataFrame of a given schema."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make
