import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark("tests", "8", spark__sql__shuffle__partitions="8")


@pytest.fixture(scope="session")
def frame(spark):
    import pandas as pd

    def make(**cols):
        return spark.createDataFrame(pd.DataFrame(cols))

    return make
