import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle  # noqa: E402

import newsloom  # noqa: E402
from newsloom.session import local_session  # noqa: E402

cloudpickle.register_pickle_by_value(newsloom)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "4", app="newsloom-tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder,
           "spark.sql.warehouse.dir": folder + "/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of(spark):
    """Evaluate column expressions over rows and return the result rows in order."""
    def run(data, schema, *columns):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, " + schema)
        return [tuple(r)[1:] for r in sorted(df.select("i", *columns).collect())]
    return run
