import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import CHECKPOINT_KEY, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark__sql__shuffle__partitions": "4",
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
        CHECKPOINT_KEY.replace(".", "__"): str(tmp_path_factory.mktemp("scratch")),
    }
    session = build_session("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def canon():
    """The 13-column snapshot frame from short rows."""

    def build(spark, rows):
        schema = (
            "subject string, sheet_type string, period string, name string, esi_field string, "
            "highly_cited_papers int, indicative_cross_field_score double, hot_papers int, times_cited int"
        )
        return spark.createDataFrame(rows, schema)

    return build
