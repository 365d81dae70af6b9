from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagesieve.sources.session import session  # noqa: E402
from pagesieve.sources.workspace import clean  # noqa: E402


def make_session() -> SparkSession:
    """The product's own settings, on eight local threads."""
    spark = session(
        "pagesieve-tests", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g",
        spark_ui_enabled="false", spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    own = make_session()
    yield own
    clean(own)
