import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starloom.session import get_spark

    s = get_spark(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from starloom.plans.views import Tables

    return Tables(spark, "/root/testdata/sf0.001")
