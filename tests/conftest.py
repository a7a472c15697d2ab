import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.session import local_session  # noqa: E402


# Tiny tables: compiling each new plan would take longer than running it.
FAST = {
    "spark.sql.shuffle.partitions": "2",
    "spark.default.parallelism": "2",
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "vitrine-tests", **FAST)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
