import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    warehouse = tempfile.mkdtemp(prefix="strata-wh-")
    session = build_session(
        "local[*]",
        app_name="strata-tests",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def fresh_schema(spark):
    """A new, empty schema per test (tables never leak between tests)."""
    import uuid

    name = "t_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE SCHEMA {name}")
    return name
