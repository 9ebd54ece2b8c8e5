import os

import pytest

from haulage.session import local_session

SF_DIR = os.environ.get("HAULAGE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("derby")
    session = local_session(
        cpus=4,
        name="haulage-tests",
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={home}",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
