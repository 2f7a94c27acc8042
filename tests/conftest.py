import uuid

import pytest

from tablewright.session import build_session, ship_package


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def db(spark, tmp_path):
    """A fresh database, dropped afterwards."""
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def lake(spark, tmp_path):
    """The raw order and customer files, cataloged, and empty target databases."""
    from tablewright.sources import register_path
    from tests import fixtures

    paths = fixtures.write_all(tmp_path)
    for name in ("raw", "processed", "reporting"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/{name}'")
    register_path(spark, "raw", "orders", paths["orders"], "csv")
    register_path(spark, "raw", "orders_bad", paths["orders_bad"], "csv")
    register_path(spark, "raw", "customers", paths["customers"], "json")
    register_path(spark, "raw", "serverlog", paths["serverlog"], "text")
    yield {**paths, "root": str(tmp_path)}
    for name in ("raw", "processed", "reporting"):
        spark.sql(f"DROP DATABASE {name} CASCADE")
