from __future__ import annotations

import uuid

import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database name of its own, dropped afterwards."""
    name = f"db_{uuid.uuid4().hex[:12]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
