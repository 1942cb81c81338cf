from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecourt.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loaded(spark):
    """The written warehouse of the smallest data folder."""
    from forecourt import registry

    return registry.warehouse(spark, SF).load()


@pytest.fixture(scope="session")
def sample(spark):
    """A small generated data set, as text, held in memory."""
    from forecourt.contracts import DATASETS
    from forecourt.sources.files import as_file_text
    from forecourt.sources.generate import SampleConfig, generate_datasets

    config = SampleConfig(customers=40, vehicles=80, dealerships=2, employees=20, sales=50, inventory=30,
                          service_appointments=60, service_orders=50)
    frames = generate_datasets(spark, config)
    return {name: as_file_text(DATASETS[name], frame).cache() for name, frame in frames.items()}
