from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.schemas import REQUIRED_COLUMNS  # noqa: E402
from ordermill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ordermill-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A valid row; tests name only what they change.
GOOD = {
    "order_id": "N-1",
    "order_date": "2023-05-04",
    "customer_name": "Ines",
    "region": "west",
    "product_category": "Garden",
    "product_name": "Rake",
    "quantity": "3",
    "unit_price": "12.5",
    "discount": "0.2",
    "payment_method": "Cash",
}


def row(**changes):
    return {**GOOD, **changes}


@pytest.fixture
def frame(spark):
    """Builds a text frame of raw rows, numbered in order in ``pos``."""

    def build(*rows):
        columns = ", ".join(f"{name} string" for name in REQUIRED_COLUMNS)
        data = [(*[item[name] for name in REQUIRED_COLUMNS], pos) for pos, item in enumerate(rows)]
        return spark.createDataFrame(data, f"{columns}, pos int")

    return build
