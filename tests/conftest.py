from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def house(spark):
    from ledgerloom.plans.warehouse import warehouse

    return warehouse(spark, SMALL)


RAW_SCHEMA = (
    "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, "
    "Price string, `Customer ID` string, Country string"
)


@pytest.fixture(scope="session")
def ledger(spark):
    """Builds a raw text sheet from keyword overrides of one plain row."""

    def build(*overrides):
        plain = {
            "Invoice": "1", "StockCode": "100", "Description": "Widget", "Quantity": "1",
            "InvoiceDate": "2011-01-01", "Price": "2.0", "Customer ID": "12345", "Country": "UK",
        }
        rows = [tuple({**plain, **o}.values()) for o in overrides]
        return spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1)

    return build
