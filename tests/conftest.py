import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortline.config import RetentionConfig  # noqa: E402
from cohortline.session import build_session  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

RAW = ("invoice string, stock_code string, description string, quantity bigint, "
       "invoice_date timestamp_ntz, price double, customer_id bigint, country string, "
       "source_sheet string")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return RetentionConfig(
        observation_start=datetime(2020, 1, 1), cutoff=datetime(2021, 1, 1), horizon_days=90,
        country_vocab=("France", "Other", "Spain"), min_country_customers=2)


class Log:
    """Builds log rows with defaults."""

    def __init__(self, spark):
        self.spark, self.rows = spark, []

    def add(self, customer, when, invoice, code="20001", qty=1, price=2.0, country="France",
            description="thing", sheet="one"):
        self.rows.append(
            (invoice, code, description, qty, when, price, customer, country, sheet))
        return self

    def frame(self):
        return self.spark.createDataFrame(self.rows, RAW)


@pytest.fixture
def log(spark):
    return Log(spark)
