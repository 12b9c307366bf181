import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.schema import TRANSACTIONS  # noqa: E402
from tillroll.session import local_session  # noqa: E402
from tillroll.staging import scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="4g", shuffle_partitions=4)
    # keep several partitions on tiny tables, so that global orders really span them
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    with scratch(session):
        yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Build transaction lines from short tuples; see ``make_line``."""

    def build(*rows):
        return spark.createDataFrame([make_line(*r) for r in rows], TRANSACTIONS)

    return build


def make_line(invoice, stock, quantity, when, price, customer, country="United Kingdom", description="THING"):
    from datetime import datetime
    from decimal import Decimal

    return (invoice, stock, description, quantity, datetime.fromisoformat(when), Decimal(str(price)), customer, country)
