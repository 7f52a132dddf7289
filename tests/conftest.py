import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.schemas import ORDERS  # noqa: E402
from tillroll.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="tillroll-tests", shuffle_partitions=8)
    yield s
    s.stop()


def line(invoice, stock, qty, when, price, cust, country="UK", desc="ITEM"):
    """One order line; ``when`` is 'YYYY-MM-DD HH:MM' or a datetime."""
    if isinstance(when, str):
        when = dt.datetime.strptime(when, "%Y-%m-%d %H:%M")
    return (invoice, stock, desc, qty, when, None if price is None else Decimal(str(price)), cust, country)


@pytest.fixture
def make_orders(spark):
    def _make(rows):
        return spark.createDataFrame(rows, ORDERS)

    return _make
