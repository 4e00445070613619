import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.session import build_session  # noqa: E402
from tillflow.streaming.bronze import FEED_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="tillflow-tests", shuffle_partitions=8)
    yield s
    s.stop()


def msg(customer=1, kind="purchase", invoice="100", code="A1", desc="thing", qty=1, price=2.0,
        country="X", when="2020-01-01T10:00:00", sent=None):
    return {"timestamp": sent or when, "kullanici_ID": customer, "olay_tipi": kind, "ilgili_ID": invoice,
            "stock_code": code, "description": desc, "quantity": qty, "unit_price": price,
            "country": country, "invoice_date": when}


def records(spark, messages, start_offset=0, raw=False):
    """Broker records frame from message dicts (or raw value strings when raw=True)."""
    rows = []
    for i, m in enumerate(messages):
        value = m if raw else json.dumps(m)
        rows.append(("t", 0, start_offset + i, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=start_offset + i),
                     None, value))
    return spark.createDataFrame(rows, FEED_SCHEMA)
