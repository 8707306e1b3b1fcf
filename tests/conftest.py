from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="cartwheel-tests")
    yield s
    s.stop()


def raw_row(**kw):
    """A raw event with sensible defaults; override any column by keyword."""
    base = dict(
        event_id="e1",
        event_timestamp=datetime(2024, 1, 5, 10, 0, 0),
        event_date=date(2024, 1, 5),
        event_name="view_item",
        user_pseudo_id="u1",
        customer_id=None,
        ga_session_id="s1",
        device_category="mobile",
        country="X",
        campaign_id="cmp_1",
        traffic_source="src_1",
        traffic_medium="cpc",
        item_id="prod_1",
        item_category="cat_1",
        item_name="Item 1",
        quantity=None,
        purchase_revenue=None,
    )
    base.update(kw)
    return base


@pytest.fixture
def make_raw(spark):
    from cartwheel.schema import RAW_EVENTS

    def build(rows):
        return spark.createDataFrame([tuple(r[f.name] for f in RAW_EVENTS.fields) for r in rows], RAW_EVENTS)

    return build
