"""Search items of the checks are made from whole tables."""

from pathlib import Path

import pytest

from checks import files, views

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables are not here")


def test_every_order_and_customer_is_parsed(spark):
    v = views.Views(spark, DATA)
    assert files.all_items(v).count() == v.orders.count() + v.customer.count()
