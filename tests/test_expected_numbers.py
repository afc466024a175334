"""The documented sf0.01 numbers of the derived fixture (FIXTURES.md)."""

import decimal
import os

import pytest
from pyspark.sql import functions as F

from stratalake.plans.queries import Chain, scd2_version_accounting

from .conftest import SF_MEDIUM

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_MEDIUM), reason="sf0.01 not present")


def test_layer_sizes_and_revenue(spark):
    ch = Chain(spark, SF_MEDIUM)
    sizes = {t: df.count() for t, df in ch.silver.items()}
    assert sizes == {"customers": 1500, "products": 2000, "orders": 14619,
                     "order_items": 44200}
    r = ch.recon().first()
    assert r.fact_rows == 44200
    assert r.fact_revenue == r.silver_revenue == decimal.Decimal("59624500811.31")
    assert r.unresolved_customer_sk == 0 and r.multi_current_versions == 0


def test_version_accounting(spark):
    a = scd2_version_accounting(spark, SF_MEDIUM).first()
    # 1,500 current; 300 keys with history, 150 of them with three versions
    assert (a.total_versions, a.current_versions, a.changed_keys, a.max_versions) == \
        (1950, 1500, 300, 3)
    dim = Chain(spark, SF_MEDIUM).dim_customer
    extra = dim.groupBy("customer_id").count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert a.total_versions == a.current_versions + extra
