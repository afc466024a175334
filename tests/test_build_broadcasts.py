"""The stored build broadcasts small sides only, so little passes the driver (F1)."""

import pytest

from stratalake.plans import queries, stored
from stratalake.plans.pipeline import Pipeline
from stratalake.session import settings
from stratalake.sources import fixtures as fx

THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_settings_come_back_after_an_error(spark):
    before = [spark.conf.get(k, None) for k in THRESHOLDS]
    with pytest.raises(ZeroDivisionError):
        with settings(spark, dict.fromkeys(THRESHOLDS, "1k")):
            assert [spark.conf.get(k) for k in THRESHOLDS] == ["1k", "1k"]
            1 / 0
    assert [spark.conf.get(k, None) for k in THRESHOLDS] == before


def test_stored_build_broadcasts_small_sides_only(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(stored, "_LAKES", {})
    monkeypatch.setattr(fx, "land_extracts", lambda *a: seen.append([spark.conf.get(k) for k in THRESHOLDS]))
    monkeypatch.setattr(Pipeline, "run_day", lambda *a: seen.append([spark.conf.get(k) for k in THRESHOLDS]))
    before = [spark.conf.get(k, None) for k in THRESHOLDS]
    stored.backfilled(spark, sf)
    assert seen == [["512k", "512k"]] * 4
    assert [spark.conf.get(k, None) for k in THRESHOLDS] == before


def test_layers_of_breaks_are_built_with_small_broadcasts(spark, sf, monkeypatch):
    seen, build = [], queries.recon_variants
    monkeypatch.setattr(queries, "recon_variants",
                        lambda *a: seen.append([spark.conf.get(k) for k in THRESHOLDS]) or build(*a))
    queries.recon_breaks(spark, sf)
    assert seen == [["512k", "512k"]]
