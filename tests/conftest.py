from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tickbars.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tickbars-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


TICK_SCHEMA = (
    "arrival_seq BIGINT, symbol STRING, px DECIMAL(18,6), sz DECIMAL(18,6), event_ts_ms BIGINT, "
    "api_send_ts_ms BIGINT, source_event_ts_ms BIGINT"
)


@pytest.fixture
def ticks_of(spark):
    """Ticks from (symbol, event_ts_ms, px, sz) in arrival order."""

    def make(rows):
        data = [
            (i, s, Decimal(str(px)), Decimal(str(sz)), t, t + 20, t) for i, (s, t, px, sz) in enumerate(rows)
        ]
        return spark.createDataFrame(data, TICK_SCHEMA)

    return make


BIN_SCHEMA = (
    "bin_id STRING, symbol STRING, start_ts_ms BIGINT, end_ts_ms BIGINT, window_ms BIGINT, open DECIMAL(18,6), "
    "high DECIMAL(18,6), low DECIMAL(18,6), close DECIMAL(18,6), volume DECIMAL(18,6), notional DECIMAL(18,6), "
    "trade_count BIGINT, max_lateness_ms BIGINT, api_send_ts_ms BIGINT, source_event_ts_ms BIGINT, "
    "ingest_ts_ms BIGINT, source STRING"
)


@pytest.fixture
def bins_of(spark):
    """Flat bins from (symbol, start_ts_ms, px, volume)."""

    def make(rows):
        data = []
        for s, t, px, v in rows:
            p, v = Decimal(str(px)), Decimal(str(v))
            data.append((f"{s}-{t:013d}", s, t, t + 10, 10, p, p, p, p, v, p * v, 1, 0, t + 20, t, t + 30, "replay"))
        return spark.createDataFrame(data, BIN_SCHEMA)

    return make


BAR_SCHEMA = (
    "bar_id STRING, symbol STRING, start_ts_ms BIGINT, end_ts_ms BIGINT, open DECIMAL(18,6), high DECIMAL(18,6), "
    "low DECIMAL(18,6), close DECIMAL(18,6), volume DECIMAL(18,6), notional DECIMAL(18,6), vwap DOUBLE, bin_count BIGINT, "
    "max_lateness_ms BIGINT, api_send_ts_ms BIGINT, source_event_ts_ms BIGINT, ingest_ts_ms BIGINT, source STRING"
)


@pytest.fixture
def bars_of(spark):
    """Flat one-second bars from (symbol, start_ts_ms, px, volume)."""

    def make(rows):
        data = []
        for s, t, px, v in rows:
            p, v = Decimal(str(px)), Decimal(str(v))
            data.append(
                (f"{s}-{t:013d}", s, t, t + 1000, p, p, p, p, v, p * v, float(px), 1, 0, t + 20, t, t + 1500, "aggregator")
            )
        return spark.createDataFrame(data, BAR_SCHEMA)

    return make
