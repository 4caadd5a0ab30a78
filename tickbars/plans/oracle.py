"""The same results in plain SQL, written independently of the operators, to check them against.

Window functions, dense gap filling and self-joins are used freely here; the operators avoid them for scale.
"""

from __future__ import annotations

import re

# Named steps; each may refer to the ones before it.
STEPS: dict[str, str] = {}

STEPS["timed"] = """
SELECT *, epoch_us(ts) // 1000 AS source_ms, 1735822800000 + (epoch_us(ts) // 1000 - 1704067200000) // 600 AS event_ms,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE event_type WHEN 'click' THEN 'WDC' WHEN 'view' THEN 'AAPL' WHEN 'purchase' THEN 'MSFT'
                       WHEN 'signup' THEN 'TSLA' WHEN 'error' THEN 'ZZZ' END AS sym
FROM events"""

STEPS["ticks"] = """
SELECT ((event_ms - 1735822800000) + (event_id * 7919) % 1500) * 2000000000000 + event_id AS arrival_seq,
       sym AS symbol, CAST(value AS DECIMAL(18,6)) AS px, CAST(value - 0.01 AS DECIMAL(18,6)) AS bid,
       CAST(value + 0.01 AS DECIMAL(18,6)) AS ask, CAST(k AS DECIMAL(18,6)) AS sz, event_ms AS event_ts_ms,
       CASE WHEN event_id % 17 <> 0 THEN event_ms + 20 + event_id % 30 END AS api_send_ts_ms,
       source_ms AS source_event_ts_ms, 'mock_api' AS source
FROM timed"""

STEPS["normalized"] = """
SELECT ((event_ms - 1735822800000) + (event_id * 7919) % 1500) * 2000000000000 + event_id AS arrival_seq,
       CASE WHEN k = 13 THEN 'WDC' ELSE sym END AS symbol,
       CASE WHEN k <> 7 THEN CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) END AS px,
       CAST(CAST(value - 0.01 AS DECIMAL(18,6)) AS DOUBLE) AS bid,
       CASE WHEN k <> 19 THEN CAST(CAST(value + 0.01 AS DECIMAL(18,6)) AS DOUBLE) END AS ask,
       CASE WHEN k <> 23 THEN CAST(k AS DOUBLE) ELSE 0.0::DOUBLE END AS sz,
       CASE WHEN k <> 11 THEN event_ms END AS event_ts_ms,
       CASE WHEN k <> 29 THEN event_ms END AS api_send_ts_ms,
       source_ms AS source_event_ts_ms, 'mock_api' AS source
FROM timed"""

STEPS["classified"] = """
SELECT *, greatest(coalesce(max(event_ts_ms) OVER (PARTITION BY symbol ORDER BY arrival_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - event_ts_ms, 0) AS lateness_ms
FROM ticks"""

_BINS = """
SELECT symbol || '-' || lpad(CAST(b AS VARCHAR), 13, '0') AS bin_id, symbol, b AS start_ts_ms, b + 10 AS end_ts_ms,
       CAST(10 AS BIGINT) AS window_ms, open, high, low, close, volume, notional, trade_count, max_lateness_ms,
       api_send_ts_ms, source_event_ts_ms, b + 10 + 500 + (b // 10) % 200 AS ingest_ts_ms, 'replay' AS source
FROM (SELECT symbol, event_ts_ms - event_ts_ms % 10 AS b, arg_min(px, arrival_seq) AS open, max(px) AS high,
             min(px) AS low, arg_max(px, arrival_seq) AS close, CAST(sum(sz) AS DECIMAL(18,6)) AS volume,
             CAST(sum(px * sz) AS DECIMAL(18,6)) AS notional, count(*) AS trade_count,
             max(lateness_ms) AS max_lateness_ms, min(api_send_ts_ms) AS api_send_ts_ms,
             min(source_event_ts_ms) AS source_event_ts_ms
      FROM classified WHERE lateness_ms <= {late} GROUP BY ALL)"""
STEPS["bins"] = _BINS.format(late=500)
STEPS["strict_bins"] = _BINS.format(late=250)

STEPS["arriving"] = """
SELECT *, greatest(coalesce(max(end_ts_ms) OVER (PARTITION BY symbol ORDER BY arrival_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - end_ts_ms, 0) AS lateness_ms
FROM (SELECT *, (end_ts_ms + ((start_ts_ms // 10) * 7919) % 1500) * 1000000 + start_ts_ms % 1000000 AS arrival_seq
      FROM bins)"""

_VWAP = "coalesce(floor(CAST(notional AS DOUBLE) / nullif(CAST(volume AS DOUBLE), 0) * 1e6 + 0.5) / 1e6, CAST(close AS DOUBLE))"

_BARS = """
SELECT symbol || '-' || lpad(CAST(b AS VARCHAR), 13, '0') AS bar_id, symbol, b AS start_ts_ms, b + 1000 AS end_ts_ms,
       open, high, low, close, volume, notional, {vwap} AS vwap, bin_count, CAST(0 AS BIGINT) AS max_lateness_ms,
       api_send_ts_ms, source_event_ts_ms, b + 1000 + 500 + (b // 10) % 200 AS ingest_ts_ms, 'aggregator' AS source
FROM (SELECT symbol, start_ts_ms - start_ts_ms % 1000 AS b, arg_min(open, start_ts_ms) AS open, max(high) AS high,
             min(low) AS low, arg_max(close, start_ts_ms) AS close, CAST(sum(volume) AS DECIMAL(18,6)) AS volume,
             CAST(sum(notional) AS DECIMAL(18,6)) AS notional, count(*) AS bin_count,
             min(api_send_ts_ms) AS api_send_ts_ms, min(source_event_ts_ms) AS source_event_ts_ms
      FROM {bins} GROUP BY ALL)"""
STEPS["bars"] = _BARS.format(vwap=_VWAP, bins="bins")
STEPS["strict_bars"] = _BARS.format(vwap=_VWAP, bins="strict_bins")

# Every 10 ms bin between a symbol's first and last one, written out row by row.
STEPS["spine"] = """
SELECT symbol, unnest(generate_series(lo, hi, 10)) AS start_ts_ms
FROM (SELECT symbol, min(start_ts_ms) AS lo, max(start_ts_ms) AS hi FROM bins GROUP BY symbol)"""
STEPS["filled"] = """
SELECT symbol, start_ts_ms, coalesce(open, carried) AS open, coalesce(high, carried) AS high,
       coalesce(low, carried) AS low, coalesce(close, carried) AS close,
       coalesce(volume, CAST(0 AS DECIMAL(18,6))) AS volume, coalesce(notional, CAST(0 AS DECIMAL(18,6))) AS notional,
       api_send_ts_ms, source_event_ts_ms
FROM (SELECT s.symbol, s.start_ts_ms, b.open, b.high, b.low, b.close, b.volume, b.notional, b.api_send_ts_ms,
             b.source_event_ts_ms, last_value(b.close IGNORE NULLS) OVER (PARTITION BY s.symbol ORDER BY s.start_ts_ms
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
      FROM spine s LEFT JOIN bins b ON s.symbol = b.symbol AND s.start_ts_ms = b.start_ts_ms)"""
STEPS["filled_bars"] = _BARS.format(vwap=_VWAP, bins="filled")

STEPS["received"] = """
SELECT *, ingest_ts_ms + 30 + (start_ts_ms // 1000) % 90 AS received_ts_ms,
       CASE WHEN (start_ts_ms // 1000) % 13 <> 0 THEN ingest_ts_ms + 5 + (start_ts_ms // 1000) % 20 END AS record_ts_ms
FROM bars"""

STEPS["minutes"] = """
SELECT symbol || '-' || lpad(CAST(b AS VARCHAR), 13, '0') || '-60s' AS bar_id, symbol, b AS start_ts_ms,
       b + 60000 AS end_ts_ms, open, close, high, low, volume, notional, ingest_ts_ms, source_count
FROM (SELECT symbol, start_ts_ms - start_ts_ms % 60000 AS b, arg_min(open, start_ts_ms) AS open,
             arg_max(close, start_ts_ms) AS close, max(high) AS high, min(low) AS low,
             CAST(sum(volume) AS DECIMAL(18,6)) AS volume, CAST(sum(notional) AS DECIMAL(18,6)) AS notional,
             max(ingest_ts_ms) AS ingest_ts_ms, count(*) AS source_count
      FROM bars GROUP BY ALL)"""

STEPS["numbered"] = """
SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY start_ts_ms) AS n FROM minutes"""

_FIVE = """
SELECT symbol || '-' || lpad(CAST(start_ts_ms AS VARCHAR), 13, '0') || '-300s' AS bar_id, symbol, start_ts_ms, end_ts_ms,
       open, close, high, low, volume, notional, ingest_ts_ms, minute_count, source_count
FROM (SELECT symbol, {group} AS g, {start} AS start_ts_ms, {end} AS end_ts_ms, arg_min(open, start_ts_ms) AS open,
             arg_max(close, start_ts_ms) AS close, max(high) AS high, min(low) AS low,
             CAST(sum(volume) AS DECIMAL(18,6)) AS volume, CAST(sum(notional) AS DECIMAL(18,6)) AS notional,
             max(ingest_ts_ms) AS ingest_ts_ms, count(*) AS minute_count, CAST(sum(source_count) AS BIGINT) AS source_count
      FROM numbered GROUP BY symbol, {group} {having})"""
STEPS["counted"] = _FIVE.format(
    group="(n - 1) // 5", start="min(start_ts_ms)", end="max(end_ts_ms)", having="HAVING count(*) = 5"
)
STEPS["aligned"] = _FIVE.format(
    group="(start_ts_ms - start_ts_ms % 300000)",
    start="min(start_ts_ms - start_ts_ms % 300000)",
    end="min(start_ts_ms - start_ts_ms % 300000) + 300000",
    having="",
)

STEPS["facts_60s"] = """
SELECT *, epoch_ms(start_ts_ms) AS start_ts, epoch_ms(end_ts_ms) AS end_ts, epoch_ms(ingest_ts_ms) AS ingest_ts FROM minutes"""
STEPS["facts_300s"] = """
SELECT *, epoch_ms(start_ts_ms) AS start_ts, epoch_ms(end_ts_ms) AS end_ts, epoch_ms(ingest_ts_ms) AS ingest_ts FROM counted"""

STEPS["seed"] = """
SELECT * FROM (VALUES
  ('WDC', 'Western Digital Corporation', 'NASDAQ', 'Technology', 'Computer Hardware'),
  ('AAPL', 'Apple Inc.', 'NASDAQ', 'Technology', 'Consumer Electronics'),
  ('MSFT', 'Microsoft Corporation', 'NASDAQ', 'Technology', 'Software'),
  ('TSLA', 'Tesla Inc.', 'NASDAQ', 'Consumer Discretionary', 'Automobiles')) AS t(symbol, name, exchange, sector, industry)"""

STEPS["expected"] = f"""
SELECT bar_id, symbol, start_ts_ms, end_ts_ms, open, high, low, close, volume, notional, vwap, bin_count FROM bars"""

STEPS["findings"] = """
WITH e AS (UNPIVOT (SELECT bar_id, {casts} FROM expected) ON {names} INTO NAME field VALUE v),
     a AS (UNPIVOT (SELECT bar_id, {casts} FROM strict_bars) ON {names} INTO NAME field VALUE v)
SELECT bar_id, 'missing' AS kind, NULL AS field, CAST(NULL AS DOUBLE) AS expected, CAST(NULL AS DOUBLE) AS actual
FROM expected WHERE bar_id NOT IN (SELECT bar_id FROM strict_bars)
UNION ALL
SELECT bar_id, 'extra', NULL, NULL, NULL FROM strict_bars WHERE bar_id NOT IN (SELECT bar_id FROM expected)
UNION ALL
SELECT e.bar_id, 'mismatch', e.field, e.v, a.v FROM e JOIN a ON e.bar_id = a.bar_id AND e.field = a.field
WHERE abs(e.v - a.v) > 1e-6""".format(
    names=", ".join(["open", "high", "low", "close", "volume", "notional", "vwap", "bin_count"]),
    casts=", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in ["open", "high", "low", "close", "volume", "notional", "vwap", "bin_count"]
    ),
)

STEPS["quotes"] = """
SELECT event_id AS quote_id, sym AS symbol, CASE WHEN k >= 20 THEN value END AS px,
       CASE WHEN k % 3 <> 0 THEN CAST(CAST(value AS DECIMAL(18,6)) - CAST(0.01 AS DECIMAL(18,6)) AS DOUBLE) END AS bid,
       CASE WHEN k % 4 <> 0 THEN CAST(CAST(value AS DECIMAL(18,6)) + CAST(0.01 AS DECIMAL(18,6)) AS DOUBLE) END AS ask,
       CAST(coalesce(nullif(k % 5, 0), nullif(k % 7, 0), nullif(k % 11, 0)) AS DOUBLE) AS sz, event_ms AS event_ts_ms,
       'yfinance.fast_info' AS source, event_ms AS api_send_ts_ms
FROM timed"""

STEPS["asks"] = """
SELECT q.*, m.close AS bar_close, m.volume AS bar_volume, m.start_ts_ms AS bar_ts,
       event_ts_ms - event_ts_ms % 86400000 AS day
FROM (SELECT * FROM quotes WHERE px IS NULL) q
ASOF LEFT JOIN (SELECT symbol AS s, start_ts_ms, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume
                FROM minutes) m
  ON q.symbol = m.s AND q.event_ts_ms >= m.start_ts_ms"""

STEPS["fetches"] = """
SELECT symbol, day, CAST(0 AS BIGINT) AS moment, CAST(0 AS BIGINT) AS next, CAST(30000 AS BIGINT) AS wait, false AS hit
FROM asks GROUP BY symbol, day
UNION ALL
SELECT symbol, day, moment,
       moment + CASE WHEN found THEN 30000 ELSE least(wait * 2, 300000) END AS next,
       CASE WHEN found THEN 30000 ELSE least(wait * 2, 300000) END AS wait, found AS hit
FROM (SELECT f.symbol, f.day, f.wait, min(a.event_ts_ms) AS moment, arg_min(a.bar_close IS NOT NULL, a.event_ts_ms) AS found
      FROM fetches f JOIN asks a ON a.symbol = f.symbol AND a.day = f.day AND a.event_ts_ms >= f.next
      GROUP BY f.symbol, f.day, f.wait)"""

STEPS["looked_up"] = """
SELECT a.* FROM asks a
JOIN (SELECT symbol, day, moment, min(quote_id) AS quote_id FROM (SELECT f.symbol, f.day, f.moment, a.quote_id FROM fetches f
      JOIN asks a ON f.hit AND a.symbol = f.symbol AND a.day = f.day AND a.event_ts_ms = f.moment) GROUP BY ALL) f
  ON a.quote_id = f.quote_id"""

STEPS["gaps"] = """
SELECT *, greatest(received_ts_ms - ingest_ts_ms, 0) AS p, received_ts_ms - api_send_ts_ms AS a,
       received_ts_ms - record_ts_ms AS b,
       row_number() OVER (ORDER BY received_ts_ms DESC, symbol DESC, start_ts_ms DESC) AS r,
       row_number() OVER (PARTITION BY api_send_ts_ms IS NULL ORDER BY received_ts_ms DESC, symbol DESC, start_ts_ms DESC) AS ra,
       row_number() OVER (PARTITION BY record_ts_ms IS NULL ORDER BY received_ts_ms DESC, symbol DESC, start_ts_ms DESC) AS rb,
       row_number() OVER (PARTITION BY symbol ORDER BY received_ts_ms DESC, start_ts_ms DESC) AS rs
FROM received"""

_ORDER = list(STEPS)


def _needs(text: str, found: set[str]) -> None:
    words = set(re.findall(r"[a-z_0-9]+", text))
    for name in _ORDER:
        if name in words and name not in found and re.search(rf"(FROM|JOIN)\s+\(?\s*{name}\b", text):
            found.add(name)
            _needs(STEPS[name], found)


def _sql(text: str) -> str:
    """Prefix a query with the named steps it uses, directly or through others."""
    found: set[str] = set()
    _needs(text, found)
    steps = ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in _ORDER if name in found)
    word = "WITH RECURSIVE" if "fetches" in found else "WITH"
    return f"{word} {steps}\n{text.strip()}" if steps else text.strip()


def _d(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_OHLC = ("open", "high", "low", "close")
_SUMS = ("volume", "notional")
_BIN = (
    "bin_id, symbol, start_ts_ms, end_ts_ms, window_ms, trade_count, max_lateness_ms, api_send_ts_ms, "
    f"source_event_ts_ms, ingest_ts_ms, source, {_d(*_OHLC, *_SUMS)}"
)
_BAR = (
    "bar_id, symbol, start_ts_ms, end_ts_ms, vwap, bin_count, max_lateness_ms, api_send_ts_ms, source_event_ts_ms, "
    f"ingest_ts_ms, source, {_d(*_OHLC, *_SUMS)}"
)
_MINUTE = f"bar_id, symbol, start_ts_ms, end_ts_ms, ingest_ts_ms, source_count, {_d(*_OHLC, *_SUMS)}"
_FIVE_MINUTE = f"bar_id, symbol, start_ts_ms, end_ts_ms, ingest_ts_ms, minute_count, source_count, {_d(*_OHLC, *_SUMS)}"

_TIMES = "epoch_ms(start_ts_ms) AS start_ts, epoch_ms(end_ts_ms) AS end_ts, epoch_ms(ingest_ts_ms) AS ingest_ts"


def _upsert(table: str, columns: str) -> str:
    return f"""
SELECT {columns}
FROM (SELECT * REPLACE (CASE WHEN start_ts_ms >= 1735824000000 THEN ingest_ts_ms + 5000 ELSE ingest_ts_ms END AS ingest_ts_ms)
      FROM {table})"""


_QUEUE: dict[str, str] = {
    "symbol_universe_filter": f"""
SELECT arrival_seq, symbol, {_d('px')}, event_ts_ms FROM ticks WHERE symbol IN ('WDC', 'MSFT')""",
    "ticks_normalized": "SELECT * FROM normalized",
    "valid_ticks": "SELECT * FROM normalized WHERE px IS NOT NULL AND event_ts_ms IS NOT NULL",
    "market_open_utc": f"""
SELECT arrival_seq, symbol, {_d('px')}, event_ts_ms FROM ticks WHERE event_ts_ms % 86400000 >= 48615000""",
    "market_open_local": f"""
SELECT arrival_seq, symbol, {_d('px')}, event_ts_ms FROM ticks
WHERE (event_ts_ms - 5 * 3600000) % 86400000 >= (8 * 60 + 45) * 60000""",
    "rebase_to_anchor": """
SELECT arrival_seq, symbol, event_ts_ms + (1767225600000 - (SELECT arg_min(event_ts_ms, arrival_seq) FROM ticks)) AS event_ts_ms,
       event_ts_ms AS source_event_ts_ms
FROM ticks""",
    "replay_schedule": """
SELECT arrival_seq, symbol, pause_us,
       CAST(sum(pause_us) OVER (PARTITION BY symbol ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS emit_offset_us
FROM (SELECT arrival_seq, symbol, least(CAST(round_even(greatest(coalesce(event_ts_ms - lag(event_ts_ms) OVER
             (PARTITION BY symbol ORDER BY arrival_seq), 0), 0) * 1000.0 / 2.0, 0) AS BIGINT), 50000) AS pause_us
      FROM ticks)""",
    "first_n_rows": f"""
SELECT arrival_seq, symbol, {_d('px', 'sz')}, event_ts_ms FROM ticks ORDER BY arrival_seq LIMIT 1000""",
    "first_full_week": """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value
FROM events
WHERE CAST(ts AS DATE) BETWEEN
  (SELECT min(m) FROM (SELECT date_trunc('week', d) AS m FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
                       WHERE isodow(d) <= 5 GROUP BY 1 HAVING count(*) = 5)) AND
  (SELECT min(m) FROM (SELECT date_trunc('week', d) AS m FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
                       WHERE isodow(d) <= 5 GROUP BY 1 HAVING count(*) = 5)) + INTERVAL 4 DAY""",
    "tick_lateness": "SELECT arrival_seq, symbol, event_ts_ms, lateness_ms FROM classified",
    "accepted_ticks": f"""
SELECT arrival_seq, symbol, {_d('px', 'sz')}, event_ts_ms, lateness_ms FROM classified WHERE lateness_ms <= 500""",
    "late_ticks_dlt": """
SELECT 'late_tick' AS reason, lateness_ms, symbol, event_ts_ms, arrival_seq AS tick_arrival_seq,
       CAST(px AS DOUBLE) AS tick_px, CAST(sz AS DOUBLE) AS tick_sz
FROM classified WHERE lateness_ms > 500""",
    "late_counts": """
SELECT symbol, reason, count(*) AS late_rows, max(lateness_ms) AS worst_lateness_ms
FROM (SELECT symbol, 'late_tick' AS reason, lateness_ms FROM classified WHERE lateness_ms > 500
      UNION ALL SELECT symbol, 'late_bin', lateness_ms FROM arriving WHERE lateness_ms > 500)
GROUP BY ALL""",
    "bins_10ms": f"SELECT {_BIN} FROM bins",
    "bins_deduped": f"SELECT DISTINCT {_BIN} FROM (SELECT * FROM bins UNION ALL SELECT * FROM bins)",
    "bins_defaulted": """
SELECT bin_id, CASE WHEN (start_ts_ms // 10) % 7 <> 0 THEN symbol ELSE 'UNKNOWN' END AS symbol, start_ts_ms, end_ts_ms,
       CAST(open AS DOUBLE) AS open, CAST(CASE WHEN trade_count = 1 THEN open ELSE high END AS DOUBLE) AS high,
       CAST(CASE WHEN trade_count = 1 THEN open ELSE low END AS DOUBLE) AS low,
       CAST(CASE WHEN trade_count = 1 THEN open ELSE close END AS DOUBLE) AS close,
       CAST(CASE WHEN (start_ts_ms // 10) % 3 <> 0 THEN volume ELSE 0 END AS DOUBLE) AS volume,
       CAST(CASE WHEN (start_ts_ms // 10) % 3 <> 0 THEN notional ELSE 0 END AS DOUBLE) AS notional
FROM bins WHERE (start_ts_ms // 10) % 11 <> 0""",
    "bin_messages": f"""
SELECT bin_id AS key, symbol, start_ts_ms, {_d('close', 'volume')}, trade_count, api_send_ts_ms, source FROM bins""",
    "bin_lateness": "SELECT bin_id, symbol, end_ts_ms, lateness_ms FROM arriving",
    "late_bins_dlt": """
SELECT 'late_bin' AS reason, lateness_ms, symbol, start_ts_ms, end_ts_ms, bin_id AS payload_bin_id,
       CAST(volume AS DOUBLE) AS payload_volume
FROM arriving WHERE lateness_ms > 500""",
    "gapfilled_bins": """
SELECT symbol, start_ts_ms - start_ts_ms % 60000 AS window_start_ms, count(*) AS bins,
       CAST(sum(volume) AS DOUBLE) AS volume, CAST(min(close) AS DOUBLE) AS low_close, CAST(max(close) AS DOUBLE) AS high_close
FROM filled GROUP BY ALL""",
    "bin_contract_violations": """
SELECT bin_id, symbol, start_ts_ms, rule
FROM (SELECT bin_id, symbol, start_ts_ms, unnest([
         CASE WHEN api_send_ts_ms IS NULL THEN 'api_send_ts_ms:required' END,
         CASE WHEN NOT regexp_full_match(bin_id, '[A-Z0-9_.-]+-[0-9]{13}') THEN 'bin_id:pattern' END,
         CASE WHEN length(symbol) < 1 THEN 'symbol:min_length' END,
         CASE WHEN volume < 0 THEN 'volume:minimum' END,
         CASE WHEN trade_count < 1 THEN 'trade_count:minimum' END,
         CASE WHEN window_ms <> 10 THEN 'window_ms:const' END,
         CASE WHEN source <> 'replay' THEN 'source:enum' END]) AS rule
      FROM (SELECT CASE WHEN s % 17 = 0 THEN lower(bin_id) ELSE bin_id END AS bin_id,
                   CASE WHEN s % 19 = 0 THEN 20 ELSE window_ms END AS window_ms,
                   CASE WHEN s % 23 = 0 THEN -volume - 1 ELSE volume END AS volume,
                   CASE WHEN s % 29 = 0 THEN 0 ELSE trade_count END AS trade_count,
                   CASE WHEN s % 31 = 0 THEN 'other' ELSE source END AS source,
                   CASE WHEN s % 37 = 0 THEN '' ELSE symbol END AS symbol, start_ts_ms, api_send_ts_ms
            FROM (SELECT *, start_ts_ms // 10 AS s FROM bins)))
WHERE rule IS NOT NULL""",
    "bars_1s": f"SELECT {_BAR} FROM bars",
    "bars_1s_gapfilled": f"SELECT {_BAR} FROM filled_bars",
    "bar_messages": "SELECT bar_id AS key, symbol, start_ts_ms, vwap, bin_count, source FROM bars",
    "bars_last_wins": f"""
SELECT bar_id, symbol, start_ts_ms, {_d('close', 'volume')}, vwap, ingest_ts_ms + 1000 AS ingest_ts_ms,
       start_ts_ms * 2 + 1 AS arrival_seq
FROM bars""",
    "expected_bars_1s": """
SELECT symbol || '-' || lpad(CAST(b AS VARCHAR), 13, '0') AS bar_id, symbol, b AS start_ts_ms, b + 1000 AS end_ts_ms,
       CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
       CAST(volume AS DOUBLE) AS volume, CAST(notional AS DOUBLE) AS notional,
       coalesce(floor(CAST(notional AS DOUBLE) / nullif(CAST(volume AS DOUBLE), 0) * 1e6 + 0.5) / 1e6, CAST(close AS DOUBLE)) AS vwap,
       bin_count, max_lateness_ms
FROM (SELECT symbol, start_ts_ms - start_ts_ms % 1000 AS b, arg_min(open, start_ts_ms) AS open,
             max(CASE WHEN (start_ts_ms // 10) % 5 <> 0 THEN high ELSE open END) AS high, min(low) AS low,
             arg_max(close, start_ts_ms) AS close, CAST(sum(volume) AS DECIMAL(18,6)) AS volume,
             CAST(sum(CASE WHEN (start_ts_ms // 10) % 3 <> 0 THEN notional ELSE CAST(close * volume AS DECIMAL(18,6)) END)
                  AS DECIMAL(18,6)) AS notional,
             count(*) AS bin_count, max(max_lateness_ms) AS max_lateness_ms
      FROM bins GROUP BY ALL)""",
    "fact_1s_typed": f"""
SELECT bar_id, symbol, epoch_ms(start_ts_ms) AS start_ts, epoch_ms(end_ts_ms) AS end_ts, {_d(*_OHLC, *_SUMS)},
       CASE WHEN (start_ts_ms // 1000) % 5 <> 0 THEN vwap ELSE CAST(close AS DOUBLE) END AS vwap,
       CASE WHEN (start_ts_ms // 1000) % 7 <> 0 THEN bin_count ELSE 0 END AS bin_count, max_lateness_ms,
       epoch_ms(CASE WHEN (start_ts_ms // 1000) % 13 <> 0 THEN ingest_ts_ms ELSE 1735827130000 END) AS ingest_ts
FROM bars WHERE (start_ts_ms // 1000) % 11 <> 0""",
    "fact_1s_rejects": """
SELECT bar_id, symbol, start_ts_ms, 'volume' AS misfits FROM bars WHERE (start_ts_ms // 1000) % 7 = 0""",
    "bars_defaulted": """
SELECT bar_id, CASE WHEN s % 7 <> 0 THEN symbol ELSE 'UNKNOWN' END AS symbol, start_ts_ms, CAST(o AS DOUBLE) AS open,
       CAST(CASE WHEN s % 3 <> 0 THEN high ELSE o END AS DOUBLE) AS high,
       CAST(CASE WHEN s % 3 <> 0 THEN low ELSE o END AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
       CAST(volume AS DOUBLE) AS volume,
       CAST(CASE WHEN s % 2 <> 0 THEN notional ELSE CAST(close * volume AS DECIMAL(18,6)) END AS DOUBLE) AS notional,
       CASE WHEN s % 13 <> 0 THEN ingest_ts_ms ELSE 1735827130000 END AS ingest_ts_ms
FROM (SELECT *, start_ts_ms // 1000 AS s, CASE WHEN (start_ts_ms // 1000) % 5 <> 0 THEN open ELSE close END AS o FROM bars)
WHERE s % 11 <> 0""",
    "bar_contract_violations": """
SELECT bar_id, symbol, start_ts_ms, rule
FROM (SELECT bar_id, symbol, start_ts_ms, unnest([
         CASE WHEN api_send_ts_ms IS NULL THEN 'api_send_ts_ms:required' END,
         CASE WHEN vwap IS NULL THEN 'vwap:required' END,
         CASE WHEN NOT regexp_full_match(bar_id, '[A-Z0-9_.-]+-[0-9]{13}') THEN 'bar_id:pattern' END,
         CASE WHEN notional < 0 THEN 'notional:minimum' END,
         CASE WHEN source <> 'aggregator' THEN 'source:enum' END]) AS rule
      FROM (SELECT CASE WHEN s % 17 = 0 THEN lower(bar_id) ELSE bar_id END AS bar_id, symbol, start_ts_ms, api_send_ts_ms,
                   CASE WHEN s % 19 = 0 THEN -notional - 1 ELSE notional END AS notional,
                   CASE WHEN s % 23 <> 0 THEN vwap END AS vwap,
                   CASE WHEN s % 29 = 0 THEN 'replay' ELSE source END AS source
            FROM (SELECT *, start_ts_ms // 1000 AS s FROM bars)))
WHERE rule IS NOT NULL""",
    "bars_60s": f"SELECT {_MINUTE} FROM minutes",
    "minute_index": "SELECT bar_id, symbol, start_ts_ms, (n - 1) % 5 AS minute_index FROM numbered",
    "settled_minutes": f"SELECT {_MINUTE} FROM minutes WHERE end_ts_ms <= 1735825228000",
    "bars_300s_count": f"SELECT {_FIVE_MINUTE} FROM counted",
    "bars_300s_aligned": f"SELECT {_FIVE_MINUTE} FROM aligned",
    "upsert_1s": _upsert("bars", f"bar_id, symbol, {_TIMES}, {_d(*_OHLC, *_SUMS)}, vwap, bin_count, max_lateness_ms"),
    "upsert_60s": _upsert(
        "numbered", f"bar_id, symbol, {_TIMES}, {_d(*_OHLC, *_SUMS)}, source_count, (n - 1) % 5 AS minute_index"
    ),
    "upsert_300s": _upsert("counted", f"bar_id, symbol, {_TIMES}, {_d(*_OHLC, *_SUMS)}, minute_count, source_count"),
    "dim_symbol": """
SELECT t.symbol, t.ticks, s.name, s.exchange, s.sector, s.industry, CASE WHEN s.symbol IS NOT NULL THEN true END AS is_active
FROM (SELECT symbol, count(*) AS ticks FROM ticks GROUP BY symbol) t LEFT JOIN seed s ON t.symbol = s.symbol""",
    "dim_calendar": """
SELECT m AS calendar_minute, CAST(CAST(m AS DATE) AS VARCHAR) AS trade_date, isodow(m) AS weekday, hour(m) AS hour,
       minute(m) AS minute,
       isodow(m) BETWEEN 1 AND 5 AND hour(m) BETWEEN 13 AND 19 AND NOT (hour(m) = 13 AND minute(m) < 30) AS is_trading_session,
       CASE WHEN isodow(m) BETWEEN 1 AND 5 AND hour(m) BETWEEN 13 AND 19 AND NOT (hour(m) = 13 AND minute(m) < 30)
            THEN 'REG' ELSE 'OFF' END AS session_name
FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + INTERVAL 1439 MINUTE,
                                    INTERVAL 1 MINUTE)) AS m
      FROM events)""",
    "bars_with_session": """
SELECT bar_id, symbol, start_ts, CAST(volume AS DOUBLE) AS volume,
       isodow(start_ts) <= 5 AND hour(start_ts) * 60 + minute(start_ts) BETWEEN 810 AND 1199 AS is_trading_session,
       CASE WHEN isodow(start_ts) <= 5 AND hour(start_ts) * 60 + minute(start_ts) BETWEEN 810 AND 1199
            THEN 'REG' ELSE 'OFF' END AS session_name
FROM facts_60s""",
    "vw_price_60s": f"""
SELECT f.symbol, start_ts, end_ts, {_d(*_OHLC, *_SUMS)}, ingest_ts, s.name AS company_name, s.exchange, s.sector, s.industry
FROM facts_60s f LEFT JOIN seed s ON f.symbol = s.symbol""",
    "vw_pipeline_5m": f"""
SELECT symbol, start_ts, end_ts, minute_count, source_count, {_d(*_SUMS)}, ingest_ts FROM facts_300s""",
    "vw_pipeline_minute_metrics": """
SELECT symbol, date_trunc('minute', end_ts) AS minute_ts, count(*) AS bars_in_batch, max(ingest_ts) AS last_ingest_ts,
       max(end_ts) AS last_bar_end_ts, max(ingest_ts_ms) - max(end_ts_ms) AS latency_ms,
       CAST(sum(volume) AS DOUBLE) AS volume_1m, CAST(sum(notional) AS DOUBLE) AS notional_1m
FROM facts_60s GROUP BY symbol, date_trunc('minute', end_ts)""",
    "vw_session_vwap": """
SELECT symbol, CAST(date_trunc('day', start_ts) AS TIMESTAMP) AS trade_date,
       CAST(sum(notional) AS DOUBLE) / nullif(CAST(sum(volume) AS DOUBLE), 0) AS session_vwap,
       CAST(sum(volume) AS DOUBLE) AS session_volume
FROM facts_60s GROUP BY symbol, date_trunc('day', start_ts)""",
    "vw_top_movers_15m": """
SELECT symbol, max(end_ts) AS last_bar_end,
       CAST(max(close) - min(open) AS DOUBLE) / nullif(CAST(min(open) AS DOUBLE), 0) AS pct_change,
       CAST(sum(volume) AS DOUBLE) AS total_volume
FROM facts_300s WHERE end_ts >= TIMESTAMP '2025-01-02 14:12:00' - INTERVAL 15 MINUTE
GROUP BY symbol ORDER BY pct_change DESC""",
    "latency_stats": """
SELECT count(*) AS bars, max(CASE WHEN r = least(n - 1, CAST(floor(n * 0.95) AS BIGINT)) THEN v END) AS p95_ms, max(v) AS max_ms
FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r, count(*) OVER () AS n
      FROM (SELECT greatest(ingest_ts_ms - end_ts_ms, 0) AS v FROM bars))""",
    "reconcile_bars": "SELECT bar_id, kind, field, expected, actual FROM findings",
    "reconcile_examples": """
SELECT bar_id, kind, field, expected, actual
FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY bar_id, field) AS r FROM findings) WHERE r <= 5""",
    "validation_summary": """
SELECT (SELECT count(*) FROM expected) AS expected_bars, (SELECT count(*) FROM strict_bars) AS actual_bars,
       count(*) FILTER (kind = 'missing') AS missing_bars, count(*) FILTER (kind = 'extra') AS extra_bars,
       count(*) FILTER (kind = 'mismatch') AS field_diffs, count(*) = 0 AS passed
FROM findings""",
    "serving_bars": f"""
SELECT bar_id, symbol, start_ts_ms, end_ts_ms, {_d(*_OHLC, *_SUMS)},
       CASE WHEN (start_ts_ms // 1000) % 7 <> 0 THEN vwap ELSE 0.0::DOUBLE END AS vwap, bin_count, max_lateness_ms,
       CASE WHEN (start_ts_ms // 1000) % 11 <> 0 THEN ingest_ts_ms ELSE received_ts_ms END AS ingest_ts_ms,
       api_send_ts_ms, source_event_ts_ms, source, received_ts_ms, record_ts_ms
FROM received""",
    "latest_n_bars": f"""
SELECT {_BAR} FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY start_ts_ms DESC) AS r FROM bars) WHERE r <= 600""",
    "latest_bar_detail": f"""
SELECT bar_id, symbol, start_ts_ms, end_ts_ms, {_d(*_OHLC, 'volume')}, bin_count, max_lateness_ms, api_send_ts_ms,
       source_event_ts_ms, ingest_ts_ms, ingest_ts_ms + 30 AS received_ts_ms, epoch_ms(start_ts_ms) AS start_ts,
       epoch_ms(end_ts_ms) AS end_ts, greatest(ingest_ts_ms + 30 - api_send_ts_ms, CASE WHEN api_send_ts_ms IS NOT NULL THEN 0 END)
       AS api_gap_ms, CAST(30 AS BIGINT) AS producer_gap_ms
FROM bars b WHERE start_ts_ms = (SELECT max(start_ts_ms) FROM bars x WHERE x.symbol = b.symbol)""",
    "bars_last_n_seconds": f"""
SELECT bar_id, symbol, start_ts_ms, {_d('close', 'volume')}
FROM (SELECT *, max(start_ts_ms) OVER (PARTITION BY symbol) AS m FROM bars) WHERE start_ts_ms >= m - 300000
ORDER BY symbol, start_ts_ms""",
    "distinct_symbols": "SELECT DISTINCT symbol FROM bars ORDER BY symbol",
    "avg_real_gap": """
SELECT symbol, coalesce(avg(gap), 0.0) AS avg_real_gap_ms
FROM (SELECT symbol, CAST(start_ts_ms - lag(start_ts_ms) OVER (PARTITION BY symbol ORDER BY start_ts_ms) AS DOUBLE) AS gap
      FROM (SELECT *, max(start_ts_ms) OVER (PARTITION BY symbol) AS m FROM bars)
      WHERE start_ts_ms >= m - 300000 AND volume > 0)
GROUP BY symbol""",
    "gap_metrics": """
SELECT CAST(max(a) FILTER (r = 1) AS DOUBLE) AS last_api_gap_ms,
       avg(greatest(a, 0)) FILTER (ra <= 120 AND a IS NOT NULL) AS avg_api_gap_ms,
       CAST(max(p) FILTER (r = 1) AS DOUBLE) AS last_producer_gap_ms, avg(p) FILTER (r <= 120) AS avg_producer_gap_ms,
       CAST(coalesce(max(b) FILTER (r = 1), 0) AS DOUBLE) AS last_broker_gap_ms,
       avg(greatest(b, 0)) FILTER (rb <= 120 AND b IS NOT NULL) AS avg_broker_gap_ms,
       CAST(greatest(1735827130000 - max(end_ts_ms), 0) AS DOUBLE) AS backlog_ms,
       CAST(count(*) FILTER (rs <= 600) AS DOUBLE) AS bars_cached,
       CAST(max(received_ts_ms) FILTER (r = 1) AS DOUBLE) AS last_update_ts_ms
FROM gaps""",
    "live_tick_rows": """
SELECT arrival_seq, symbol, printf('%.4f', CAST(px AS DOUBLE)) AS px, printf('%.4f', CAST(bid AS DOUBLE)) AS bid,
       printf('%.4f', CAST(ask AS DOUBLE)) AS ask, printf('%.2f', CAST(sz AS DOUBLE)) AS size,
       CAST(event_ts_ms AS DOUBLE) AS time_ms, source
FROM ticks ORDER BY arrival_seq DESC LIMIT 120""",
    "live_tick_series": f"""
SELECT arrival_seq, CAST(event_ts_ms AS DOUBLE) AS time_ms, {_d('px', 'bid', 'ask')} FROM ticks ORDER BY arrival_seq DESC LIMIT 500""",
    "live_tick_stats": """
SELECT count(*) AS ticks, arg_max(symbol, arrival_seq) AS last_symbol,
       printf('%.4f', CAST(arg_max(px, arrival_seq) AS DOUBLE)) AS last_price,
       CAST(arg_max(event_ts_ms, arrival_seq) AS DOUBLE) AS last_time_ms
FROM ticks""",
    "duration_text": """
SELECT bar_id, CASE WHEN a IS NULL THEN 'n/a' WHEN a >= 1000 THEN printf('%.2f s', a / 1000.0::DOUBLE) ELSE printf('%.0f ms', CAST(a AS DOUBLE)) END AS api_gap,
       CASE WHEN p >= 1000 THEN printf('%.2f s', p / 1000.0::DOUBLE) ELSE printf('%.0f ms', CAST(p AS DOUBLE)) END AS producer_gap
FROM (SELECT bar_id, received_ts_ms - api_send_ts_ms AS a, received_ts_ms - ingest_ts_ms AS p FROM received)""",
    "quote_normalize": "SELECT * FROM quotes",
    "quote_backfill_asof": """
SELECT q.quote_id, q.symbol,
       CASE WHEN q.px IS NULL THEN l.bar_close ELSE q.px END AS px,
       CASE WHEN q.px IS NULL THEN coalesce(q.bid, CASE WHEN l.bar_close IS NOT NULL THEN l.bid END, l.bar_close) ELSE q.bid END AS bid,
       CASE WHEN q.px IS NULL THEN coalesce(q.ask, CASE WHEN l.bar_close IS NOT NULL THEN l.ask END, l.bar_close) ELSE q.ask END AS ask,
       CASE WHEN q.px IS NULL THEN coalesce(q.sz, CASE WHEN l.bar_close IS NOT NULL THEN l.sz END, l.bar_volume) ELSE q.sz END AS sz,
       CASE WHEN q.quote_id = l.quote_id AND l.bar_close IS NOT NULL THEN l.bar_ts ELSE q.event_ts_ms END AS event_ts_ms,
       CASE WHEN q.quote_id = l.quote_id AND l.bar_close IS NOT NULL THEN 'yfinance.history' ELSE q.source END AS source,
       q.api_send_ts_ms
FROM (SELECT *, CASE WHEN px IS NULL THEN symbol END AS needy, event_ts_ms - event_ts_ms % 86400000 AS day FROM quotes) q
ASOF LEFT JOIN looked_up l ON q.needy = l.symbol AND q.day = l.day AND q.event_ts_ms >= l.event_ts_ms""",
    "quotes_append": """
SELECT sym AS symbol, value AS price, make_timestamp(event_ms * 1000) AS ts FROM timed WHERE k >= 20""",
    "raw_json_fields": """
SELECT event_id AS id, event_type AS type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent
FROM events""",
}

_FRAME = "OVER (PARTITION BY symbol ORDER BY start_ts ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


def _bands(extra: str) -> str:
    return f"""
SELECT symbol, start_ts, CAST(close AS DOUBLE) AS close,
       floor(CAST(s1 AS DOUBLE) / CAST(n AS DOUBLE) / 1e6 * 1e6 + 0.5) / 1e6 AS ma_60,
       floor(sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE) / nullif(CAST(n * (n - 1) AS DOUBLE), 0)) / 1e6 * 1e6 + 0.5) / 1e6 AS std_60
       {extra}
FROM (SELECT symbol, start_ts, close, CAST(count(*) {_FRAME} AS HUGEINT) AS n, sum(c) {_FRAME} AS s1, sum(c * c) {_FRAME} AS s2,
             sum(notional) {_FRAME} AS sn, sum(volume) {_FRAME} AS sv
      FROM (SELECT *, CAST(close * 1000000 AS HUGEINT) AS c FROM facts_60s))"""


_QUEUE["vw_volatility_bands"] = _bands("")
_QUEUE["vw_price_60s_features"] = _bands(
    ", floor(CAST(sn AS DOUBLE) / nullif(CAST(sv AS DOUBLE), 0) * 1e6 + 0.5) / 1e6 AS rolling_vwap"
)


def oracle() -> dict[str, str]:
    return {name: _sql(text) for name, text in _QUEUE.items()}
