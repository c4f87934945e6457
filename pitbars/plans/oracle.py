"""The registered queries as plain SQL, written independently of the operators."""

from __future__ import annotations

# Expected advice of a failed run, written out here on its own.
_ADVICE = """"diagnosis":["Compare the first line of the file with the column names of the contract.","Open the file with the vendor's own reader; a changed delimiter or encoding shows there.","Ask the vendor whether the layout changed on purpose."],"mitigation":["Adapt the column mapping of the contract if the new layout stays.","Ask for the file again if it was cut off.","Start the load once more; nothing of this run was committed."],"escalation":["Hand over the file, the contract and the run_id to whoever owns the feed.","Say which columns are absent and since which delivery."]"""


def _ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column.split('.')[-1]}"


def _dec(column: str, kind: str = "DECIMAL(18,6)", name: str | None = None) -> str:
    return f"CAST(CAST({column} AS {kind}) AS VARCHAR) AS {name or column.split('.')[-1]}"


_KEYS = "source_name, symbol, price_ts"
_PRICES = ("open_price", "high_price", "low_price", "close_price")
_PAYLOAD = (*_PRICES, "volume", "adjusted_close", "currency")
_ORDER = "o1, o2, o3, o4, o5, o6, o7, o8"
_LATEST = ", ".join(f"o{n} DESC" for n in range(1, 9))
_SHOW_BAR = ", ".join(
    ["source_name", "symbol", _ts("price_ts"), *[_dec(c) for c in _PRICES], "volume", _dec("adjusted_close"), "currency"]
)
_SHOW_ASOF = f"{_SHOW_BAR}, {_ts('ingested_at')}, {_ts('valid_from')}, {_ts('valid_to')}"
_SHOW_VERSION = f"{_SHOW_ASOF}, {_ts('created_at')}, {_ts('updated_at')}"


def _feed(name: str, close: str, day: str) -> str:
    money = "CAST({} AS DECIMAL(18,2))".format
    price, size = money("l_extendedprice"), money("l_quantity")
    plain = f"({price} + {money('round(l_discount * 100) - 5')})"
    return f"""
{name} AS (
  SELECT l_orderkey AS o1, l_linenumber AS o2, l_partkey AS o3, l_quantity AS o4, l_extendedprice AS o5,
    l_discount AS o6, l_tax AS o7, l_returnflag AS o8,
    CASE WHEN l_orderkey % 97 = 0 THEN '  '
         WHEN l_linenumber = 1 THEN ' s' || CAST(l_suppkey AS VARCHAR)
         ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS symbol,
    CASE WHEN l_orderkey % 89 = 0 THEN 'bad-date' ELSE CAST({day} AS VARCHAR) || ' 14:30:00' END AS "timestamp",
    CASE WHEN l_orderkey % 67 = 0 THEN 'x' || CAST({price} AS VARCHAR) ELSE CAST({price} AS VARCHAR) END AS "open",
    CAST({price} + {size} AS VARCHAR) AS high,
    CASE WHEN l_orderkey % 61 = 0 THEN '-0.50' ELSE CAST({price} - {size} AS VARCHAR) END AS low,
    CAST({close.format(plain=plain)} AS VARCHAR) AS "close",
    CASE WHEN l_orderkey % 83 = 0 THEN '-100' WHEN l_orderkey % 79 = 0 THEN '12.5'
         ELSE CAST(CAST(l_quantity AS BIGINT) * 100 AS VARCHAR) END AS volume,
    CASE WHEN l_orderkey % 73 = 0 THEN 'n/a' ELSE CAST({plain} AS VARCHAR) END AS adjusted_close,
    CASE WHEN l_orderkey % 71 = 0 THEN 'US' WHEN l_returnflag = 'A' THEN 'USD'
         WHEN l_returnflag = 'N' THEN 'usd' ELSE 'EUR' END AS currency
  FROM lineitem)"""


FEED = _feed("feed", "{plain}", "CAST(l_shipdate AS DATE)")
FEED2 = _feed(
    "feed2",
    "CASE WHEN l_tax >= 0.05 THEN {plain} + CAST(0.25 AS DECIMAL(18,2)) ELSE {plain} END",
    "CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) + 1 ELSE CAST(l_shipdate AS DATE) END",
)


def _tagged(name: str, feed: str, checked: bool = True) -> str:
    needed = ("symbol", "timestamp", "open", "high", "low", "close", "volume", "currency")
    required = [f"CASE WHEN \"{c}\" IS NULL OR trim(\"{c}\") = '' THEN 'missing_required:{c}' END" for c in needed]
    numbers = [f"CASE WHEN {c} IS NULL THEN 'invalid_number:{c}' END" for c in _PRICES]
    positive = [f"CASE WHEN {c} <= 0 THEN 'non_positive_price:{c}' END" for c in (*_PRICES, "adjusted_close")]
    rules = positive + [
        "CASE WHEN volume < 0 THEN 'negative_volume' END",
        """CASE WHEN open_price IS NOT NULL AND high_price IS NOT NULL AND low_price IS NOT NULL
             AND close_price IS NOT NULL AND (high_price < greatest(open_price, low_price, close_price)
             OR low_price > least(open_price, high_price, close_price)) THEN 'invalid_high_low_envelope' END""",
    ]
    codes = required + [
        "CASE WHEN symbol_ = '' THEN 'invalid_symbol' END",
        "CASE WHEN NOT regexp_full_match(currency_, '[A-Z]{3}') THEN 'invalid_currency' END",
        "CASE WHEN price_ts IS NULL THEN 'invalid_timestamp' END",
        "CASE WHEN price_ts > TIMESTAMP '2030-01-01 00:05:00' THEN 'future_timestamp' END",
        *numbers,
        "CASE WHEN volume_ IS NULL THEN 'invalid_integer:volume' END",
        *([r.replace("volume <", "volume_ <") for r in rules] if checked else []),
    ]
    number = "try_cast(trim(\"{0}\") AS DECIMAL(38,18))".format
    return f"""
{name}_parsed AS (
  SELECT * EXCLUDE (adjusted_close), 'vendor_a' AS source_name, upper(trim(symbol)) AS symbol_,
    upper(trim(currency)) AS currency_, try_cast(trim("timestamp") AS TIMESTAMP) AS price_ts,
    {number("open")} AS open_price, {number("high")} AS high_price, {number("low")} AS low_price,
    {number("close")} AS close_price, {number("adjusted_close")} AS adjusted_close, adjusted_close AS adjusted_text,
    CASE WHEN {number("volume")} = floor({number("volume")}) THEN CAST({number("volume")} AS BIGINT) END AS volume_
  FROM {feed}),
{name} AS (SELECT *, concat_ws('; ', {", ".join(codes)}) AS rejection_reason FROM {name}_parsed)"""


def _staged(name: str, tagged: str) -> str:
    return f"""
{name}_bars AS (
  SELECT source_name, symbol_ AS symbol, price_ts, open_price, high_price, low_price, close_price, volume_ AS volume,
    adjusted_close, currency_ AS currency
  FROM {tagged} WHERE rejection_reason = ''
  QUALIFY row_number() OVER (PARTITION BY source_name, symbol_, price_ts ORDER BY {_LATEST}) = 1),
{name} AS (
  SELECT source_name, symbol, date_trunc('second', price_ts) AS price_ts,
    {", ".join(f"CAST({c} AS DECIMAL(18,6)) AS {c}" for c in _PRICES)}, volume,
    CAST(adjusted_close AS DECIMAL(18,6)) AS adjusted_close, currency
  FROM {name}_bars)"""


def _opened(alias: str, moment: str) -> str:
    columns = ", ".join(f"{alias}.{c}" for c in ("source_name", "symbol", "price_ts", *_PAYLOAD))
    at = f"TIMESTAMP '{moment}'"
    return f"{columns}, {at} AS ingested_at, {at} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, {at} AS created_at, {at} AS updated_at"


def _differs(left: str, right: str) -> str:
    return "(" + " OR ".join(f"{left}.{c} IS DISTINCT FROM {right}.{c}" for c in _PAYLOAD) + ")"


def _merged(name: str, before: str, staged: str, moment: str) -> str:
    at = f"TIMESTAMP '{moment}'"
    return f"""
{name} AS (
  SELECT * FROM {before} WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT a.* FROM {before} a LEFT JOIN {staged} s USING ({_KEYS})
  WHERE a.valid_to IS NULL AND (s.currency IS NULL OR NOT {_differs("a", "s")})
  UNION ALL
  SELECT a.* REPLACE ({at} AS valid_to, {at} AS updated_at) FROM {before} a JOIN {staged} s USING ({_KEYS})
  WHERE a.valid_to IS NULL AND {_differs("a", "s")}
  UNION ALL
  SELECT {_opened("s", moment)} FROM {staged} s
  WHERE NOT EXISTS (SELECT 1 FROM {before} a WHERE a.valid_to IS NULL AND a.source_name = s.source_name
    AND a.symbol = s.symbol AND a.price_ts = s.price_ts AND NOT {_differs("a", "s")}))"""


TAGGED = f"WITH {FEED},{_tagged('tagged', 'feed')}"
STAGED = f"{TAGGED},{_staged('staged', 'tagged')}"
LOADED = f"{STAGED},{FEED2},{_tagged('tagged2', 'feed2')},{_staged('staged2', 'tagged2')},\nloaded AS (SELECT {_opened('s', '2024-01-01 00:00:00')} FROM staged s)"
MERGED = f"{LOADED},{_merged('merged', 'loaded', 'staged2', '2024-02-01 00:00:00')}"
MERGED3 = f"{MERGED},{_merged('merged3', 'merged', 'staged', '2024-02-05 00:00:00')}"

_LINE = (
    "concat_ws('|', source_name, symbol, strftime(price_ts, '%Y-%m-%dT%H:%M:%S.%f'), "
    + ", ".join(f"CAST({c} AS VARCHAR)" for c in _PRICES)
    + ", CAST(volume AS VARCHAR), coalesce(CAST(adjusted_close AS VARCHAR), ''), currency)"
)


def _sums(rows: str) -> str:
    """Ordered MD5 of each hour's lines, of each day's hours, of each symbol's days."""
    return f"""SELECT symbol, CAST(sum(n) AS BIGINT) AS n, md5(string_agg(d, '||' ORDER BY day)) AS c FROM (
  SELECT symbol, date_trunc('day', hour) AS day, sum(n) AS n, md5(string_agg(h, '||' ORDER BY hour)) AS d FROM (
    SELECT symbol, date_trunc('hour', price_ts) AS hour, count(*) AS n, md5(string_agg({_LINE}, '||' ORDER BY {_KEYS})) AS h
    FROM {rows} GROUP BY ALL) GROUP BY ALL) GROUP BY symbol"""


def _compared(versions: str) -> str:
    return f""",
landed AS (SELECT v.* FROM {versions} v SEMI JOIN staged2 s USING ({_KEYS}) WHERE v.valid_to IS NULL),
src AS ({_sums("staged2")}), dst AS ({_sums("landed")}),
compared AS (
  SELECT coalesce(src.symbol, dst.symbol) AS symbol, coalesce(src.n, 0) AS source_rows, coalesce(dst.n, 0) AS landed_rows,
    src.c AS source_checksum, dst.c AS landed_checksum,
    coalesce(src.n, 0) = coalesce(dst.n, 0) AND src.c IS NOT DISTINCT FROM dst.c AS matched
  FROM src FULL JOIN dst ON src.symbol = dst.symbol)"""


_VERDICT = """
SELECT CASE WHEN sum(source_rows) = sum(landed_rows) AND bool_and(matched) THEN 'passed' ELSE 'failed' END AS status,
  CAST(sum(source_rows) AS BIGINT) AS source_total_rows, CAST(sum(landed_rows) AS BIGINT) AS landed_total_rows,
  count(*) AS symbols, count(*) FILTER (WHERE NOT matched) AS mismatched_symbols FROM compared"""

_DIFFERENCES = f""",
differing AS (
  SELECT {_KEYS}, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'extra' ELSE 'changed' END AS difference
  FROM (SELECT {_KEYS}, {_LINE} AS a FROM staged2) FULL JOIN (SELECT {_KEYS}, {_LINE} AS b FROM loaded) USING ({_KEYS})
  WHERE a IS DISTINCT FROM b)"""

_CHANGES = """
SELECT change, count(*) AS rows FROM (
  SELECT CASE WHEN s.currency IS NULL THEN 'carried' WHEN a.currency IS NULL THEN 'inserted'
    WHEN {differs} THEN 'corrected' ELSE 'unchanged' END AS change
  FROM loaded a FULL JOIN {staged} s ON a.source_name = s.source_name AND a.symbol = s.symbol AND a.price_ts = s.price_ts
  UNION ALL
  SELECT 'closed' FROM loaded a JOIN {staged} s USING (source_name, symbol, price_ts) WHERE {differs})
GROUP BY change"""

_EXCHANGE = """
WITH local AS (SELECT event_id AS o1, 'U' || CAST(user_id AS VARCHAR) AS symbol, ts FROM events),
placed AS (
  SELECT *, CASE
    WHEN ts >= TIMESTAMP '2024-03-10 02:00:00' AND ts < TIMESTAMP '2024-03-10 03:00:00' THEN TIMESTAMP '2024-03-10 07:00:00'
    WHEN ts >= TIMESTAMP '2024-11-03 01:00:00' AND ts < TIMESTAMP '2024-11-03 02:00:00' THEN NULL
    ELSE timezone('UTC', timezone('America/New_York', ts)) END AS price_ts
  FROM local)"""


def _rules(rows: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM {rows}"
        for rule, broken in rules.items()
    )


_BAR_RULES = {
    "not_null": " OR ".join(f"{c} IS NULL" for c in ("source_name", "symbol", "price_ts", *_PRICES, "volume", "currency")),
    "positive_prices": " OR ".join(f"{c} <= 0" for c in (*_PRICES, "adjusted_close")),
    "non_negative_volume": "volume < 0",
    "high_low_envelope": "high_price < open_price OR high_price < close_price OR high_price < low_price "
    "OR low_price > open_price OR low_price > close_price",
    "currency_length": "length(currency) <> 3",
}

ACTIONS = """
actions AS (
  SELECT 'vendor_a' AS source_name, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
    DATE '1998-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS action_date, 'split' AS action_type,
    CAST([2, 3, 4, 7, 10][CAST(s_suppkey % 5 AS INTEGER) + 1] AS DECIMAL(18,8)) AS split_ratio,
    CAST(NULL AS DECIMAL(18,6)) AS dividend_amount
  FROM supplier
  UNION ALL
  SELECT 'vendor_a', 'S' || CAST(s_suppkey AS VARCHAR), DATE '2000-01-01' + CAST(s_suppkey % 200 AS INTEGER), 'dividend',
    NULL, CAST((s_suppkey % 50) / 4.0 AS DECIMAL(18,6))
  FROM supplier WHERE s_suppkey % 2 = 0)"""

# At most one split and one later dividend per symbol, so the fold has a closed form.
_ADJUSTED = f"""{MERGED},{ACTIONS},
adjusted AS (
  SELECT m.* REPLACE (CAST(
      (CASE WHEN CAST(m.price_ts AS DATE) < sp.action_date THEN m.close_price / CAST(sp.split_ratio AS DOUBLE)
            ELSE CAST(m.close_price AS DOUBLE) END)
      - (CASE WHEN CAST(m.price_ts AS DATE) < dv.action_date THEN CAST(dv.dividend_amount AS DOUBLE) ELSE 0 END)
    AS DECIMAL(18,6)) AS adjusted_close)
  FROM merged m
  LEFT JOIN actions sp ON sp.symbol = m.symbol AND sp.action_type = 'split'
  LEFT JOIN actions dv ON dv.symbol = m.symbol AND dv.action_type = 'dividend')"""

RUNS = """
WITH counted AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS source_name, ts AS started_at, ts AS created_at,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
    1000 + event_id % 7000 AS duration_ms, 1000 + event_id % 500 AS rows_read, event_id % 17 AS rows_rejected,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1000 + event_id % 500 - event_id % 17 END AS rows_loaded,
    event_id % 90 AS csv_parse_ms, 400 + event_id % 300 AS transform_ms, event_id % 150 AS copy_ms,
    event_id % 250 AS upsert_ms, 1 + event_id % 3 AS run_number, value,
    1000 + event_id % 500 - event_id % 17 AS rows_valid, event_id % 5 AS duplicates_dropped,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'passed' END AS reconciliation_status,
    CASE WHEN event_type = 'error' THEN 'feed error stopped in run ' || event_id END AS error_message
  FROM events),
runs AS (
  SELECT *,
    CAST((rows_loaded * 200000 + duration_ms) // (2 * duration_ms) AS BIGINT) AS rate_cents,
    CAST((rows_rejected * 2000000 + rows_read) // (2 * rows_read) AS BIGINT) AS error_micros
  FROM counted)"""


def _fixed(units: str, digits: int) -> str:
    """An integer count of 10^-digits units as fixed-point text."""
    scale = 10**digits
    return f"(CAST({units} // {scale} AS VARCHAR) || '.' || lpad(CAST({units} % {scale} AS VARCHAR), {digits}, '0'))"


def _percentile(rows: str, group: str, value: str, p: float, name: str) -> str:
    """Linear interpolation between the two ranks around p."""
    return f"""
{name}_r AS (
  SELECT {group} AS g, CAST({value} AS DOUBLE) AS x, row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i,
    (CAST({p} AS DOUBLE) / 100) * (count(*) OVER (PARTITION BY {group}) - 1) AS r FROM {rows}),
{name} AS (
  SELECT g, min(x) + (max(x) - min(x)) * max(r - floor(r)) AS y FROM {name}_r
  WHERE i = floor(r) OR i = floor(r) + 1 GROUP BY g)"""


def _cut(value: str, name: str) -> str:
    return f"CAST(trunc({value} * 10000.0::DOUBLE) AS BIGINT) / 10000.0::DOUBLE AS {name}"


_PHASES = """,
phases AS (
  SELECT 'CSV parse' AS phase, 1 AS place, csv_parse_ms AS ms FROM runs UNION ALL
  SELECT 'transform', 2, transform_ms FROM runs UNION ALL
  SELECT 'COPY', 3, copy_ms FROM runs UNION ALL
  SELECT 'UPSERT merge', 4, upsert_ms FROM runs)""" + "," + _percentile("phases", "phase", "ms", 50, "med")


_FIRST_BAR = f"first_bar AS (SELECT {_KEYS} FROM loaded ORDER BY {_KEYS} LIMIT 1)"

_US_SHIFTS = """
WITH clocks AS (
  SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_minutes(
    CASE l_linenumber WHEN 1 THEN 90 WHEN 2 THEN 120 WHEN 3 THEN 150 WHEN 4 THEN 180 ELSE 570 END) AS local_ts
  FROM lineitem),
dated AS (
  SELECT *, CAST(local_ts AS DATE) AS d,
    isodow(local_ts) = 7 AND month(local_ts) = 4 AND day(local_ts) <= 7 AS april_shift,
    isodow(local_ts) = 7 AND month(local_ts) = 10 AND day(local_ts) >= 25 AS october_shift
  FROM clocks),
placed AS (
  SELECT *, CASE
    WHEN april_shift AND local_ts >= d + INTERVAL 2 HOUR AND local_ts < d + INTERVAL 3 HOUR THEN d + INTERVAL 7 HOUR
    WHEN october_shift AND local_ts >= d + INTERVAL 1 HOUR AND local_ts < d + INTERVAL 2 HOUR THEN NULL
    ELSE timezone('UTC', timezone('America/New_York', local_ts)) END AS price_ts
  FROM dated)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "feed_columns_mapped": """
SELECT 'vendor_b' AS source_name, o_orderkey AS o1, 'c' || CAST(o_custkey AS VARCHAR) AS symbol,
  strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS "timestamp",
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "open",
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(1 AS DECIMAL(18,2)) AS VARCHAR) AS high,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(1 AS DECIMAL(18,2)) AS VARCHAR) AS low,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "close",
  '1e2' AS volume, ' usd ' AS currency, 'none' AS adjusted_close
FROM orders""",
        "feed_tagged_reasons": f"{TAGGED} SELECT {_ORDER}, rejection_reason FROM tagged",
        "reject_reason_counts": f"""{TAGGED}
SELECT reason, count(*) AS rows FROM (
  SELECT unnest(string_split(rejection_reason, '; ')) AS reason FROM tagged WHERE rejection_reason <> '') GROUP BY reason""",
        "feed_rejected_rows": f"""{TAGGED}
SELECT symbol, "timestamp", "open", high, low, "close", volume, adjusted_text AS adjusted_close, currency, rejection_reason
FROM tagged WHERE rejection_reason <> ''""",
        "feed_accepted_dedup": f"""{STAGED}
SELECT source_name, symbol, {_ts("price_ts")}, {", ".join(_dec(c, "DECIMAL(38,18)") for c in _PRICES)}, volume,
  {_dec("adjusted_close", "DECIMAL(38,18)")}, currency FROM staged_bars""",
        "run_counters": f"""{STAGED}
SELECT (SELECT count(*) FROM tagged) AS rows_read, (SELECT count(*) FROM staged_bars) AS rows_valid,
  (SELECT count(*) FROM tagged WHERE rejection_reason <> '') AS rows_rejected,
  (SELECT count(*) FROM tagged WHERE rejection_reason = '') - (SELECT count(*) FROM staged_bars) AS duplicates_dropped""",
        "staged_bars": f"{STAGED} SELECT {_SHOW_BAR} FROM staged",
        "two_feeds_staged": f"""{STAGED},
second AS (
  SELECT 'vendor_b' AS source_name, 'C' || CAST(o_custkey AS VARCHAR) AS symbol,
    timezone('UTC', timezone('America/New_York', date_trunc('minute', o_orderdate))) AS price_ts,
    CAST(o_totalprice AS DECIMAL(18,2)) AS px, CAST(1 AS DECIMAL(18,2)) AS one
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('minute', o_orderdate) ORDER BY o_orderkey DESC) = 1),
both_feeds AS (
  SELECT * FROM staged UNION ALL
  SELECT source_name, symbol, price_ts, px, px + one, px - one, px, 100, NULL, 'USD' FROM second)
SELECT {_SHOW_BAR} FROM both_feeds""",
        "feed_local_to_utc": f"{_EXCHANGE} SELECT o1, symbol, {_ts('price_ts')} FROM placed",
        "zone_edges": f"""{_US_SHIFTS}
SELECT l_orderkey, l_partkey, l_linenumber, {_ts("local_ts")}, {_ts("price_ts")},
  strftime(timezone('America/New_York', timezone('UTC', price_ts)), '%Y-%m-%d %H:%M:%S.%f') AS shown
FROM placed""",
        "timestamp_shapes": f"""
SELECT event_id, {_ts('''CASE event_id % 29 WHEN 0 THEN ts WHEN 2 THEN date_trunc('second', ts) + INTERVAL 5 HOUR
  WHEN 1 THEN date_trunc('second', ts) WHEN 6 THEN date_trunc('second', ts) WHEN 7 THEN date_trunc('second', ts)
  WHEN 13 THEN date_trunc('second', ts) WHEN 15 THEN date_trunc('minute', ts) + INTERVAL 4 HOUR
  WHEN 4 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 11 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
  WHEN 12 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 16 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
  WHEN 18 THEN date_trunc('millisecond', ts) WHEN 20 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
  WHEN 21 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 22 THEN date_trunc('second', ts) WHEN 23 THEN date_trunc('second', ts)
  WHEN 25 THEN date_trunc('month', ts) + INTERVAL 12 DAY + (date_trunc('minute', ts) - date_trunc('day', ts))
  WHEN 26 THEN date_trunc('hour', ts) WHEN 28 THEN date_trunc('second', ts)
  WHEN 27 THEN date_trunc('hour', CASE WHEN day(ts) > 12 THEN ts ELSE make_timestamp(year(ts), day(ts), month(ts), hour(ts), 0, 0) END)
  ELSE date_trunc('minute', ts) END''', 'price_ts')} FROM events""",
        "calendar_violations": f"""{_EXCHANGE}, shown AS (
  SELECT o1, price_ts, timezone('America/New_York', timezone('UTC', price_ts)) AS clock FROM placed)
SELECT o1, concat_ws('; ', CASE WHEN price_ts IS NULL THEN 'invalid_timestamp' END,
  CASE WHEN isodow(clock) >= 6 THEN 'market_closed_weekend' END,
  CASE WHEN CAST(clock AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-02-19') THEN 'market_closed_holiday' END,
  CASE WHEN CAST(clock AS TIME) < TIME '09:30:00' OR CAST(clock AS TIME) > TIME '16:00:00' THEN 'outside_market_hours' END
  ) AS rejection_reason FROM shown""",
        "future_timestamps": """
SELECT event_id AS o1, CASE WHEN ts > TIMESTAMP '2024-01-15 00:05:00' THEN 'future_timestamp' ELSE '' END AS rejection_reason
FROM events""",
        "missing_column_reasons": f"""{TAGGED}, codes AS (
  SELECT unnest(string_split(rejection_reason, '; ')) AS reason FROM tagged WHERE rejection_reason <> ''
  UNION ALL SELECT 'missing_column:venue' FROM feed)
SELECT reason, count(*) AS rows FROM codes
WHERE reason = 'missing_required:symbol' OR NOT starts_with(reason, 'missing_required') GROUP BY reason""",
        "temporal_merge_versions": f"{MERGED} SELECT {_SHOW_VERSION} FROM merged",
        "third_load_versions": f"{MERGED3} SELECT {_SHOW_VERSION} FROM merged3",
        "merge_change_counts": LOADED + _CHANGES.format(staged="staged2", differs=_differs("a", "s")),
        "idempotent_reload": f"{LOADED} SELECT 'unchanged' AS change, count(*) AS rows FROM loaded",
        "versions_to_close": f"{MERGED} SELECT {_SHOW_VERSION} FROM merged WHERE valid_to IS NOT NULL",
        "versions_to_insert": f"{MERGED} SELECT {_SHOW_VERSION} FROM merged WHERE valid_from = TIMESTAMP '2024-02-01 00:00:00'",
        "current_versions": f"{MERGED} SELECT {_SHOW_BAR}, {_ts('valid_from')} FROM merged WHERE valid_to IS NULL",
        "version_counts": f"""{MERGED}
SELECT source_name, symbol, count(*) AS total_versions, count(*) FILTER (WHERE valid_to IS NULL) AS active_versions
FROM merged GROUP BY source_name, symbol""",
        "price_as_of_point": f"""{MERGED3}, {_FIRST_BAR},
asked AS (SELECT unnest([TIMESTAMP '2023-12-31 00:00:00', TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-31 23:59:59',
  TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '2024-02-05 00:00:00']) AS asked)
SELECT {_SHOW_ASOF}, {_ts("asked")} FROM asked JOIN first_bar ON TRUE JOIN merged3 USING ({_KEYS})
WHERE valid_from <= asked AND (valid_to IS NULL OR valid_to > asked)""",
        "price_as_of_sql": f"""{MERGED3}, {_FIRST_BAR}
SELECT {_SHOW_ASOF} FROM first_bar JOIN merged3 USING ({_KEYS})
WHERE valid_from <= TIMESTAMP '2024-02-03 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-02-03 00:00:00')""",
        "price_as_of_bulk": f"""{MERGED3},
asked AS (SELECT {_KEYS}, TIMESTAMP '2023-12-20 00:00:00' + to_days(CAST(volume // 100 AS INTEGER)) AS as_of FROM staged)
SELECT {_SHOW_ASOF}, {_ts("as_of")} FROM asked JOIN merged3 USING ({_KEYS})
WHERE valid_from <= as_of AND (valid_to IS NULL OR valid_to > as_of)""",
        "snapshot_as_of": f"""{MERGED} SELECT {_SHOW_ASOF} FROM merged
WHERE valid_from <= TIMESTAMP '2024-01-20 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-20 00:00:00')""",
        "symbol_checksums": f"{STAGED} SELECT symbol, n AS row_count, c AS checksum FROM ({_sums('staged')})",
        "landed_rows": f"{MERGED}{_compared('merged')} SELECT {_SHOW_BAR} FROM landed",
        "reconcile_by_symbol": f"{MERGED}{_compared('merged')} SELECT * FROM compared",
        "reconcile_documents": f"""{MERGED}{_compared('loaded')}
SELECT symbol, '{{"landed_checksum":' || coalesce('"' || landed_checksum || '"', 'null') || ',"landed_rows":' || landed_rows
  || ',"matched":' || matched || ',"source_checksum":' || coalesce('"' || source_checksum || '"', 'null')
  || ',"source_rows":' || source_rows || '}}' AS document FROM compared""",
        "reconcile_digest": f"{MERGED}{_compared('loaded')} SELECT symbol, source_rows, landed_rows, matched FROM compared",
        "reconcile_differences": f"""{LOADED}{_DIFFERENCES}
SELECT source_name, symbol, {_ts("price_ts")}, difference FROM differing""",
        "reconcile_verdict": MERGED + _compared("merged") + _VERDICT,
        "reconcile_verdict_failed": MERGED + _compared("loaded") + _VERDICT,
        "landing_violations": f"""WITH {FEED},{_tagged('tagged', 'feed', False)},{_staged('staged', 'tagged')}
{_rules('staged', _BAR_RULES)}""",
        "version_violations": f"""{LOADED},{_merged('backdated', 'loaded', 'staged2', '2023-12-01 00:00:00')}
{_rules('backdated', {**_BAR_RULES, 'valid_window': 'valid_to <= valid_from'})}""",
        "active_key_duplicates": f"""{LOADED},
twice AS (SELECT {_KEYS} FROM staged UNION ALL SELECT {_KEYS} FROM staged2)
SELECT source_name, symbol, {_ts("price_ts")}, count(*) AS copies FROM twice GROUP BY {_KEYS}, twice.price_ts HAVING count(*) > 1""",
        "interval_overlaps": f"""{MERGED}, all_rows AS (
  SELECT {_KEYS}, valid_from, valid_to FROM merged
  UNION ALL SELECT {_KEYS}, TIMESTAMP '2024-01-15 00:00:00', NULL FROM staged WHERE volume % 300 = 0)
SELECT source_name, symbol, {_ts("price_ts")}, {_ts("valid_from")}, {_ts("valid_to")},
  {_ts("CASE WHEN held_until < TIMESTAMP '9999-01-01 00:00:00' THEN held_until END", "held_until")} FROM (
  SELECT *, max(coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00')) OVER (PARTITION BY {_KEYS}
    ORDER BY valid_from, valid_to NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held_until
  FROM all_rows WHERE valid_to IS NULL OR valid_to > valid_from)
WHERE held_until > valid_from""",
        "volume_spellings": """
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS q, (l_orderkey + l_linenumber) % 12 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE s WHEN 0 THEN q || '' WHEN 1 THEN q || '.' WHEN 2 THEN q || '.000' WHEN 3 THEN q || 'e2' WHEN 4 THEN q || '00E-2'
    WHEN 5 THEN q || '.0000000000000000001' WHEN 6 THEN q || '.25e2' WHEN 7 THEN q || '.25e1' WHEN 8 THEN '-' || q || '.0e0'
    WHEN 9 THEN '.' || q WHEN 10 THEN q || 'e30' ELSE '0.000000000000000000000' || q || 'e23' END AS spelled,
  CASE WHEN s IN (0, 1, 2, 4) THEN q WHEN s = 3 THEN 100 * q WHEN s = 6 THEN 100 * q + 25 WHEN s = 8 THEN -q
    WHEN s = 11 THEN CASE WHEN q < 10 THEN 10 * q ELSE q END END AS volume
FROM n""",
        "action_violations": f"""WITH {ACTIONS},
spoiled AS (SELECT source_name, symbol, action_date,
  CASE WHEN ends_with(symbol, '9') THEN 'merger' ELSE action_type END AS action_type,
  CASE WHEN ends_with(symbol, '7') THEN 0 ELSE split_ratio END AS split_ratio,
  CASE WHEN ends_with(symbol, '4') THEN NULL ELSE dividend_amount END AS dividend_amount FROM actions)
{_rules('spoiled', {
    'action_type': "action_type NOT IN ('split', 'dividend')",
    'split_ratio': "action_type = 'split' AND (split_ratio IS NULL OR split_ratio <= 0)",
    'dividend_amount': "action_type = 'dividend' AND (dividend_amount IS NULL OR dividend_amount < 0)",
})}""",
        "action_duplicates": f"""WITH {ACTIONS}
SELECT source_name, symbol, CAST(action_date AS VARCHAR) AS action_date, action_type, copies FROM (
  SELECT source_name, substr(symbol, 1, 2) AS symbol, CAST(date_trunc('year', action_date) AS DATE) AS action_date, action_type,
    count(*) AS copies FROM actions GROUP BY 1, 2, 3, 4) WHERE copies > 1""",
        "ledger_violations": f"""{RUNS},
spoiled AS (SELECT CASE WHEN source_name = 'error' THEN 'crashed' ELSE status END AS status,
  CASE rows_rejected WHEN 0 THEN 'passed' WHEN 1 THEN 'unknown' ELSE 'not_run' END AS reconciliation_status FROM runs)
{_rules('spoiled', {
    'status': "status NOT IN ('running', 'completed', 'failed')",
    'reconciliation_status': "reconciliation_status NOT IN ('not_run', 'passed', 'failed')",
})}""",
        "run_id_duplicates": f"{RUNS} SELECT run_id, 2 AS copies FROM runs WHERE status = 'failed'",
        "bars_with_actions": f"""{MERGED},{ACTIONS}
SELECT m.source_name, m.symbol, {_ts("m.price_ts")}, {_ts("m.valid_from")}, CAST(count(a.action_type) AS INTEGER) AS later_actions
FROM merged m LEFT JOIN actions a ON a.source_name = m.source_name AND a.symbol = m.symbol
  AND a.action_date > CAST(m.price_ts AS DATE)
GROUP BY m.source_name, m.symbol, m.price_ts, m.valid_from""",
        "adjusted_close": f"""{_ADJUSTED}
SELECT {_SHOW_ASOF}, {_ts("created_at")}, '2024-02-05 00:00:00.000000' AS updated_at FROM adjusted""",
        "adjusted_close_symbol": f"""{_ADJUSTED}
SELECT source_name, symbol, {_ts("price_ts")}, {_dec("close_price")}, {_dec("adjusted_close")}, {_ts("valid_from")}
FROM adjusted WHERE symbol = 'S4'""",
        "adjusted_as_new_belief": _ADJUSTED.replace("FROM merged m", "FROM loaded m")
        + _CHANGES.format(staged="adjusted", differs=_differs("a", "s")),
        "run_rates": f"{RUNS} SELECT run_id, {_fixed('rate_cents', 2)} AS throughput_rows_per_sec, {_fixed('error_micros', 6)} AS error_rate FROM runs",
        "runs_latest": f"""{RUNS}
SELECT run_id, source_name, status, {_ts("started_at")}, duration_ms, rows_read, rows_valid, rows_loaded, rows_rejected,
  duplicates_dropped, {_fixed('rate_cents', 2)} AS throughput_rows_per_sec, csv_parse_ms, transform_ms, copy_ms, upsert_ms,
  reconciliation_status, '{{"status":"' || reconciliation_status || '"}}' AS reconciliation,
  {_fixed('error_micros', 6)} AS error_rate, error_message
FROM runs ORDER BY runs.started_at DESC, run_id DESC LIMIT 20""",
        "runs_last_failed": f"""{RUNS}
SELECT run_id, source_name, {_ts("started_at")}, error_message,
  '{{"error_type":"FeedError","summary":"' || error_message || '",{_ADVICE.replace("'", "''")}}}' AS failure_summary
FROM runs WHERE status = 'failed'
ORDER BY runs.started_at DESC, run_id DESC LIMIT 1""",
        "runs_daily_trend": f"""{RUNS}, days AS (
  SELECT date_trunc('day', started_at) AS run_day, source_name, count(*) AS runs, CAST(sum(rows_read) AS BIGINT) AS rows_read,
    CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected,
    CAST((2 * sum(rate_cents) + count(*)) // (2 * count(*)) AS BIGINT) AS cents,
    CAST((2 * sum(error_micros) + count(*)) // (2 * count(*)) AS BIGINT) AS micros
  FROM runs GROUP BY 1, 2)
SELECT strftime(run_day, '%Y-%m-%d %H:%M:%S.%f') AS run_day, source_name, runs, rows_read, rows_loaded, rows_rejected,
  {_fixed('cents', 2)} AS avg_throughput_rows_per_sec, {_fixed('micros', 6)} AS avg_error_rate FROM days""",
        "runs_retained": f"""{RUNS} SELECT run_id, source_name, {_ts("created_at")} FROM runs
WHERE runs.created_at >= TIMESTAMP '2024-01-11 00:00:00'""",
        "ledger_latest_state": f"""{RUNS}
SELECT run_id, source_name, CASE WHEN value >= 5 THEN status ELSE 'running' END AS status,
  CASE WHEN value >= 5 THEN rows_loaded ELSE 0 END AS rows_loaded, CASE WHEN value >= 5 THEN duration_ms ELSE -1 END AS duration_ms
FROM runs""",
        "run_lookup": f"""{RUNS}
SELECT run_id, source_name, status, {_ts("started_at")}, duration_ms, rows_read, rows_valid, rows_loaded, rows_rejected,
  duplicates_dropped, {_fixed('rate_cents', 2)} AS throughput_rows_per_sec, csv_parse_ms, transform_ms, copy_ms, upsert_ms,
  reconciliation_status, '{{"status":"' || reconciliation_status || '"}}' AS reconciliation,
  {_fixed('error_micros', 6)} AS error_rate, error_message,
  {_ts("created_at")} FROM runs
WHERE CAST(run_id AS BIGINT) = (SELECT max(event_id) FROM events)""",
        "failure_documents": f"""{RUNS}
SELECT run_id, '{{"error_type":"FeedError","summary":"feed ' || source_name || ' stopped in run ' || run_id
  || '",{_ADVICE.replace("'", "''")}}}'
  AS failure_summary FROM runs WHERE status = 'failed'""",
        "bench_summary": f"""{RUNS}, steady AS (SELECT * FROM runs WHERE run_number IN (2, 3)),
{_percentile('runs', 'source_name', 'duration_ms', 50, 'a')},{_percentile('runs', 'source_name', 'duration_ms', 95, 'b')},
{_percentile('runs', 'source_name', 'rate_cents / 100.0::DOUBLE', 50, 'c')},
{_percentile('runs', 'source_name', 'rate_cents / 100.0::DOUBLE', 95, 'd')},
{_percentile('steady', 'source_name', 'rate_cents / 100.0::DOUBLE', 50, 'e')}
SELECT a.g AS source_name, {_cut('a.y', 'median_duration_ms_all_runs')}, {_cut('b.y', 'p95_duration_ms_all_runs')},
  {_cut('c.y', 'median_rows_per_sec_all_runs')}, {_cut('d.y', 'p95_rows_per_sec_all_runs')},
  {_cut('e.y', 'median_steady_state_rows_per_sec')}
FROM a JOIN b USING (g) JOIN c USING (g) JOIN d USING (g) LEFT JOIN e USING (g)""",
        "phase_medians": f"{RUNS}{_PHASES} SELECT g AS phase, y AS median_ms FROM med",
        "dominant_phase": f"""{RUNS}{_PHASES}
SELECT g AS phase, {_cut('y', 'median_ms')} FROM med JOIN (SELECT DISTINCT phase, place FROM phases) p ON p.phase = g
ORDER BY y DESC, place LIMIT 1""",
        "synthetic_bars": """
WITH i AS (SELECT event_id AS i, CAST(100 + (event_id % 500) / 10.0 AS DECIMAL(12,2)) AS base FROM events)
SELECT ['AAPL','MSFT','NVDA','GOOGL','TSLA','AMZN','META','JPM','V','MA'][CAST(i % 10 AS INTEGER) + 1] AS symbol,
  strftime(TIMESTAMP '2026-04-01 09:30:00' + to_minutes(i // 10), '%Y-%m-%d %H:%M:%S') AS "timestamp",
  CAST(base AS VARCHAR) AS "open", CAST(base + CAST(1.25 AS DECIMAL(12,2)) AS VARCHAR) AS high,
  CAST(base - CAST(0.85 AS DECIMAL(12,2)) AS VARCHAR) AS low, CAST(base + CAST(0.35 AS DECIMAL(12,2)) AS VARCHAR) AS "close",
  CAST(i + 100000 AS VARCHAR) AS volume, CAST(base + CAST(0.35 AS DECIMAL(12,2)) AS VARCHAR) AS adjusted_close,
  'USD' AS currency
FROM i""",
    }
    return sql
