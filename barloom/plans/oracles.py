"""The catalogue's queries in plain SQL over the same tables, for an independent check."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

SERIES = "code, candle, trade_time"
W = "OVER (PARTITION BY code, candle ORDER BY trade_time, id)"

HOUR_BARS = """bars AS (
  SELECT min(event_id) AS id, event_type AS code,
         arg_min(value, {'t': ts, 'e': event_id}) AS open, arg_max(value, {'t': ts, 'e': event_id}) AS close,
         max(value) AS high, min(value) AS low, date_trunc('hour', ts) AS trade_time, 'h1' AS candle,
         count(*) AS volume, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume_weight,
         max(ts) AS updated_at, min(ts) AS created_at
  FROM events GROUP BY event_type, date_trunc('hour', ts))"""


def month_bars(name: str = "bars", where: str = "TRUE") -> str:
    price = "floor(l_extendedprice / l_quantity * 100.0::DOUBLE) / 100.0::DOUBLE"
    order = f"{{'d': l_shipdate, 'o': l_orderkey, 'n': l_linenumber, 'p': {price}}}"
    return f"""{name} AS (
  SELECT CAST(l_suppkey * 100000 + year(m) * 12 + month(m) AS BIGINT) AS id, CAST(l_suppkey AS VARCHAR) AS code,
         open, close, high, low, m AS trade_time, 'mo' AS candle, volume
  FROM (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS m,
               arg_min({price}, {order}) AS open, arg_max({price}, {order}) AS close,
               max({price}) AS high, min({price}) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem WHERE {where} GROUP BY 1, 2))"""


MONTH_BARS = month_bars()


def r(expression: str, name: str) -> str:
    return f"round({expression}, 4) AS {name}"


def rounded(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)


OHLC = rounded("open", "close", "high", "low")
ROW = f"id, {SERIES}"


def add(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = f"WITH {', '.join(ctes)} {body}" if ctes else body


# --- loading -------------------------------------------------------------------

add(
    "load_filter",
    f"SELECT id, code, {OHLC}, trade_time, candle, volume, volume_weight, updated_at, created_at FROM bars "
    "WHERE trade_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND candle = 'h1'",
    HOUR_BARS,
)
add("load_codes", f"SELECT {ROW}, {rounded('close')}, volume FROM bars WHERE code IN ('click', 'error', 'none')", HOUR_BARS)
add(
    "coerce_prices",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 4) END AS open, "
    "round(CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE), 4) AS close FROM events",
)

# --- cleaning and projection -------------------------------------------------------

FEATURES = """featured AS (
  SELECT *, least(open, close) AS body_lower, greatest(open, close) AS body_upper,
         coalesce((least(open, close) - low) / nullif(high - low, 0), 0) * 100 AS body_bottom_perc,
         100 - coalesce((high - greatest(open, close)) / nullif(high - low, 0), 0) * 100 AS body_top_perc,
         round_even(coalesce(abs(close - open) / nullif(high - low, 0) * 100, 0) * 100, 0) / 100 AS body_perc,
         CASE WHEN close - open >= 0 THEN 1 ELSE -1 END AS direction,
         abs(close - open) AS body_size, (high - low) / 2 + low AS mid_point, high - low AS daily_range
  FROM bars)"""
FEATURE_COLUMNS = (
    "CAST(direction AS BIGINT) AS direction, "
    + rounded("body_size", "body_perc", "body_lower", "body_upper", "body_bottom_perc", "body_top_perc", "daily_range", "mid_point")
)
add(
    "candle_features",
    f"SELECT {ROW}, {OHLC}, volume, volume_weight, {FEATURE_COLUMNS} FROM featured",
    HOUR_BARS, FEATURES,
)
add(
    "clean_rows",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN NULL ELSE event_type END AS label,
       ts AS seen_at, round(CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE), 4) AS open, round(value, 4) AS close,
       coalesce(CASE WHEN value < 50 THEN value > 20 END, FALSE) AS flag
       FROM events WHERE value > 5""",
)
RANGE = """CAST(min(CAST(trade_time AS DATE)) OVER (PARTITION BY code, candle) AS VARCHAR) AS start_date,
  CAST(max(CAST(trade_time AS DATE)) OVER (PARTITION BY code, candle) AS VARCHAR) AS end_date"""
TRADE_DATE = "CAST(CAST(trade_time AS DATE) AS VARCHAR) AS trade_time_date"
add("date_range", f"SELECT {ROW}, {TRADE_DATE}, {RANGE} FROM bars", MONTH_BARS)
add(
    "prepared_bars",
    f"SELECT {ROW}, {OHLC}, volume, volume_weight, {FEATURE_COLUMNS}, {TRADE_DATE}, {RANGE} FROM featured",
    HOUR_BARS, FEATURES,
)
# Rounds the binary value: at a midpoint of the scaled value the split product tells the side.
add(
    "decimals",
    """SELECT event_id, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(20,4)) AS VARCHAR) AS exact,
       CAST(CAST(CASE WHEN steps % 2 = 0 THEN steps WHEN above > 0 THEN steps + 1 WHEN above < 0 THEN steps - 1
            ELSE round_even(steps / 2, 0) * 2 END / 200 AS DECIMAL(12,2)) AS VARCHAR) AS rounded
       FROM (SELECT *, (short * 200 - steps) + (share - short) * 200 AS above
             FROM (SELECT event_id, value, value / 8 AS share, round_even(value / 8 * 200, 0) AS steps,
                          CAST(CAST(value / 8 AS FLOAT) AS DOUBLE) AS short FROM events))""",
)
add(
    "mixed_times",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN date_trunc('second', ts)
       WHEN event_type = 'view' THEN date_trunc('day', ts)
       WHEN event_id % 11 = 0 THEN date_trunc('second', ts) - INTERVAL 8 HOUR WHEN event_id % 11 = 1 THEN date_trunc('minute', ts)
       WHEN event_id % 11 = 2 AND day(ts) <= 12
         THEN make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), CAST(second(ts) AS DOUBLE))
       WHEN event_id % 11 = 2 THEN date_trunc('second', ts)
       WHEN event_id % 5 < 2 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS trade_time,
       event_type = 'error' AS failed FROM events""",
)
add("drop_zone", "SELECT event_id, ts + INTERVAL 8 HOUR AS ts FROM events")
TREND = "CAST(CASE WHEN close > open THEN 1 WHEN close < open THEN -1 ELSE 0 END AS BIGINT) AS direction"


def mean(value: str, n: int) -> str:
    frame = f"OVER (PARTITION BY code, candle ORDER BY trade_time, id ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({value}) {frame} = {n} THEN avg({value}) {frame} END"


add(
    "strategy_rows",
    f"SELECT {ROW}, {OHLC}, volume, {TREND}, {r(mean('close', 5), 'MA_5')}, CAST(0 AS BIGINT) AS SIGNAL FROM bars",
    MONTH_BARS,
)
add(
    "drop_incomplete",
    """SELECT o_orderkey, round(o_totalprice, 4) AS price, o_orderdate AS day FROM orders
       WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW' AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL""",
)


def uuid_of(value: str) -> str:
    digest = f"md5(CAST({value} AS VARCHAR))"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in cuts)


add(
    "task_lookup",
    f"""SELECT {uuid_of('o_orderkey')} AS id, o_orderkey, o_orderstatus FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)

# --- checks ------------------------------------------------------------------------

REQUIRED = ("id", "code", "open", "close", "high", "low", "trade_time", "candle", "updated_at", "created_at")
add(
    "input_gate",
    " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS nulls FROM gated" for c in REQUIRED),
    HOUR_BARS,
    "gated AS (SELECT * REPLACE (CASE WHEN code <> 'error' THEN code END AS code, CASE WHEN volume > 1 THEN close END AS close) FROM bars)",
)
add("output_gate", "SELECT 'direction' AS column, count(*) FILTER (direction IS NULL) AS nulls FROM featured", HOUR_BARS, FEATURES)
add(
    "ordered_bars",
    f"SELECT {ROW}, round(close, 4) AS close, row_number() OVER (ORDER BY trade_time, code, candle, id) - 1 AS position FROM bars",
    MONTH_BARS,
)
add(
    "load_gate",
    """SELECT 'all' AS name, 'stored' AS outcome, count(*) AS bars FROM bars
       UNION ALL SELECT 'none', 'load gate: empty data set', 0
       UNION ALL SELECT 'gaps', 'load gate: code: ' || count(*) || ' nulls', 0 FROM bars WHERE code = 'error'""",
    HOUR_BARS,
)
add(
    "prepared_datasets",
    """SELECT code, candle, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume, CASE WHEN code = 'view' THEN 1 ELSE 2 END AS loads, 1 AS datasets,
       code || '_' || candle || '_' || strftime(min(trade_time), '%Y-%m-%d') || '_' || strftime(max(trade_time), '%Y-%m-%d') || '.parquet' AS name
       FROM bars WHERE hour(trade_time) < 12 OR code <> 'view' GROUP BY code, candle""",
    HOUR_BARS,
)
add(
    "repeated_keys",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
add(
    "orphans",
    """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_custkey IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""",
)
add(
    "outside_domain",
    "SELECT o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1",
)
add(
    "request_checks",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'code' END,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'start_time' END, CASE WHEN o_orderpriority = '2-HIGH' THEN 'candle' END,
       CASE WHEN o_totalprice < 50000 THEN 'pca_components' END) AS problems FROM orders""",
)

# --- patterns and indicators -------------------------------------------------------

add(
    "bar_patterns",
    f"""SELECT {ROW}, body_perc > 98 AS marubozu, body_bottom_perc > 75 AND body_perc < 15 AS hanging_man,
        body_top_perc < 25 AND body_perc < 15 AS shooting_star,
        body_top_perc < 60 AND body_bottom_perc > 40 AND body_perc < 15 AS spinning_top FROM featured""",
    HOUR_BARS, FEATURES,
)
add(
    "sequence_patterns",
    f"""SELECT {ROW}, coalesce(direction <> d1 AND body_size > s1 * 1.1, FALSE) AS engulfing,
        coalesce(near AND direction = -1 AND direction <> d1 AND body_top_perc < 40, FALSE) AS tweezer_top,
        coalesce(near AND direction = 1 AND direction <> d1 AND body_bottom_perc > 60, FALSE) AS tweezer_bottom,
        coalesce(p2 > 90 AND p1 < 10 AND direction = 1 AND d2 <> 1 AND close > m2, FALSE) AS morning_star,
        coalesce(p2 > 90 AND p1 < 10 AND direction = -1 AND d2 <> -1 AND close < m2, FALSE) AS evening_star
        FROM (SELECT *, abs((body_size - s1) / nullif(s1, 0) * 100) < 15 AND abs((low - l1) / nullif(l1, 0) * 100) < 0.01
              AND abs((high - h1) / nullif(h1, 0) * 100) < 0.01 AS near FROM shifted)""",
    MONTH_BARS, FEATURES,
    f"""shifted AS (SELECT *, lag(direction) {W} AS d1, lag(direction, 2) {W} AS d2, lag(body_size) {W} AS s1,
        lag(body_perc) {W} AS p1, lag(body_perc, 2) {W} AS p2, lag(mid_point, 2) {W} AS m2,
        lag(low) {W} AS l1, lag(high) {W} AS h1 FROM featured)""",
)
def step(price: str) -> str:
    return (f"CASE WHEN {price} < 500 THEN 100.0 WHEN {price} < 1000 THEN 200.0 WHEN {price} < 2000 THEN 300.0 "
            f"WHEN {price} < 8000 THEN 400.0 ELSE 500.0 END::DOUBLE AS {price}")


STEPS = ", ".join(step(price) for price in ("open", "high", "low", "close"))
ORACLES["tick_patterns"] = ORACLES["sequence_patterns"].replace(
    "featured AS (", f"ticks AS (SELECT * REPLACE ({STEPS}) FROM bars), featured AS ("
).replace("AS daily_range\n  FROM bars)", "AS daily_range\n  FROM ticks)")

# Exponential means by definition: every earlier row of the series with its weight.
NUMBERED = f"numbered AS (SELECT *, row_number() {W} - 1 AS i FROM bars)"
KEY = "code, candle, i"


def weighted(name: str, source: str, value: str, span: int) -> str:
    q = 1 - 2 / (span + 1)
    weight = f"power({q!r}, a.i - b.i)"
    return f"""{name} AS (
  SELECT a.code, a.candle, a.i, CASE WHEN count(b.{value}) >= {span}
         THEN sum({weight} * b.{value}) / sum({weight}) END AS {name}
  FROM {source} a LEFT JOIN {source} b
    ON a.code = b.code AND a.candle = b.candle AND b.i <= a.i AND b.{value} IS NOT NULL
  GROUP BY a.code, a.candle, a.i)"""


MACD_CTES = (
    weighted("fast", "numbered", "close", 12),
    weighted("slow", "numbered", "close", 26),
    f"difference AS (SELECT {KEY}, fast - slow AS macd FROM fast JOIN slow USING ({KEY}))",
    weighted("signal", "difference", "macd", 9),
    f"trend AS (SELECT {KEY}, macd, signal FROM difference JOIN signal USING ({KEY}))",
)
MACD_COLUMNS = f"{r('macd', 'MACD')}, {r('signal', 'MACD_SIGNAL')}, {r('macd - signal', 'HIST')}"

RSI_CTES = (
    f"moves AS (SELECT {KEY}, close - lag(close) {W} AS move FROM numbered)",
    """smooth AS (
  SELECT a.code, a.candle, a.i, CASE WHEN count(b.move) >= 14 THEN sum(weight * greatest(b.move, 0)) END AS up,
         CASE WHEN count(b.move) >= 14 THEN sum(weight * greatest(-b.move, 0)) END AS down
  FROM moves a LEFT JOIN (SELECT *, CASE WHEN i = 1 THEN 1.0 ELSE 1.0 / 14 END AS share FROM moves) b
    ON a.code = b.code AND a.candle = b.candle AND b.i <= a.i AND b.move IS NOT NULL,
    LATERAL (SELECT b.share * power(13.0 / 14, a.i - b.i) AS weight)
  GROUP BY a.code, a.candle, a.i)""",
    f"""strength AS (SELECT {KEY}, round_even(CASE WHEN down = 0 AND up > 0 THEN 100.0
  WHEN down <> 0 THEN 100 - 100 / (1 + up / down) END * 100, 0) / 100 AS rsi FROM smooth)""",
)
RANGES = f"""ranged AS (SELECT *, greatest(high - low, abs(high - lag(close) {W}), abs(lag(close) {W} - low)) AS reach FROM numbered)"""
TYPICAL = "(close + high + low) / 3"


def deviation(value: str, n: int) -> str:
    frame = f"OVER (PARTITION BY code, candle ORDER BY trade_time, id ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({value}) {frame} = {n} THEN stddev_samp({value}) {frame} END"


BANDS = (
    f"{r(mean(TYPICAL, 20), 'BB_MA')}, {r(f'{mean(TYPICAL, 20)} + 2 * {deviation(TYPICAL, 20)}', 'BB_UP')}, "
    f"{r(f'{mean(TYPICAL, 20)} - 2 * {deviation(TYPICAL, 20)}', 'BB_LW')}"
)
ENGULFING = f"""coalesce((close - open >= 0) <> (lag(close - open) {W} >= 0)
  AND abs(close - open) > abs(lag(close - open) {W}) * 1.1, FALSE) AS ENGULFING"""
EMA_20, EMA_10 = weighted("ema_20", "numbered", "close", 20), weighted("ema_10", "numbered", "close", 10)

GAPPED = """gapped AS (SELECT * REPLACE (CASE WHEN volume % 6 <> 0 THEN close END AS close) FROM numbered)"""
add("ema_gaps", f"SELECT {ROW}, {r('ema_10', 'EMA_10')} FROM gapped JOIN ema_10 USING ({KEY})", MONTH_BARS, NUMBERED, GAPPED,
    weighted("ema_10", "gapped", "close", 10))
# y = a y + (1 - a) x with a = q^k / (q^k + alpha) after k rows, as a sum over all earlier moves
add(
    "rsi_gaps",
    f"SELECT {ROW}, {r('rsi', 'RSI_14')} FROM gapped JOIN strength USING ({KEY})",
    MONTH_BARS, NUMBERED, GAPPED,
    RSI_CTES[0].replace("FROM numbered", "FROM gapped"),
    """stepped AS (SELECT *, power(13.0 / 14, i - max(CASE WHEN move IS NOT NULL THEN i END) OVER (
    PARTITION BY code, candle ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS kept FROM moves)""",
    """clocked AS (SELECT *, coalesce((1.0 / 14) / (kept + 1.0 / 14), 1) AS share,
    sum(CASE WHEN move IS NOT NULL AND kept IS NOT NULL THEN ln(kept / (kept + 1.0 / 14)) ELSE 0 END)
    OVER (PARTITION BY code, candle ORDER BY i ROWS UNBOUNDED PRECEDING) AS clock FROM stepped)""",
    """smooth AS (
  SELECT a.code, a.candle, a.i, CASE WHEN count(b.move) >= 14 THEN sum(b.share * exp(a.clock - b.clock) * greatest(b.move, 0)) END AS up,
         CASE WHEN count(b.move) >= 14 THEN sum(b.share * exp(a.clock - b.clock) * greatest(-b.move, 0)) END AS down
  FROM clocked a LEFT JOIN clocked b ON a.code = b.code AND a.candle = b.candle AND b.i <= a.i AND b.move IS NOT NULL
  GROUP BY a.code, a.candle, a.i)""",
    RSI_CTES[2],
)
NULL_SERIES = "coded AS (SELECT * REPLACE (CASE WHEN id % 300000 >= 100000 THEN code END AS code) FROM bars)"
add("null_series", f"SELECT {ROW}, {r(mean('close', 10), 'MA_10')}, {ENGULFING} FROM coded", MONTH_BARS, NULL_SERIES)
add("engulfing", f"SELECT {ROW}, {ENGULFING} FROM bars", MONTH_BARS)
add("bollinger", f"SELECT {ROW}, {BANDS} FROM bars", MONTH_BARS)
add("atr", f"SELECT {ROW}, {r(mean('reach', 14), 'ATR_14')} FROM ranged", MONTH_BARS, NUMBERED, RANGES)
add("moving_average", f"SELECT {ROW}, {r(mean('close', 10), 'MA_10')} FROM bars", MONTH_BARS)
add("ema", f"SELECT {ROW}, {r('ema_10', 'EMA_10')} FROM numbered JOIN ema_10 USING ({KEY})", MONTH_BARS, NUMBERED, EMA_10)
add("macd", f"SELECT {ROW}, {MACD_COLUMNS} FROM numbered JOIN trend USING ({KEY})", MONTH_BARS, NUMBERED, *MACD_CTES)
add(
    "keltner",
    f"SELECT {ROW}, {r('ema_20 + 2 * a', 'KeUp')}, {r('ema_20 - 2 * a', 'KeLo')}, {r('ema_20', 'EMA_20')}, {r('a', 'ATR_10')} "
    f"FROM (SELECT *, {mean('reach', 10)} AS a FROM ranged) JOIN ema_20 USING ({KEY})",
    MONTH_BARS, NUMBERED, RANGES, EMA_20,
)
add("rsi", f"SELECT {ROW}, {r('rsi', 'RSI_14')} FROM numbered JOIN strength USING ({KEY})", MONTH_BARS, NUMBERED, *RSI_CTES)
add(
    "bias",
    f"SELECT {ROW}, {r('(close - ema_20) / ema_20 * 100', 'BIAS_20')} FROM numbered JOIN ema_20 USING ({KEY})",
    MONTH_BARS, NUMBERED, EMA_20,
)
add(
    "indicator_panel",
    f"""SELECT {ROW}, {BANDS}, {r(mean('reach', 14), 'ATR_14')}, {r('ema_20 + 2 * a', 'KeUp')}, {r('ema_20 - 2 * a', 'KeLo')},
        {r('rsi', 'RSI_14')}, {MACD_COLUMNS}, {r('ema_10', 'EMA_10')}, {r(mean('close', 10), 'MA_10')},
        {r('(close - ema_20) / ema_20 * 100', 'BIAS_20')}, {ENGULFING}
        FROM (SELECT *, {mean('reach', 10)} AS a FROM ranged)
        JOIN ema_20 USING ({KEY}) JOIN ema_10 USING ({KEY}) JOIN trend USING ({KEY}) JOIN strength USING ({KEY})""",
    HOUR_BARS, NUMBERED, RANGES, EMA_20, EMA_10, *MACD_CTES, *RSI_CTES,
)
add(
    "prepared_trend",
    f"""SELECT code, trade_time, CAST(direction AS BIGINT) AS direction, {rounded('body_perc')}, {RANGE},
        {r('ema_10', 'EMA_10')}, {MACD_COLUMNS}, {r('rsi', 'RSI_14')}
        FROM featured JOIN numbered USING (code, candle, trade_time, id, open, close, high, low)
        JOIN ema_10 USING ({KEY}) JOIN trend USING ({KEY}) JOIN strength USING ({KEY})""",
    HOUR_BARS, FEATURES, NUMBERED, EMA_10, *MACD_CTES, *RSI_CTES,
)

# --- returns -----------------------------------------------------------------------

RETURNED = f"returned AS (SELECT *, ln(close / lag(close) {W}) AS log_returns FROM bars)"
GROWTH = f"CASE WHEN log_returns IS NOT NULL THEN exp(sum(log_returns) {W}) END"
add("log_returns", f"SELECT {ROW}, {rounded('log_returns')} FROM returned", MONTH_BARS, RETURNED)
add("growth", f"SELECT {ROW}, {rounded('log_returns')}, {r(GROWTH, 'cusum_rewards')} FROM returned", MONTH_BARS, RETURNED)
DAILY = """daily AS (SELECT * FROM bars QUALIFY row_number()
  OVER (PARTITION BY code, candle, CAST(trade_time AS DATE) ORDER BY trade_time, id) = 1)"""
add("first_per_date", f"SELECT {ROW}, {rounded('open', 'close')} FROM daily", HOUR_BARS, DAILY)
add(
    "daily_returns",
    f"SELECT {SERIES}, {rounded('close', 'log_returns')}, {r(GROWTH, 'cusum_rewards')} FROM returned",
    HOUR_BARS, DAILY, RETURNED.replace("FROM bars", "FROM daily"),
)
YEARS = {
    "rows": "(count(*) - 1) / 365.25::DOUBLE",
    "calendar": "date_diff('day', min(trade_time), max(trade_time)) / 365.25::DOUBLE",
}


def totals(basis: str) -> str:
    return f"""totals AS (SELECT code, candle, bars, exp(total / years) - 1 AS annual, dev * sqrt(years) AS risk
  FROM (SELECT code, candle, count(*) AS bars, sum(log_returns) AS total, stddev_samp(log_returns) AS dev,
               {YEARS[basis]} AS years FROM returned GROUP BY 1, 2))"""


for _risk, _growth, _bars, _basis in (
    ("risk_metrics", "growth_rates", HOUR_BARS, "rows"),
    ("risk_by_calendar", "growth_by_calendar", MONTH_BARS, "calendar"),
):
    add(
        _risk,
        f"""SELECT code, candle, bars, {r('annual * 100', 'annualized_return')}, {r('risk * 100', 'annualized_risk')},
            {r('(annual - 0.02) / risk', 'sharpe_ratio')} FROM totals""",
        _bars, RETURNED, totals(_basis),
    )
    add(_growth, f"SELECT code, candle, {r('annual * 100', 'cagr')} FROM totals", _bars, RETURNED, totals(_basis))

# --- strategies and trades ---------------------------------------------------------

MARKED = """marked AS (SELECT *, CASE WHEN (close - open) / nullif(open, 0) < -0.02 THEN 1
  WHEN (close - open) / nullif(open, 0) > 0.02 THEN -1 ELSE 0 END AS sig FROM bars)"""


def level(factor: float, name: str) -> str:
    return f"CASE WHEN sig <> 0 THEN open * (1 + {factor}::DOUBLE) ELSE 0.0 END AS {name}"


SHIFTED = f"shifted AS (SELECT * REPLACE (coalesce(lag(sig) {W}, 0) AS sig) FROM marked)"


def trade_ctes(source: str) -> tuple[str, ...]:
    return (
        f"placed AS (SELECT *, row_number() {W} - 1 AS i, {level(0.05, 'tp')}, {level(-0.05, 'sl')} FROM {source})",
        """hits AS (SELECT a.code, a.candle, a.i, arg_min(b.i, b.i) AS ci, arg_min(b.trade_time, b.i) AS ct,
          arg_min(CASE WHEN b.high >= a.tp THEN b.high ELSE b.low END, b.i) AS cp
          FROM placed a JOIN placed b ON a.code = b.code AND a.candle = b.candle AND b.i > a.i AND b.sig = -1
           AND (b.high >= a.tp OR b.low <= a.sl) WHERE a.sig = 1 GROUP BY 1, 2, 3)""",
        "ends AS (SELECT code, candle, max(i) AS ei, arg_max(trade_time, i) AS et, arg_max(close, i) AS ep FROM placed GROUP BY 1, 2)",
        """traded AS (SELECT p.code, p.candle, p.i AS start_index, p.trade_time AS start_time, p.open AS start_price,
          p.tp, p.sl, ci, ct, cp, ei, et, ep, ci IS NOT NULL AS hit
          FROM placed p LEFT JOIN hits h USING (code, candle, i) JOIN ends e ON p.code = e.code AND p.candle = e.candle
          WHERE p.sig = 1)""",
    )


def trade_rows(index: str, time: str, price: str) -> str:
    return f"""SELECT code, candle, start_index, {index} AS close_index, start_time, {time} AS end_time,
  round(nullif(start_price, 0), 4) AS start_price, round(nullif(tp, 0), 4) AS "TP", round(nullif(sl, 0), 4) AS "SL",
  round(nullif({price}, 0), 4) AS close_price, round(nullif({price} - start_price, 0), 4) AS total_return,
  round(nullif(({price} - start_price) / start_price, 0), 4) AS total_return_rate,
  CASE WHEN hit THEN 'close' ELSE 'open' END AS status FROM traded"""


CLOSED_ROWS = trade_rows("coalesce(ci, ei)", "coalesce(ct, et)", "coalesce(cp, ep)")

add(
    "signal_levels",
    f"SELECT {ROW}, CAST(sig AS BIGINT) AS SIGNAL, round(tp, 4) AS TP, round(sl, 4) AS SL "
    f"FROM (SELECT *, {level(0.05, 'tp')}, {level(-0.05, 'sl')} FROM marked)",
    MONTH_BARS, MARKED,
)
add(
    "shifted_signals",
    f"SELECT {ROW}, CAST(sig AS BIGINT) AS SIGNAL, {r(f'coalesce({mean('close', 5)}, 0)', 'MA_5')} FROM shifted",
    MONTH_BARS, MARKED, SHIFTED,
)
NEWEST = "row_number() OVER (PARTITION BY code, candle ORDER BY trade_time DESC, id DESC)"
LAST_SIGNAL = """SELECT code, candle, CAST(coalesce(arg_max(sig, trade_time) FILTER (sig <> 0), 0) AS BIGINT) AS last_signal
  FROM (SELECT * FROM {source} QUALIFY {newest} <= 5) GROUP BY 1, 2"""
add("last_signals", LAST_SIGNAL.format(source="marked", newest=NEWEST), MONTH_BARS, MARKED)
add("last_bars", f"SELECT {ROW}, {rounded('close')} FROM bars QUALIFY {NEWEST} <= 5", MONTH_BARS)
add("open_trades", trade_rows("ci", "ct", "cp"), MONTH_BARS, MARKED, *trade_ctes("marked"))
add("backtest_trades", CLOSED_ROWS, MONTH_BARS, MARKED, SHIFTED, *trade_ctes("shifted"))
ORACLES["trade_csv"] = ORACLES["backtest_trades"].replace("SELECT code, candle, start_index, coalesce", "SELECT start_index, coalesce")
SUMMED = """summed AS (SELECT code, candle, count(*) AS trades, count(*) FILTER (hit) AS closed,
  count(*) FILTER (coalesce(cp, ep) > start_price) AS wins, sum(nullif(coalesce(cp, ep) - start_price, 0)) AS total_return,
  avg(nullif((coalesce(cp, ep) - start_price) / start_price, 0)) AS total_return_rate FROM traded GROUP BY 1, 2)"""
SPANS = "spans AS (SELECT code, candle, min(trade_time) AS start_time, max(trade_time) AS end_time FROM shifted GROUP BY 1, 2)"
LAST = f"lasts AS ({LAST_SIGNAL.format(source='shifted', newest=NEWEST)})"
add(
    "backtest_summaries",
    """SELECT code, candle, start_time, end_time, coalesce(trades, 0) AS trades, coalesce(closed, 0) AS closed,
       coalesce(wins, 0) AS wins, round(coalesce(total_return, 0), 4) AS total_return,
       round(coalesce(total_return_rate, 0), 4) AS total_return_rate, last_signal
       FROM spans LEFT JOIN summed USING (code, candle) LEFT JOIN lasts USING (code, candle)""",
    MONTH_BARS, MARKED, SHIFTED, *trade_ctes("shifted"), SUMMED, SPANS, LAST,
)
DIGEST = """md5('{"candle":"' || candle || '","code":"' || code || '","end_time":"' || strftime(end_time, '%Y-%m-%d')
  || '","name":"turn","shift_signal":true,"start_time":"' || strftime(start_time, '%Y-%m-%d') || '"}') || '20240601123045'"""
add(
    "backtest_reports",
    f"""SELECT code, '0.05' AS profit_factor, round(coalesce(total_return, 0), 4) AS total_return,
        '/results/turn/' || code || '/trade_res_' || {DIGEST} || '.csv' AS trade_res,
        {DIGEST} || '2024-06-01 12:30:45 UTC' AS key_string, '{{"shift_signal":true}}' AS tester_params,
        TIMESTAMP '2024-06-01 12:30:45' AS completed_at, {uuid_of("(code || '/' || candle)")} AS task_event_id
        FROM spans LEFT JOIN summed USING (code, candle)""",
    MONTH_BARS, MARKED, SHIFTED, *trade_ctes("shifted"), SUMMED, SPANS,
)
add(
    "result_records",
    f"""SELECT {uuid_of("(code || '/' || candle)")} AS task_id, TRUE AS status, 'turn' AS strategy_name,
        '{{"shift_signal":true}}' AS tester_params, '{{"profit_factor":0.05,"loss_factor":-0.05}}' AS tpsl_parms,
        '2024-06-01 12:30:45' AS completed_at, last_signal AS last_data_signal
        FROM ({LAST_SIGNAL.format(source="marked", newest=NEWEST)})""",
    MONTH_BARS, MARKED,
)
add(
    "look_back",
    """SELECT l_quantity, days, CAST(CAST(first - to_days(CAST(days AS INTEGER)) AS DATE) AS VARCHAR) AS load_from
       FROM (SELECT round(l_quantity, 4) AS l_quantity, min(l_shipdate) AS first,
             CAST(CASE WHEN l_quantity <= 3 THEN 0 ELSE round_even((l_quantity - 3) * 2.5, 0) END AS BIGINT) AS days
             FROM lineitem GROUP BY l_quantity)""",
)
# All components keep every angle, so the reduced windows rank like the windows themselves.
add(
    "similar_windows",
    """SELECT s.code AS sample_code, w.candle, w.code, strftime(w.trade_time, '%Y-%m-%dT00:00:00Z') AS end_time,
       round(list_dot_product(w.v, s.v) / sqrt(list_dot_product(w.v, w.v)) / sqrt(list_dot_product(s.v, s.v)), 4) AS similarity
       FROM windows w, (SELECT * FROM windows ORDER BY code, trade_time DESC LIMIT 1) s
       WHERE w.code <> s.code OR w.trade_time <> s.trade_time
       ORDER BY list_dot_product(w.v, s.v) / sqrt(list_dot_product(w.v, w.v)) / sqrt(list_dot_product(s.v, s.v)) DESC,
                w.code, w.trade_time LIMIT 100""",
    MONTH_BARS,
    f"""windows AS (SELECT code, candle, trade_time, list_transform(prices, lambda p: p / list_avg(prices) - 1) AS v
        FROM (SELECT *, list(close) OVER (PARTITION BY code, candle ORDER BY trade_time, id ROWS 23 PRECEDING) AS prices FROM bars)
        WHERE len(prices) = 24)""",
)

# --- merges and stored tables --------------------------------------------------------

OLD, NEW = month_bars("old_bars", "l_linestatus = 'O'"), month_bars("new_bars", "l_linestatus = 'F'")
MERGED = """merged AS (SELECT * FROM new_bars UNION ALL SELECT * FROM old_bars o WHERE NOT EXISTS
  (SELECT 1 FROM new_bars n WHERE n.code = o.code AND n.candle = o.candle AND n.trade_time = o.trade_time))"""
BAR_ROW = f"{ROW}, {OHLC}, volume"
for _name in ("compact_bars", "stored_bars", "stream_bars"):
    add(_name, f"SELECT {BAR_ROW} FROM merged", OLD, NEW, MERGED)
DATASET = "code || '_' || candle || '_' || strftime(min(trade_time), '%Y-%m-%d') || '_' || strftime(max(trade_time), '%Y-%m-%d') || '.parquet'"
add(
    "stored_datasets",
    f"""SELECT code, candle, strftime(min(trade_time), '%Y-%m-%d') AS start_date, strftime(max(trade_time), '%Y-%m-%d') AS end_date,
        {DATASET} AS name, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume, round(min(low), 4) AS low, round(max(high), 4) AS high
        FROM merged GROUP BY code, candle""",
    OLD, NEW, MERGED,
)
add(
    "merge_pairs",
    f"SELECT {BAR_ROW} FROM merged WHERE code IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0)",
    OLD, NEW, MERGED,
)
add(
    "multi_part_pairs",
    "SELECT code, candle, count(DISTINCT year(trade_time)) AS datasets FROM bars GROUP BY 1, 2 HAVING count(DISTINCT year(trade_time)) > 1",
    MONTH_BARS,
)
add("dataset_ranges", f"SELECT {DATASET} AS name FROM bars GROUP BY code, candle", MONTH_BARS)
add(
    "changed_columns",
    f"SELECT {ROW}, {rounded('close', 'high', 'low')}, volume AS shares FROM bars",
    MONTH_BARS,
)
_UPSERT = """SELECT coalesce(c_custkey, o_custkey + 1000000) AS id, 'k' || coalesce(c_custkey, o_custkey) AS key_string,
  coalesce(o_orderpriority, c_mktsegment) AS strategy_parms,
  CAST(coalesce(o_totalprice, c_acctbal) AS VARCHAR) AS summary,
  CASE WHEN c_custkey IS NOT NULL THEN TIMESTAMP '2020-01-01' ELSE o_orderdate END AS created_at,
  coalesce(o_orderdate, TIMESTAMP '2020-01-01') AS updated_at
  FROM customer FULL JOIN (SELECT * FROM orders QUALIFY row_number()
    OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON c_custkey = o_custkey"""
add("upsert_results", _UPSERT)
add("stored_results", _UPSERT)
add(
    "partial_update",
    """SELECT o_orderkey AS id, CASE WHEN returned THEN 'failed' ELSE o_orderstatus END AS status,
       coalesce(shipped, o_orderdate) AS updated_at, CASE WHEN returned THEN 'returned ' || n END AS error_message
       FROM orders LEFT JOIN (SELECT l_orderkey, max(l_returnflag) = 'R' AS returned, max(l_shipdate) AS shipped, count(*) AS n
       FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
add(
    "merged_metadata",
    """SELECT CAST(coalesce(c_custkey, s_suppkey) AS VARCHAR) AS key, coalesce(s_name, c_mktsegment) AS value
       FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""",
)
add(
    "merged_json",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN user_id ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       event_type AS t, 'k' AS first_key FROM events""",
)


def seeded(name: str, size: int) -> str:
    return f"""{name} AS (SELECT batch, '{{"code":"[' || string_agg(code, ', ' ORDER BY code)
    || ']","candle":"d1","start_time":"2025-01-01","end_time":"2025-12-31"}}' AS meta
  FROM (SELECT code, (row_number() OVER (ORDER BY code) - 1) // {size} AS batch
        FROM (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS code FROM supplier)) GROUP BY batch)"""


add(
    "seed_tasks",
    f"""SELECT {uuid_of("('seed-' || batch)")} AS id, 'pending' AS status, 'local_test' AS tester_name, '{{}}' AS tester_params,
        'sql_loader' AS data_provider_name, coalesce(again.meta, stored.meta) AS source_meta_data, '' AS tpsl_name,
        '{{}}' AS saver_params, 'manaual' AS trigger_type, 'test' AS triggered_by, 'preprocessing' AS event_name,
        'init' AS event_stage, FALSE AS used_process_pool, FALSE AS is_notify,
        CASE WHEN stored.meta IS NULL THEN TIMESTAMP '2024-06-01 12:30:45' ELSE TIMESTAMP '2024-01-01' END AS created_at,
        CASE WHEN again.meta IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01 12:30:45' END AS updated_at
        FROM stored FULL JOIN again USING (batch)""",
    seeded("stored", 55), seeded("again", 20),
)
add(
    "stamped_rows",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '2024-06-01 12:30:45' END AS created_at,
       TIMESTAMP '2024-06-01 12:30:45' AS updated_at FROM orders""",
)
add(
    "run_log",
    f"""SELECT {uuid_of('event_id')} AS task_id, event_type AS action, props AS args, ts AS start_time,
        ts + to_seconds(CAST(trunc(value) AS BIGINT)) AS end_time,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, trunc(value) AS seconds FROM events""",
)

# --- grouping, sorting, paging -------------------------------------------------------

add(
    "distinct_pairs",
    "SELECT DISTINCT event_type AS code, 'h1' AS candle FROM events UNION SELECT DISTINCT CAST(l_suppkey AS VARCHAR), 'mo' FROM lineitem",
)
add(
    "overall_dates",
    "SELECT CAST(CAST(min(trade_time) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(trade_time) AS DATE) AS VARCHAR) AS last FROM bars",
    MONTH_BARS,
)
add("bar_index", f"SELECT {ROW}, i AS position FROM numbered", MONTH_BARS, NUMBERED)
add(
    "batched_codes",
    """SELECT batch, count(*) AS codes, '[' || string_agg(code, ', ' ORDER BY code) || ']' AS code_list
       FROM (SELECT code, (row_number() OVER (ORDER BY code) - 1) // 10 AS batch
             FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS code FROM orders)) GROUP BY batch""",
)
_RESULTS = """results AS (SELECT o_orderkey AS id, o_orderpriority AS name, CAST(o_custkey AS VARCHAR) AS code,
  strftime(o_orderdate, '%Y-%m-%d') AS start_time, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_return FROM orders)"""
_SHOWN = "SELECT id, name, code, start_time, round(total_return, 4) AS total_return FROM results"
add(
    "results_by_profit",
    f"{_SHOWN} WHERE name = '1-URGENT' ORDER BY results.total_return DESC NULLS FIRST, id LIMIT 20 OFFSET 40",
    _RESULTS,
)
add("results_by_start", f"{_SHOWN} ORDER BY start_time NULLS LAST, id LIMIT 50 OFFSET 50", _RESULTS)
add("results_filtered", f"{_SHOWN} WHERE name = '3-MEDIUM'", _RESULTS)

# --- scalar functions ----------------------------------------------------------------

_ODD_NUMBERS = "list_extract(['0.0001', '1e+16', '1e-07', '5.0', '-0.0'], o_orderkey % 5 + 1)"
_HALF = "o_orderkey // 2 || CASE WHEN o_orderkey % 2 = 1 THEN '.5' ELSE '.0' END"
_KEY_JSON = f"""md5('{{"code":"' || o_custkey || '","factor":' || {_ODD_NUMBERS} || ',"half":' || {_HALF} || ',"n":' || o_orderkey
  || ',"name":"' || o_orderpriority || '"}}')"""
add(
    "result_keys",
    f"SELECT o_orderkey, {_KEY_JSON} AS digest, {_KEY_JSON} || strftime(o_orderdate, '%Y%m%d%H%M%S') AS file_key FROM orders",
)
_RESULT_JSON = """md5('{"candle":"d1","code":"' || code || '","end_time":"","name":"' || name || '","start_time":"' || start_time || '"}')"""
add(
    "result_files",
    f"""SELECT id, key AS file_key, '/out/' || name || '/' || code || '/trade_res_' || key || '.csv' AS trade_res,
        '/out/' || name || '/' || code || '/test_df_' || key || '.csv' AS test_df,
        '/out/' || name || '/' || code || '/chart/trade_res_' || key || '.svg' AS trade_chart,
        '/out/report_metadata.json' AS final_report FROM (SELECT *, {_RESULT_JSON} AS key FROM results)""",
    _RESULTS,
)
add("model_info", "SELECT id, code, 'd1' AS candle, start_time, '' AS end_time FROM results", _RESULTS)
add(
    "date_functions",
    """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS day_end,
       date_trunc('minute', ts) AS minute, CAST(date_trunc('day', ts) AS TIMESTAMP) AS midnight, CAST(NULL AS TIMESTAMP) AS no_midnight,
       strftime(ts, '%Y-%m-%dT00:00:00Z') AS rfc3339, strftime(ts, '%Y/%m/%d') AS slashed,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS short FROM events""",
)
add(
    "path_functions",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'lake' ELSE 'lake/' || event_type || '/' || event_id END AS bare,
       CASE WHEN event_type <> 'error' THEN 'lake' END AS bucket,
       CASE WHEN event_type <> 'error' THEN event_type || '/' || event_id END AS object_key FROM events""",
)
add(
    "code_lists",
    """SELECT event_id, CASE event_type WHEN 'click' THEN event_type || '|' || user_id WHEN 'view' THEN CAST(user_id AS VARCHAR)
       ELSE event_type END AS codes FROM events""",
)
add(
    "remapped_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'completed' END AS status FROM orders",
)
add("decoded_bytes", "SELECT event_id, CASE WHEN event_type <> 'error' THEN props END AS decoded FROM events")

# --- streams -----------------------------------------------------------------------

add(
    "stream_messages",
    f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN {uuid_of('user_id')} END AS task_id,
        CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN NULL WHEN 'error' THEN 'not JSON'
        WHEN 'purchase' THEN 'bad task_id' ELSE 'wrong fields' END AS problem FROM events""",
)
add(
    "stream_claims",
    f"""SELECT {uuid_of('c_custkey')} AS id, CASE WHEN c_acctbal < 0 THEN 'failed'
        WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'running' ELSE 'pending' END AS status,
        CASE WHEN c_acctbal >= 0 THEN (SELECT min(o_orderkey % 3) FROM orders WHERE o_custkey = c_custkey) END AS batch FROM customer""",
)
_STATUS = """SELECT o_custkey AS id, o_orderstatus AS status, o_orderdate AS updated_at, o_orderkey AS seq FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
add("stream_status", _STATUS)
# Of three batches: a message passes unless its task is still remembered. A task is forgotten when its message is older than twice
# the delay against the newest of the batches before.
add(
    "stream_first_messages",
    """WITH firsts AS (SELECT o_custkey, year(o_orderdate) AS y, min(o_orderdate) AS t FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1, 2),
     loads AS (SELECT CAST(o_custkey AS VARCHAR) AS task_id, CASE WHEN y < 1995 THEN 1 WHEN y <= 1996 THEN 2 ELSE 3 END AS b, max(t) AS t
       FROM firsts GROUP BY 1, 2),
     newest AS (SELECT b, max(max(t)) OVER (ORDER BY b) AS upto FROM loads GROUP BY b),
     e1 AS (SELECT task_id, t FROM loads WHERE b = 1),
     k1 AS (SELECT * FROM e1 WHERE t + INTERVAL 120 DAY > (SELECT upto FROM newest WHERE b = 1)),
     e2 AS (SELECT task_id, t FROM loads WHERE b = 2 AND task_id NOT IN (SELECT task_id FROM k1)),
     k2 AS (SELECT * FROM (FROM k1 UNION ALL FROM e2) WHERE t + INTERVAL 120 DAY > (SELECT upto FROM newest WHERE b = 2)),
     e3 AS (SELECT task_id, t FROM loads WHERE b = 3 AND task_id NOT IN (SELECT task_id FROM k2))
     SELECT task_id, strftime(t, '%Y-%m-%d') AS at FROM (FROM e1 UNION ALL FROM e2 UNION ALL FROM e3)""",
)
add("current_status", _STATUS)
add(
    "stream_features",
    f"SELECT {ROW}, {FEATURE_COLUMNS} FROM featured",
    """bars AS (SELECT event_id AS id, event_type AS code, 'tick' AS candle, ts AS trade_time, value AS open, k AS close,
       greatest(value, k) AS high, least(value, k) / 2 AS low
       FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) WHERE value IS NOT NULL AND k IS NOT NULL)""",
    FEATURES,
)
