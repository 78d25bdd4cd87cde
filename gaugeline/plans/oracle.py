"""The SQL twin of every registered query, for DuckDB over the same tables.

Written from the definitions, with window functions over whole points; the Spark side gets to the
same rows by other means. DuckDB notes: ``epoch_ms`` rounds, hence ``epoch_us // 1000``; ``max_by``
skips NULLs; float to int casts round, hence ``trunc``.
"""

from __future__ import annotations

from gaugeline.functions.times import DAY_MS as DAY
from gaugeline.functions.times import HOUR_MS as HOUR
from gaugeline.plans.queries import DATA_START, NOW
from gaugeline.plans.views import NEW_UPPER, RULE_ROWS

_READINGS = """readings AS (SELECT event_id AS seq, 'gw' || CAST(user_id % 10 AS VARCHAR) AS gateway_id,
  'ns' || CAST(user_id % 2 AS VARCHAR) AS namespace, event_type AS point_id,
  '/gw' || CAST(user_id % 10 AS VARCHAR) || '/' || event_type AS id, epoch_us(ts) // 1000 AS t, value AS v,
  CASE event_type WHEN 'error' THEN 'S#down' WHEN 'signup' THEN CASE WHEN value >= 35 THEN 'B#true' ELSE 'B#false' END
   ELSE 'F#' || CAST(value AS VARCHAR) END AS raw_v, 'good' AS s FROM events)"""


def _rules(name: str, new: bool = False) -> str:
    rows = ",".join(
        f"('{p}','{lower}','{NEW_UPPER[p] if new else upper}','{amp}','{sw}')"
        for p, lower, upper, amp, sw in RULE_ROWS
    )
    return f"""{name} AS (SELECT '/gw' || CAST(g AS VARCHAR) || '/' || p AS id,
  '/plant/gw' || CAST(g AS VARCHAR) || '/' || p AS uri, lower_s AS lowerbound, upper_s AS upperbound, amp,
  sw AS switch_default FROM range(10) AS gws(g) CROSS JOIN (VALUES {rows}) AS ps(p, lower_s, upper_s, amp, sw))"""


_JOINED = """joined AS (SELECT r.seq, r.gateway_id, r.namespace, r.point_id, r.t, r.v, r.raw_v, r.s,
  ru.id, ru.uri, ru.lowerbound, ru.upperbound, ru.amp, ru.switch_default
  FROM readings r LEFT JOIN rules ru ON r.id = ru.id)"""
_BOUND = "bound AS (SELECT * FROM joined WHERE id IS NOT NULL)"
_BASE = f"WITH {_READINGS}, {_rules('rules')}, {_JOINED}, {_BOUND}"
_UNIQUE = """firsts AS (SELECT id, uri, t, v FROM
  (SELECT *, row_number() OVER (PARTITION BY id, t ORDER BY seq) AS rn FROM bound) WHERE rn = 1)"""

# JVM string hash of ASCII text, then the salted key of (uri, t).
_HASH = """list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(uri, ''),
  lambda c: CAST(ascii(c) AS BIGINT))), lambda a, x: (a * 31 + x) % 4294967296)"""
_SIGNED = f"(CASE WHEN {_HASH} >= 2147483648 THEN {_HASH} - 4294967296 ELSE {_HASH} END)"
_SALT = f"CAST(abs({_SIGNED}) % 100 AS INTEGER)"
_KEY = f"lpad(CAST({_SALT} AS VARCHAR), 2, '0') || uri || left(CAST(t AS VARCHAR), length(CAST(t AS VARCHAR)) - 4)"

_FLAGS = {
    "limit": "(CAST(lowerbound AS DOUBLE) > v OR v > CAST(upperbound AS DOUBLE))",
    "switch": "(CAST(trunc(v) AS INTEGER) <> CAST(switch_default AS INTEGER))",
    "cumulative": "(prev IS NOT NULL AND v < prev)",
    "amplitude": """(CASE WHEN prev IS NULL THEN false WHEN prev = 0 THEN true
      ELSE NOT ((v - prev) / prev <= CAST(amp AS DOUBLE) AND (v - prev) / prev >= -CAST(amp AS DOUBLE)) END)""",
}
_SHOWS = {
    "limit": "upperbound AS upper_bound, lowerbound AS lower_bound",
    "switch": "switch_default",
    "cumulative": "prev AS previous_value",
    "amplitude": "prev AS previous_value",
}


def _judged(name: str, out: str = "j", rules: str = "rules") -> str:
    """CTEs that end in ``out``: readings with flag, run start, and the end on the last row of a run."""
    return f"""{out}_a AS (SELECT r.seq, r.t, r.v, ru.*, row_number() OVER (PARTITION BY ru.id, r.t ORDER BY r.seq) AS rn
   FROM readings r JOIN {rules} ru ON r.id = ru.id),
 {out}_b AS (SELECT *, lag(v) OVER w AS prev, lead(t) OVER w AS nxt FROM {out}_a WHERE rn = 1
   WINDOW w AS (PARTITION BY id ORDER BY t)),
 {out}_c AS (SELECT *, {_FLAGS[name]} AS flag FROM {out}_b),
 {out}_d AS (SELECT *, SUM(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY t
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM {out}_c),
 {out} AS (SELECT *, CASE WHEN flag THEN MIN(CASE WHEN flag THEN t END) OVER (PARTITION BY id, isl) END AS run_start,
   flag AND t = MAX(CASE WHEN flag THEN t END) OVER (PARTITION BY id, isl) AS is_last FROM {out}_d)"""


def _range_rows(name: str, source: str = "j") -> str:
    return f"""SELECT uri AS node_uri, t AS last_abnormal_time, '{name}' AS abnormal_type,
  run_start AS abnormal_start_time, nxt AS abnormal_end_time FROM {source} WHERE is_last"""


def _ranges(name: str) -> str:
    return f"WITH {_READINGS}, {_rules('rules')}, {_judged(name)} {_range_rows(name)}"


def _points(name: str) -> str:
    return f"""WITH {_READINGS}, {_rules('rules')}, {_judged(name)}
 SELECT uri AS node_uri, t AS time, v AS value, '{name}' AS abnormal_type, {_SHOWS[name]} FROM j WHERE flag"""


def _annotated(name: str) -> str:
    return f"""WITH {_READINGS}, {_rules('rules')}, {_judged(name)}
 SELECT id, uri, t, v, prev AS previous_value, flag AS abnormal, COALESCE(run_start, 0) AS exception_start_time,
  COALESCE(CASE WHEN is_last THEN nxt END, 0) AS exception_end_time FROM j"""


_BOTH_RULES = (
    f"WITH {_READINGS}, {_rules('rules')}, {_rules('new_rules', True)}, {_judged('limit', 'o')}, "
    f"{_judged('limit', 'n', 'new_rules')}"
)
_CHANGES = f"""{_BOTH_RULES}, old_r AS ({_range_rows('limit', 'o')}), new_r AS ({_range_rows('limit', 'n')})
 SELECT CAST(CASE WHEN o.node_uri IS NULL THEN 1 WHEN n.node_uri IS NULL THEN -1 ELSE 2 END AS INTEGER) AS op,
  COALESCE(n.node_uri, o.node_uri) AS node_uri, COALESCE(n.last_abnormal_time, o.last_abnormal_time) AS last_abnormal_time,
  'limit' AS abnormal_type,
  CASE WHEN n.node_uri IS NULL THEN o.abnormal_start_time ELSE n.abnormal_start_time END AS abnormal_start_time,
  CASE WHEN n.node_uri IS NULL THEN o.abnormal_end_time ELSE n.abnormal_end_time END AS abnormal_end_time
 FROM old_r o FULL JOIN new_r n ON o.node_uri = n.node_uri AND o.last_abnormal_time = n.last_abnormal_time
 WHERE o.node_uri IS NULL OR n.node_uri IS NULL OR o.abnormal_start_time IS DISTINCT FROM n.abnormal_start_time
  OR o.abnormal_end_time IS DISTINCT FROM n.abnormal_end_time"""
_POINT_CHANGES = f"""{_BOTH_RULES}, old_p AS (SELECT * FROM o WHERE flag), new_p AS (SELECT * FROM n WHERE flag)
 SELECT CAST(CASE WHEN a.uri IS NULL THEN 1 WHEN b.uri IS NULL THEN -1 ELSE 2 END AS INTEGER) AS op,
  COALESCE(b.uri, a.uri) AS node_uri, COALESCE(b.t, a.t) AS time, COALESCE(b.v, a.v) AS value, 'limit' AS abnormal_type,
  COALESCE(b.upperbound, a.upperbound) AS upper_bound, COALESCE(b.lowerbound, a.lowerbound) AS lower_bound
 FROM old_p a FULL JOIN new_p b ON a.uri = b.uri AND a.t = b.t
 WHERE a.uri IS NULL OR b.uri IS NULL OR a.upperbound <> b.upperbound OR a.lowerbound <> b.lowerbound"""


def _last(source: str, keys: str, step: int, columns: str = "v", extra: str = "") -> str:
    """Last row per key and tumbling window; ``t`` is the window's end."""
    return f"""SELECT {keys}, {columns}, (t // {step} + 1) * {step} AS t FROM
 (SELECT *, row_number() OVER (PARTITION BY {keys}, t // {step} ORDER BY t DESC, seq DESC) AS rn{extra} FROM {source})
 WHERE rn = 1"""


def _avg(step: int) -> str:
    return f"""{_BASE} SELECT uri, round(avg(v), 9) AS v, (t // {step} + 1) * {step} AS t
 FROM bound GROUP BY uri, t // {step}"""


def _sliding(keys: str, window: int, slide: int) -> str:
    n = window // slide
    on_keys = ", ".join(f"r.{k}" for k in keys.split(", "))
    return f"""SELECT {keys}, window_start, v AS last_v, t AS last_t FROM
 (SELECT {on_keys}, r.v, r.t, (r.t // {slide} - k.i) * {slide} AS window_start,
   row_number() OVER (PARTITION BY {on_keys}, r.t // {slide} - k.i ORDER BY r.t DESC, r.seq DESC) AS rn
  FROM readings r, range({n}) AS k(i)) WHERE rn = 1"""


_DAILY = f"{_BASE}, daily AS ({_last('bound', 'uri', DAY)}), keyed AS (SELECT *, {_KEY} AS row_key FROM daily)"
_HOURLY = f"{_BASE}, hourly AS ({_last('bound', 'uri', HOUR)})"


def _ms(expression: str) -> str:
    return f"(epoch_us({expression}) // 1000)"


_TS = "make_timestamp(t * 1000)"
_KIND = "(seq % 12)"
_WRITTEN = f"""CASE {_KIND} WHEN 0 THEN CAST(t AS VARCHAR) || 'ms' WHEN 1 THEN strftime({_TS}, '%Y/%m/%d')
  WHEN 2 THEN strftime({_TS}, '%Y/%m/%d %H:%M') WHEN 3 THEN strftime({_TS}, '%Y/%m/%d-%H:%M')
  WHEN 4 THEN strftime({_TS}, '%Y/%m/%d-%H:%M:%S') WHEN 5 THEN strftime({_TS}, '%Y-%m-%d')
  WHEN 6 THEN strftime({_TS}, '%Y-%m-%d %H:%M:%S') WHEN 7 THEN CAST(t // 1000 AS VARCHAR) WHEN 8 THEN CAST(t AS VARCHAR)
  WHEN 9 THEN CAST(seq % 50 + 1 AS VARCHAR) || 'm-ago' WHEN 10 THEN 'now' ELSE strftime({_TS}, '%Y/%m/%d') || ' soon' END"""


def _cut(step: int) -> str:
    return f"t - t % {step}"


_WRITTEN_MS = f"""CASE {_KIND} WHEN 0 THEN t WHEN 1 THEN {_cut(DAY)} WHEN 2 THEN {_cut(60000)} WHEN 3 THEN {_cut(60000)}
  WHEN 4 THEN {_cut(1000)} WHEN 5 THEN {_cut(DAY)} WHEN 6 THEN {_cut(1000)} WHEN 7 THEN {_cut(1000)} WHEN 8 THEN t
  WHEN 9 THEN {NOW} - (seq % 50 + 1) * 60000 WHEN 10 THEN {NOW} END"""


def _from(base: str, step: int) -> str:
    """Interval of ``step`` ms counted from the top of ``base``."""
    top = _ms(f"date_trunc('{base}', {_TS})")
    return f"{top} + ((t - {top}) // {step}) * {step}"


def _rollup(source: str, intervals: dict[str, str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS every, {start} AS interval_start, v FROM {source}" for name, start in intervals.items()
    )
    return f"""SELECT every, interval_start, COUNT(v) AS n, round(SUM(v), 4) AS sum_v FROM ({parts})
 GROUP BY every, interval_start"""


_ORDERS = f"orders_t AS (SELECT {_ms('o_orderdate')} AS t, o_totalprice AS v FROM orders)"
_MONTH = f"month({_TS})"
_LIMITS = "limits AS (SELECT * FROM (VALUES ('ns0', 100, 5)) AS l(namespace, upper_bound, lower_bound))"
_MOVING = f"""SELECT id, uri, t, v, round(avg(v) OVER (PARTITION BY id ORDER BY t
  RANGE BETWEEN {6 * HOUR} PRECEDING AND CURRENT ROW), 9) AS moving_avg FROM firsts"""
_DIFF = f"""{_BASE}, {_UNIQUE}, n AS (SELECT *, lag(v) OVER w AS b, lead(v) OVER w AS a
  FROM firsts WINDOW w AS (PARTITION BY id ORDER BY t))
 SELECT id, uri, t, v, 'later' AS side, round(a - v, 6) AS diff FROM n WHERE a IS NOT NULL UNION ALL
 SELECT id, uri, t, v, 'earlier' AS side, round(v - b, 6) AS diff FROM n WHERE b IS NOT NULL"""


def _dec(column: str) -> str:
    """A double as a whole number of millionths."""
    return f"CAST(CAST({column} AS DECIMAL(18,6)) * 1000000 AS HUGEINT)"


_QUOTIENT = f"""CAST((2 * {_dec('l_extendedprice')} * 10000000000 + {_dec('l_quantity * 7')})
  // (2 * {_dec('l_quantity * 7')}) AS DOUBLE) / 10000000000"""

# Slice of the time of arrival: every third reading comes 8 hours late, every third 16.
_SLICE = f"""least(2, greatest(0, floor((t + (seq % 3) * {8 * HOUR} - {DATA_START}) / {(NOW - DATA_START) // 3}.0)))"""
_RUNNING = f"""WITH {_READINGS}, placed AS (SELECT *, t - t % {HOUR} AS window_start, row_number() OVER (
   PARTITION BY id, t - t % {HOUR} ORDER BY t DESC, {_SLICE} DESC, seq DESC) AS rn FROM readings),
 latest AS (SELECT max(t) AS latest FROM readings)
 SELECT id, window_start, round(sum(v), 4) AS sum_v, count(*) AS n, round(avg(v), 9) AS avg_v,
  max(CASE WHEN rn = 1 THEN v END) AS last_v, window_start + {HOUR} <= latest - {DAY} AS closed
 FROM placed, latest GROUP BY id, window_start, latest"""
_PASSED = f"""SELECT * FROM (WITH {_READINGS} {_sliding('point_id', HOUR, 1200000)})
 WHERE window_start + {HOUR} <= (SELECT max(epoch_us(ts) // 1000) FROM events) - {HOUR}"""

ORACLE: dict[str, str] = {
    "stream_running_windows": _RUNNING,
    "stream_running_windows_cleaned": _RUNNING,
    "stream_sliding_panes": _PASSED,
    "src_readings_stream": f"WITH {_READINGS} SELECT seq, id, t, v FROM readings",
    "src_parse_array": f"""WITH {_READINGS}
 SELECT gateway_id, namespace, point_id, t, s, raw_v AS v FROM readings UNION ALL
 SELECT gateway_id, namespace, point_id, t + 1 AS t, s, raw_v AS v FROM readings""",
    "src_rejects": """SELECT event_id AS seq, CASE WHEN event_id % 5 = 2 THEN 'unreadable' ELSE 'value' END AS why
 FROM events WHERE event_id % 5 > 1""",
    "src_parse_object": f"""WITH {_READINGS} SELECT gateway_id, CAST(seq AS VARCHAR) AS "internalSeriesId", namespace,
  point_id, CAST(NULL AS VARCHAR) AS regions, CAST(t AS VARCHAR) AS t, raw_v AS v, s FROM readings""",
    "src_rules": """SELECT '/part/' || CAST(p_partkey // 2 AS VARCHAR) AS id,
  '/plant/part/' || CAST(max(p_partkey) AS VARCHAR) AS uri, CAST(arg_max(p_retailprice, p_partkey) AS VARCHAR) AS upperbound,
  CAST(arg_max(p_size, p_partkey) AS VARCHAR) AS lowerbound FROM part GROUP BY p_partkey // 2""",
    "src_keyed_get": f"{_DAILY} SELECT row_key, v, t FROM keyed WHERE row_key = '79/plant/gw1/click170415360'",
    "src_keyed_scan": f"""{_DAILY} SELECT row_key, v FROM keyed
 WHERE row_key >= '20' AND row_key < '70' AND v > 10""",
    "src_versions": f"""WITH {_READINGS} SELECT id, t, seq, v FROM
 (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, seq DESC) AS rn FROM readings
  WHERE t >= {DATA_START + DAY} AND t < {NOW}) WHERE rn <= 3""",
    "sink_keyed_json": f"""WITH {_READINGS} SELECT point_id AS key, '{{"gatewayId":"' || gateway_id || '","namespace":"' ||
  namespace || '","pointId":"' || point_id || '","v":' || CAST(v AS VARCHAR) || ',"s":"' || s || '","t":' ||
  CAST(t AS VARCHAR) || '}}' AS value FROM readings""",
    "sink_keyed_table": f"""{_BASE}, averages AS (SELECT uri, avg(v) AS v, (t // {DAY} + 1) * {DAY} AS t
   FROM bound GROUP BY uri, t // {DAY}),
 lasts AS ({_last('(SELECT * FROM bound WHERE v >= 20)', 'uri', DAY)}),
 puts AS (SELECT uri, t, COALESCE(l.v, a.v) AS v FROM averages a LEFT JOIN lasts l USING (uri, t))
 SELECT {_SALT} AS salt, {_KEY} AS row_key, uri, round(v, 9) AS v, t FROM puts""",
    "sink_year_routed": f"""WITH o AS (SELECT '/orders/' || left(o_orderpriority, 1) AS uri, {_ms('o_orderdate')} AS t,
   o_totalprice AS v, o_orderkey AS seq FROM orders), d AS ({_last('o', 'uri', DAY)})
 SELECT 'minute_' || CAST(year({_TS}) AS VARCHAR) AS table_name, {_KEY} AS row_key, v, t FROM d""",
    "sink_once_per_batch": f"WITH {_READINGS} SELECT seq, id, t, v FROM readings",
    "sink_foreach": f"WITH {_READINGS} SELECT seq, id, t, v FROM readings",
    "keyed_delete": f"""{_DAILY} SELECT row_key, uri, v, CASE WHEN v > 100 THEN NULL ELSE t END AS t
 FROM keyed WHERE v >= 5""",
    "sink_abnormal": f"""WITH {_READINGS}, {_rules('rules')}, {_judged('limit')}
 SELECT split_part(id, '/', 3) AS name, COUNT(*) AS n, 'normal' AS output FROM j WHERE NOT flag GROUP BY 1
 UNION ALL SELECT uri, COUNT(*), 'points' FROM j WHERE flag GROUP BY uri
 UNION ALL SELECT uri, COUNT(*), 'ranges' FROM j WHERE is_last GROUP BY uri""",
    "sink_abnormal_rows": f"""WITH {_READINGS}, {_rules('rules')}, {_judged('limit')}
 SELECT split_part(id, '/', 3) || '/' || split_part(id, '/', 2) AS name, t, CAST(0 AS BIGINT) AS start,
  CAST(0 AS BIGINT) AS stop, 'normal' AS output FROM j WHERE NOT flag
 UNION ALL SELECT uri, t, 0, 0, 'points' FROM j WHERE flag
 UNION ALL SELECT uri, t, run_start, COALESCE(nxt, 0), 'ranges' FROM j WHERE is_last""",
    "decode_value": f"""WITH {_READINGS} SELECT seq, CASE WHEN raw_v = 'B#true' THEN 1.0::DOUBLE
  WHEN raw_v LIKE 'B#%' THEN 0.0::DOUBLE WHEN raw_v LIKE 'F#%' THEN v END AS value FROM readings""",
    "drop_string_values": f"WITH {_READINGS} SELECT seq, raw_v FROM readings WHERE raw_v NOT LIKE '%S#%'",
    "only_float_values": f"WITH {_READINGS} SELECT seq, raw_v FROM readings WHERE left(raw_v, 1) = 'F'",
    "strip_prefix": f"WITH {_READINGS} SELECT seq, substr(raw_v, 3) AS body FROM readings",
    "event_time": f"""WITH {_READINGS} SELECT seq, t AS event_ms, strftime({_TS}, '%Y-%m-%d %H:%M:%S') AS text,
  strftime({_TS}, '%Y-%m-%d %H:%M') AS minute, strftime({_TS}, '%Y-%m-%d') AS day FROM readings""",
    "ingest_time": "SELECT event_id AS seq, true AS after_reading FROM events",
    "split_bound": f"""{_BASE} SELECT seq, CASE WHEN id IS NULL THEN 'unbound' ELSE 'bound' END AS part FROM joined""",
    "point_filter": f"""WITH {_READINGS} SELECT seq, point_id, v FROM readings
 WHERE point_id = 'click' OR point_id = 'purchase'""",
    "limit_check": f"""{_BASE}, c AS (SELECT seq,
   CAST(lowerbound AS DOUBLE) < v AND v < CAST(upperbound AS DOUBLE) AS status FROM joined)
 SELECT seq, status, CASE WHEN NOT status THEN 'abnormal' ELSE 'normal' END AS route FROM c""",
    "limit_outside": f"{_BASE} SELECT seq, {_FLAGS['limit']} AS outside FROM bound",
    "switch_check": f"{_BASE} SELECT seq, NOT {_FLAGS['switch']} AS is_ok FROM bound",
    "row_key": f"{_HOURLY} SELECT uri, t, {_SALT} AS salt, {_KEY} AS row_key FROM hourly",
    "row_key_md5": f"{_HOURLY} SELECT uri, t, md5(uri) || CAST(t AS VARCHAR) AS row_key FROM hourly",
    "row_key_time": f"{_HOURLY} SELECT uri, t, t AS key_time FROM hourly",
    "project_rename": f"{_BASE} SELECT seq, uri AS node_uri, t AS timestamp, v AS value FROM bound",
    "join_rules": f"{_BASE} SELECT seq, id, uri, upperbound, lowerbound, amp, switch_default FROM joined",
    "join_limits": f"""WITH {_READINGS}, {_LIMITS} SELECT seq, r.namespace, upper_bound, lower_bound,
  (lower_bound < v AND v < upper_bound) AS status FROM readings r JOIN limits l ON r.namespace = l.namespace""",
    "ring_ratio": f"""{_BASE}, h AS ({_last('bound', 'id', HOUR)}),
 p AS (SELECT b.id, a.v, a.t, b.v AS v2, CAST(round(CAST(CAST(CASE WHEN b.v <> 0 THEN (a.v - b.v) / b.v END
   AS VARCHAR) AS DECIMAL(38,18)), 3) AS DOUBLE) AS ring_ratio
  FROM h b LEFT JOIN h a ON a.id = b.id AND a.t = b.t + {HOUR})
 SELECT id, v, t, v2, ring_ratio, ring_ratio BETWEEN -0.1::DOUBLE AND 0.1::DOUBLE AS is_ok FROM p""",
    "minute_last": f"{_BASE} {_last('bound', 'uri', 60000)}",
    "hour_last": f"{_BASE} {_last('bound', 'uri', HOUR)}",
    "minute_avg": _avg(60000),
    "hour_avg": _avg(HOUR),
    "minute_last_ingest": f"""{_BASE}, stamped AS (SELECT *, t + seq % 1000 AS st FROM bound),
 h AS ({_last('stamped', 'uri', HOUR, 'v, first_st AS st',
               f', min(st) OVER (PARTITION BY uri, t // {HOUR}) AS first_st')})
 SELECT {_KEY} AS row_key, v, t, st FROM h""",
    "sliding_last_point": f"WITH {_READINGS} {_sliding('id', HOUR, 600000)}",
    "sliding_last_point_ns": f"WITH {_READINGS} {_sliding('point_id, namespace', HOUR, 1200000)}",
    "tumbling_last_point": f"""WITH {_READINGS} SELECT point_id, (t // 60000) * 60000 AS window_start,
  (t // 60000 + 1) * 60000 AS window_end, v AS last_v, t AS last_t, strftime({_TS}, '%Y-%m-%d') AS day FROM
 (SELECT *, row_number() OVER (PARTITION BY point_id, t // 60000 ORDER BY t DESC, seq DESC) AS rn
  FROM readings WHERE raw_v LIKE 'F%') WHERE rn = 1""",
    "minute_running": f"""WITH {_READINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY id, t // {HOUR}
   ORDER BY t DESC, seq DESC) AS rn FROM readings)
 SELECT id, (t // {HOUR}) * {HOUR} AS window_start, round(SUM(v), 6) AS sum_v, round(AVG(v), 9) AS avg_v,
  MAX(CASE WHEN rn = 1 THEN v END) AS last_v FROM r GROUP BY id, t // {HOUR}""",
    "lag_windowed": f"""WITH {_READINGS}, w AS ({_sliding('point_id', HOUR, 600000)})
 SELECT *, lag(last_v) OVER (PARTITION BY point_id ORDER BY window_start) AS previous_last_v FROM w""",
    "previous_reading": f"""{_BASE}, {_UNIQUE} SELECT id, uri, t, v, COALESCE(lag(t) OVER w, 0) AS previous_t,
  COALESCE(lag(v) OVER w, 0.0::DOUBLE) AS previous_v, CAST(0 AS BIGINT) AS next_t, 0.0::DOUBLE AS next_v
 FROM firsts WINDOW w AS (PARTITION BY id ORDER BY t)""",
    "neighbour_diff": _DIFF,
    "neighbour_diff_dense": _DIFF,
    "moving_avg": f"{_BASE}, {_UNIQUE} {_MOVING}",
    "moving_sum_week": f"""{_BASE}, {_UNIQUE} SELECT id, uri, t, v, round(sum(v) OVER w, 4) AS sum_v, count(*) OVER w AS n
 FROM firsts WINDOW w AS (PARTITION BY id ORDER BY t RANGE BETWEEN {7 * DAY} PRECEDING AND CURRENT ROW)""",
    "abnormal_runs": f"WITH {_READINGS}, {_rules('rules')}, "
    + ", ".join(_judged(name, f"j_{name}") for name in _FLAGS)
    + " SELECT node_uri, last_abnormal_time, abnormal_type, abnormal_start_time,"
    + " COALESCE(abnormal_end_time, 0) AS abnormal_end_time FROM ("
    + " UNION ALL ".join(_range_rows(name, f"j_{name}") for name in _FLAGS)
    + ")",
    **{f"disc_{name}": _annotated(name) for name in _FLAGS},
    **{f"abnormal_points_{name}": _points(name) for name in _FLAGS},
    **{f"abnormal_ranges_{name}": _ranges(name) for name in _FLAGS},
    "abnormal_ranges_dense": _ranges("limit"),
    "disc_cumulative_inorder": _ranges("cumulative"),
    "disc_amplitude_inorder": _ranges("amplitude"),
    "disc_limit_passthrough": f"{_BASE}, {_UNIQUE} SELECT id, uri, t, v FROM firsts",
    "change_log": _CHANGES,
    "change_log_points": _POINT_CHANGES,
    "change_log_tables": _CHANGES,
    "apply_changes": f"WITH {_READINGS}, {_rules('rules', True)}, {_judged('limit')} {_range_rows('limit')}",
    "stateful_disc_limit": _ranges("limit"),
    "stateful_snapshot": _ranges("limit"),
    "stateful_disc_switch": _ranges("switch"),
    "stateful_disc_cumulative": _points("cumulative"),
    "stateful_disc_amplitude": _ranges("amplitude"),
    "stateful_moving_avg": f"{_BASE}, {_UNIQUE} {_MOVING}",
    "watermark_hour_avg": f"""{_BASE}, h AS (SELECT uri, round(avg(v), 9) AS v, (t // {HOUR} + 1) * {HOUR} AS t
  FROM bound GROUP BY uri, t // {HOUR}) SELECT {_KEY} AS row_key, uri, t, v FROM h""",
    "stream_sliding_last": f"WITH {_READINGS} {_sliding('point_id', HOUR, 1200000)}",
    "normalise_times": f"WITH {_READINGS} SELECT seq, {_WRITTEN} AS written, {_WRITTEN_MS} AS ms FROM readings",
    "normalise_durations": """WITH u AS (SELECT event_id AS seq, event_id % 50 AS n,
   ['ms','s','m','h','d','w','n','y','x'][event_id % 9 + 1] AS unit FROM events)
 SELECT seq, CAST(n AS VARCHAR) || unit AS written, CASE WHEN n > 0 THEN n * CASE unit WHEN 'ms' THEN 1 WHEN 's' THEN 1000
  WHEN 'm' THEN 60000 WHEN 'h' THEN 3600000 WHEN 'd' THEN 86400000 WHEN 'w' THEN 604800000 WHEN 'n' THEN 2592000000
  WHEN 'y' THEN 31536000000 END END AS ms FROM u""",
    "interval_rollup": f"WITH {_READINGS} "
    + _rollup(
        "readings",
        {
            "500ms": _from("second", 500),
            "30s": _from("minute", 30_000),
            "15m": _from("hour", 900_000),
            "7m": _from("day", 420_000),
            "6h": _from("day", 6 * HOUR),
            "5h": _from("month", 5 * HOUR),
            "1d": _from("day", DAY),
        },
    ),
    "interval_rollup_calendar": f"WITH {_ORDERS} "
    + _rollup(
        "orders_t",
        {
            "10d": _from("year", 10 * DAY),
            "1w": _ms(f"date_trunc('day', {_TS}) - to_days(CAST(dayofweek({_TS}) AS INTEGER))"),
            "1n": _ms(f"date_trunc('month', {_TS})"),
            "5n": _ms(f"date_trunc('year', {_TS}) + to_months(CAST(({_MONTH} - 1) // 5 * 5 AS INTEGER))"),
            "1y": _ms(f"date_trunc('year', {_TS})"),
        },
    ),
    "interval_rollup_points": f"""WITH {_READINGS} SELECT id, {_cut(6 * HOUR)} AS interval_start, COUNT(v) AS n,
  round(SUM(v), 6) AS sum_v, MIN(v) AS min_v, MAX(v) AS max_v FROM readings GROUP BY id, {_cut(6 * HOUR)}""",
    "hour_rollup": f"""WITH {_READINGS}, h AS (SELECT id, t // {HOUR} AS h, COUNT(v) AS n, MIN(t % {HOUR}) AS first_offset,
   MAX(t % {HOUR}) AS last_offset, MAX((t // 1000 + 3599) // 3600 * 36) AS next_hour FROM readings GROUP BY id, t // {HOUR})
 SELECT id, h * 36 AS hour, n, first_offset, last_offset, next_hour, h * {HOUR} + first_offset AS first_t,
  strftime(make_timestamp((h * {HOUR} + first_offset) * 1000), '%Y%m') AS month FROM h""",
    "month_starts": f"""SELECT strftime(o_orderdate, '%Y%m') AS month,
  {_ms("date_trunc('month', o_orderdate) + INTERVAL 1 MONTH")} AS next_month_start,
  {_ms("date_trunc('month', o_orderdate) - INTERVAL 1 MONTH")} AS last_month_start, COUNT(*) AS n
 FROM orders GROUP BY 1, 2, 3""",
    "past_day_report": f"""WITH {_READINGS}, d AS (SELECT {DATA_START + 7 * DAY} AS day_start)
 SELECT seq, t, day_start, day_start + {12 * HOUR} AS day_noon, day_start + {DAY - 1} AS day_end,
  day_start + {5 * HOUR} AS same_time, {_cut(1000)} - day_start AS ms_since_start
 FROM readings, d WHERE t BETWEEN day_start AND day_start + {DAY - 1}""",
    "exact_decimal": f"""WITH w AS (SELECT l_suppkey,
  CAST(l_extendedprice AS DECIMAL(18,6)) + CAST(l_tax AS DECIMAL(18,6)) AS added,
  CAST(l_extendedprice AS DECIMAL(18,6)) - CAST(l_tax AS DECIMAL(18,6)) AS less,
  CAST(l_extendedprice AS DECIMAL(18,6)) * CAST(l_tax AS DECIMAL(18,6)) AS product,
  {_QUOTIENT} AS quotient FROM lineitem)
 SELECT l_suppkey, CAST(SUM(CAST(added AS DECIMAL(28,10))) AS DOUBLE) AS added,
  CAST(SUM(CAST(less AS DECIMAL(28,10))) AS DOUBLE) AS less,
  CAST(SUM(CAST(product AS DECIMAL(28,10))) AS DOUBLE) AS product,
  CAST(SUM(CAST(quotient AS DECIMAL(28,10))) AS DOUBLE) AS quotient FROM w GROUP BY l_suppkey""",
    "json_fields": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(7 AS INTEGER) AS missing,
  json_extract_string(props, '$.k') AS k_text, 'none' AS name,
  CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0 AS k_set,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_date FROM events""",
    "json_drop_fields": """SELECT event_id, '{"id":' || CAST(event_id AS VARCHAR) || ',"inner":{"a":' ||
  CAST(user_id AS VARCHAR) || '}}' AS nested, '{"id":' || CAST(event_id AS VARCHAR) || '}' AS flat FROM events""",
}
ORACLE["sink_dispatch"] = ORACLE["sink_keyed_json"]

# A merge changes folders, not rows.
ORACLE["sink_keyed_merged"] = ORACLE["sink_keyed_table"]
