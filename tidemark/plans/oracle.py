"""DuckDB SQL for every registered query, written independently of the
Spark plans (window triggers by ``generate_series``, gates by window
functions, profiles by FULL JOIN). Tables are pre-registered views."""

from __future__ import annotations

from tidemark.plans.catalog import FEEDS, SPECS

_ACT = """act AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS contid,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         CAST(event_type = 'click' AS BIGINT) AS clicks, CAST(event_type = 'view' AS BIGINT) AS shows
  FROM events WHERE event_type IN ('click', 'view'))"""

_VV = """vv AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS contid,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec, value AS tm,
         CAST((event_id * 7) % 240 AS DOUBLE) AS duration
  FROM events)"""


def _triggers(length: int, step: int, mode: str) -> str:
    """SQL list of the triggers T of a row's windows, from its second ``sec``."""
    lo = f"((sec + {step}) // {step}) * {step}" if mode == "half_open" else \
        f"((sec + {step} - 1) // {step}) * {step}"
    hi = f"((sec + {length}) // {step}) * {step}"
    return f"generate_series({lo}, {hi}, {step})"


def _gate(sql_g: str, cols: str, min_records: int) -> str:
    if min_records <= 1:
        return f"SELECT {cols} FROM {sql_g}"
    return (f"SELECT {cols} FROM (SELECT *, sum(n) OVER (PARTITION BY t) AS tot FROM {sql_g}) "
            f"WHERE tot >= {min_records}")


def click_show_sql(length, step, mode, key, min_records) -> str:
    return f"""WITH {_ACT},
e AS (SELECT *, unnest({_triggers(length, step, mode)}) AS t FROM act),
g AS (SELECT t, {key}, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(shows) AS BIGINT) AS shows,
             count(*) AS n FROM e GROUP BY t, {key})
{_gate('g', f't, {key}, clicks, shows', min_records)}"""


def completion_sql(length, step, mode, key, min_records) -> str:
    return f"""WITH {_VV},
e AS (SELECT *, unnest({_triggers(length, step, mode)}) AS t FROM vv),
g AS (SELECT t, {key}, CAST(sum(CAST(tm AS DECIMAL(18,2))) AS DOUBLE) AS tm,
             CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS duration, count(*) AS n
      FROM e GROUP BY t, {key})
{_gate('g', f't, {key}, tm, duration, tm / duration AS rpt', min_records)}"""


def _spec_args(name):
    s = SPECS[name]
    return s.length, s.slide, s.mode, s.min_records


USER_PROFILE_SQL = f"""WITH {_ACT}, {_VV},
ea AS (SELECT *, (sec // 300 + 1) * 300 AS t FROM act),
ev AS (SELECT *, (sec // 300 + 1) * 300 AS t FROM vv),
ga AS (SELECT t, u, sum(clicks) AS c, sum(shows) AS s, count(*) AS n FROM ea GROUP BY t, u),
gv AS (SELECT t, u, CAST(sum(CAST(tm AS DECIMAL(18,2))) AS DOUBLE) AS tm,
              CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS d, count(*) AS n
       FROM ev GROUP BY t, u),
pa AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY t) AS tot FROM ga) WHERE tot >= 2),
pv AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY t) AS tot FROM gv) WHERE tot >= 2)
SELECT coalesce(pa.t, pv.t) AS t, coalesce(pa.u, pv.u) AS u,
       CAST(pa.c AS BIGINT) AS rt_u_click, CAST(pa.s AS BIGINT) AS rt_u_reveal,
       pv.tm / pv.d AS rt_u_rpt
FROM pa FULL JOIN pv ON pa.t = pv.t AND pa.u = pv.u"""

USER_PROFILE_READ_SQL = f"""SELECT t, u, coalesce(rt_u_click, 0) AS rt_u_click,
       coalesce(rt_u_reveal, 0) AS rt_u_reveal, coalesce(rt_u_rpt, 0.0) AS rt_u_rpt
FROM ({USER_PROFILE_SQL})"""


def _feed_profile_sql(step: int | None = None) -> str:
    lengths = sorted(FEEDS.values())
    longest = lengths[-1]
    names = {300: "rt_f_", 7200: "rt_f_2h_", 14400: "rt_f_4h_"}
    cols = []
    for L in lengths:
        p = names[L]
        cond = f"sec >= t - {L}"
        dec = "CAST({c} AS DECIMAL(18,2))"
        cols += [
            f"CAST(sum(clicks) FILTER (WHERE {cond}) AS BIGINT) AS {p}click",
            f"CAST(sum(shows) FILTER (WHERE {cond}) AS BIGINT) AS {p}reveal",
            f"CAST(sum({dec.format(c='tm')}) FILTER (WHERE {cond}) AS DOUBLE) / "
            f"CAST(sum({dec.format(c='duration')}) FILTER (WHERE {cond}) AS DOUBLE) AS {p}rpt",
        ]
    body = ",\n       ".join(cols)
    return f"""WITH {_ACT}, {_VV},
tagged AS (SELECT sec, contid, clicks, shows, NULL::DOUBLE AS tm, NULL::DOUBLE AS duration FROM act
           UNION ALL
           SELECT sec, contid, NULL::BIGINT, NULL::BIGINT, tm, duration FROM vv),
e AS (SELECT *, unnest({_triggers(longest, step or longest, "half_open")}) AS t FROM tagged)
SELECT t, contid,
       {body}
FROM e GROUP BY t, contid"""


ORACLE_SQL: dict[str, str] = {
    **{f"user_click_show_{m}": click_show_sql(*_spec_args(m)[:3], "u", _spec_args(m)[3])
       for m in ("tumbling", "sliding", "inclusive", "reference", "gapped")},
    **{f"user_completion_{m}": completion_sql(*_spec_args(m)[:3], "u", _spec_args(m)[3])
       for m in ("tumbling", "sliding", "inclusive", "reference", "gapped")},
    **{f"feed_click_show_{n}": click_show_sql(L, L, "half_open", "contid", 1)
       for n, L in FEEDS.items()},
    **{f"feed_completion_{n}": completion_sql(L, L, "half_open", "contid", 1)
       for n, L in FEEDS.items()},
    "feed_click_show_sliding": click_show_sql(7200, 300, "half_open", "contid", 1),
    "feed_completion_sliding": completion_sql(7200, 300, "half_open", "contid", 1),
    "user_profile": USER_PROFILE_SQL,
    "user_profile_read": USER_PROFILE_READ_SQL,
    "feed_profile": _feed_profile_sql(),
}


# --- parse (P1-P7): JSON built and parsed in DuckDB --------------------------
_NUM = r"(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|0x1\.8p3|[+-]?(?i:inf|infinity)|(?i:nan))"


def _number(c: str) -> str:
    return f"CASE WHEN {c} = '0x1.8p3' THEN 12.0 ELSE try_cast({c} AS DOUBLE) END"


def _exact(c: str) -> str:
    """The sum of c: two-decimal values under a billion exactly, all others as doubles."""
    small = f"(isfinite({c}) AND abs({c}) < 1e9 AND round({c} * 100) / 100 = {c})"
    whole = f"CAST(sum(CASE WHEN {small} THEN CAST({c} AS DECIMAL(18,2)) END) AS DOUBLE)"
    return (f"CASE WHEN bool_and({small}) THEN {whole} "
            f"ELSE coalesce({whole}, 0) + sum(CASE WHEN NOT {small} THEN {c} END) END")


def _divide(n: str, d: str) -> str:
    """IEEE division."""
    return (f"CASE WHEN {d} <> 0 OR isnan({d}) THEN {n} / {d} WHEN isnan({n}) OR {n} = 0 THEN 'nan'::DOUBLE "
            f"WHEN ({n} > 0) = (CAST({d} AS VARCHAR) = '0.0') THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END")


def _num_ok(c: str) -> str:
    return (f"(regexp_full_match({c}, '{_NUM}') AND (regexp_matches({c}, '(?i)inf') "
            f"OR NOT coalesce(abs(try_cast({c} AS DOUBLE)) = 'inf'::DOUBLE, false)))")


def _raw_sql(vv: bool) -> str:
    odd = "['nan', 'inf', '-Infinity', '1e300', '0x1.8p3', '-0', '2.125', '1e400'][event_id // 31 % 8 + 1]"
    extra = (f", 'tm', CASE WHEN event_id % 23 = 0 THEN 'abc' WHEN event_id % 31 = 0 THEN {odd} "
             "ELSE CAST(value AS VARCHAR) END, 'duration', CASE WHEN event_id % 37 = 0 THEN '-0' "
             "ELSE CAST((event_id * 7) % 240 AS VARCHAR) END") if vv else ""
    texts = """[j || ' xyz', j || ',', j || j, replace(j, '"', chr(39)), j || '] [' || j,
                '{"x":NaN,' || substr(j, 2), '  {"x":[1,{"y":"]"}],' || substr(j, 2) || ' ']"""
    return f"""src AS (
  SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(json_object(
    't', event_type,
    'u', CASE WHEN event_id % 29 = 0 THEN '  ' || CAST(user_id AS VARCHAR) || '  '
              ELSE CAST(user_id AS VARCHAR) END,
    'contid', CASE WHEN event_id % 17 = 0 THEN '' ELSE json_extract_string(props, '$.k') END
    {extra}) AS VARCHAR) AS j
  FROM events),
raw AS (SELECT event_id AS key, sec,
               event_id % 41 = 0 AND event_id % 19 <> 0 AND event_id // 41 % 7 = 5 AS bare_nan,
               CASE WHEN event_id % 19 = 0 THEN left(j, length(j) // 2)
                    WHEN event_id % 41 = 0 THEN {texts}[event_id // 41 % 7 + 1] ELSE j END AS value
        FROM src),
p AS (SELECT key, sec, value, CASE WHEN json_valid(value) AND NOT bare_nan THEN json_type(value) = 'OBJECT'
                              ELSE false END AS is_obj
      FROM raw),
f AS (SELECT key, sec, is_obj,
        CASE WHEN is_obj THEN json_extract_string(value, '$.t') END AS t,
        CASE WHEN is_obj THEN json_extract_string(value, '$.u') END AS u,
        CASE WHEN is_obj THEN json_extract_string(value, '$.contid') END AS contid,
        CASE WHEN is_obj THEN json_extract_string(value, '$.tm') END AS tm,
        CASE WHEN is_obj THEN json_extract_string(value, '$.duration') END AS duration
      FROM p)"""


_ACT_REASON = """CASE WHEN NOT is_obj THEN 'parse'
     WHEN coalesce(t, '') = '' OR coalesce(u, '') = '' OR coalesce(contid, '') = '' THEN 'required'
     WHEN t NOT IN ('click', 'view') THEN 'type' END"""
_VV_REASON = f"""CASE WHEN NOT is_obj THEN 'parse'
     WHEN coalesce(t, '') = '' OR coalesce(u, '') = '' OR coalesce(contid, '') = ''
          OR coalesce(tm, '') = '' OR coalesce(duration, '') = '' THEN 'required'
     WHEN NOT ({_num_ok('tm')} AND {_num_ok('duration')}) THEN 'number' END"""

PARSE_ACTIONS_SQL = f"""WITH {_raw_sql(False)},
r AS (SELECT *, {_ACT_REASON} AS reason FROM f)
SELECT key, trim(u, ' ') AS u, t, contid, CAST(t = 'click' AS BIGINT) AS clicks,
       CAST(t = 'view' AS BIGINT) AS shows
FROM r WHERE reason IS NULL"""

PARSE_VV_SQL = f"""WITH {_raw_sql(True)},
r AS (SELECT *, {_VV_REASON} AS reason FROM f)
SELECT key, u, t, contid, tm, duration, {_divide('tm', 'duration')} AS rpt
FROM (SELECT key, u, t, contid, {_number('tm')} AS tm, CAST(duration AS DOUBLE) AS duration
      FROM r WHERE reason IS NULL)"""

REJECT_REASONS_SQL = f"""WITH a AS (WITH {_raw_sql(False)} SELECT coalesce({_ACT_REASON}, 'ok') AS reason FROM f),
v AS (WITH {_raw_sql(True)} SELECT coalesce({_VV_REASON}, 'ok') AS reason FROM f)
SELECT 'action' AS path, reason, count(*) AS n FROM a GROUP BY reason
UNION ALL
SELECT 'vv' AS path, reason, count(*) AS n FROM v GROUP BY reason"""

ROUTE_KINDS_SQL = f"""WITH {_ACT}, {_VV},
tagged AS (SELECT sec, 'act' AS kind FROM act UNION ALL SELECT sec, 'vv' AS kind FROM vv)
SELECT (sec // 300 + 1) * 300 AS t, kind, count(*) AS n FROM tagged GROUP BY 1, 2"""

PROPS_EXTRACT_SQL = """SELECT event_id, json_extract_string(props, '$.k') AS contid,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

LIVE_SET_AT_SQL = f"""WITH {_ACT}
SELECT event_id, u, sec, clicks, shows FROM act
WHERE sec >= (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) FROM events) - 14400
  AND sec <= (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) FROM events)"""

WINDOW_SNAPSHOT_SQL = f"""WITH {_ACT}
SELECT event_id, u, clicks, shows, unnest({_triggers(300, 60, 'inclusive')}) AS t FROM act"""

USER_ROLLING_SQL = f"""WITH {_ACT}
SELECT event_id, u, sec,
       CAST(sum(clicks) OVER w AS BIGINT) AS rolling_clicks,
       CAST(sum(shows) OVER w AS BIGINT) AS rolling_shows,
       count(*) OVER w AS rolling_n
FROM act
WINDOW w AS (PARTITION BY u ORDER BY sec RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW)"""

_TUMBLING_RESULTS = f"""res AS ({click_show_sql(300, 300, 'half_open', 'u', 2)})"""
_REFERENCE_RESULTS = f"""res AS ({click_show_sql(*_spec_args('reference')[:3], 'u', 2)})"""

_FIRST_WRITE_BODY = """
f AS (SELECT *, first_value(clicks) OVER w AS fc, first_value(shows) OVER w AS fs,
             row_number() OVER w AS rn
      FROM res WINDOW w AS (PARTITION BY u ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT t, u, 'USER_CLICK_SHOW_5MIN_' || u AS store_key,
       CASE WHEN rn = 1 THEN clicks ELSE fc + clicks END AS rt_u_click,
       CASE WHEN rn = 1 THEN shows ELSE fs + shows END AS rt_u_reveal,
       fc AS stored_click, fs AS stored_reveal
FROM f"""

KEYED_FIRST_WRITE_REFERENCE_SQL = f"""WITH {_REFERENCE_RESULTS},{_FIRST_WRITE_BODY}"""

KEYED_FIRST_WRITE_SQL = f"""WITH {_TUMBLING_RESULTS},
f AS (SELECT *, first_value(clicks) OVER w AS fc, first_value(shows) OVER w AS fs,
             row_number() OVER w AS rn
      FROM res WINDOW w AS (PARTITION BY u ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT t, u, 'USER_CLICK_SHOW_5MIN_' || u AS store_key,
       CASE WHEN rn = 1 THEN clicks ELSE fc + clicks END AS rt_u_click,
       CASE WHEN rn = 1 THEN shows ELSE fs + shows END AS rt_u_reveal,
       fc AS stored_click, fs AS stored_reveal
FROM f"""

KEYED_MOST_CLICKS_SQL = f"""WITH {_TUMBLING_RESULTS}
SELECT t, u, 'USER_CLICK_SHOW_5MIN_' || u AS store_key, max(clicks) OVER w AS most_clicks
FROM res WINDOW w AS (PARTITION BY u ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

KEYED_ACCUMULATE_SQL = f"""WITH {_TUMBLING_RESULTS}
SELECT t, u, 'USER_CLICK_SHOW_5MIN_' || u AS store_key,
       CAST(sum(clicks) OVER w AS BIGINT) AS rt_u_click, CAST(sum(shows) OVER w AS BIGINT) AS rt_u_reveal
FROM res WINDOW w AS (PARTITION BY u ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

SEQUENCE_SUMMARY_SQL = """WITH s AS (
  SELECT user_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)
SELECT user_id, count(*) AS length,
       max(value) FILTER (WHERE idx = 0) AS head, CAST(0 AS BIGINT) AS head_idx,
       max(value) FILTER (WHERE idx = n - 1) AS tail, count(*) - 1 AS tail_idx,
       arg_min(value, idx) FILTER (WHERE value IS NOT NULL) AS valid_head,
       coalesce(min(idx) FILTER (WHERE value IS NOT NULL), -1) AS valid_head_idx,
       arg_max(value, idx) FILTER (WHERE value IS NOT NULL) AS valid_tail,
       coalesce(max(idx) FILTER (WHERE value IS NOT NULL), -1) AS valid_tail_idx,
       coalesce(max(idx) FILTER (WHERE value IS NOT NULL) - min(idx) FILTER (WHERE value IS NOT NULL) + 1, 0)
         AS valid_length,
       min(sec) AS oldest_sec
FROM s GROUP BY user_id"""

BOUNDED_INTAKE_SQL = """WITH s AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)
SELECT user_id, event_id, pos, least(n, 8) AS size, greatest(n - 8, 0) AS rejected, n >= 8 AS full, false AS empty
FROM s WHERE pos < 8"""

USER_SEQUENCE_2H_SQL = """WITH e AS (
  SELECT user_id, event_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CASE WHEN event_id % 3 <> 0 THEN value END AS value
  FROM events),
m AS (
  SELECT a.event_id, a.user_id, a.sec, b.value, b.sec AS s,
         row_number() OVER (PARTITION BY a.event_id ORDER BY b.ts, b.event_id) AS i
  FROM e a JOIN e b ON a.user_id = b.user_id AND b.sec BETWEEN a.sec - 7200 AND a.sec)
SELECT user_id, event_id, sec, count(*) AS length, arg_min_null(value, i) AS head, arg_max_null(value, i) AS tail,
       arg_min(value, i) FILTER (WHERE value IS NOT NULL) AS valid_head,
       arg_max(value, i) FILTER (WHERE value IS NOT NULL) AS valid_tail,
       coalesce(max(i) FILTER (WHERE value IS NOT NULL) - min(i) FILTER (WHERE value IS NOT NULL) + 1, 0) AS valid_length,
       min(value) AS lowest, min(s) AS oldest_sec
FROM m GROUP BY event_id, user_id, sec"""

BOUNDED_INTAKE_2H_SQL = """WITH RECURSIVE e AS (
  SELECT event_type, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i
  FROM events),
r AS (
  SELECT event_type, event_id, sec, i, true AS accepted, [sec] AS live FROM e WHERE i = 1
  UNION ALL
  SELECT event_type, event_id, sec, i, len(held) < 3,
         CASE WHEN len(held) < 3 THEN list_append(held, sec) ELSE held END
  FROM (SELECT e.event_type, e.event_id, e.sec, e.i, list_filter(r.live, lambda x: x + 7200 >= e.sec) AS held
        FROM r JOIN e ON e.event_type = r.event_type AND e.i = r.i + 1))
SELECT event_type, event_id, sec, accepted, CAST(len(live) AS INTEGER) AS size FROM r"""

_FRAME_STATUS = "CASE WHEN doc_id % 10 = 0 THEN 'checksum' WHEN doc_id % 10 = 5 THEN 'short' ELSE 'ok' END"

FRAME_INTEGRITY_SQL = f"""SELECT doc_id, {_FRAME_STATUS} AS status,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS INTEGER) END AS msg_id,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(strlen(text) + 8 AS INTEGER) END AS size,
  CASE WHEN doc_id % 5 <> 0 THEN strlen(text) END AS payload_len,
  CASE WHEN doc_id % 5 <> 0 THEN true END AS payload_ok
FROM documents"""

FRAME_STATUS_COUNTS_SQL = f"""SELECT {_FRAME_STATUS} AS status,
       count(*) AS n FROM documents GROUP BY 1"""

def _messages_sql(vv: bool, spec: str = "reference") -> str:
    length, step, mode, gate = _spec_args(spec)
    if vv:
        parsed = f"""r AS (SELECT *, {_VV_REASON} AS reason FROM f),
rec AS (SELECT sec, u, {_number('tm')} AS tm, CAST(duration AS DOUBLE) AS duration
        FROM r WHERE reason IS NULL),"""
        agg = f"{_exact('tm')} AS tm, {_exact('duration')} AS duration"
        tail = f"SELECT t, u, tm, duration, {_divide('tm', 'duration')} AS rpt FROM res"
    else:
        parsed = f"""r AS (SELECT *, {_ACT_REASON} AS reason FROM f),
rec AS (SELECT sec, trim(u, ' ') AS u, CAST(t = 'click' AS BIGINT) AS clicks,
               CAST(t = 'view' AS BIGINT) AS shows
        FROM r WHERE reason IS NULL),"""
        agg = "CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(shows) AS BIGINT) AS shows"
        tail = """fw AS (SELECT *, first_value(clicks) OVER w AS fc, first_value(shows) OVER w AS fs,
             row_number() OVER w AS rn
      FROM res WINDOW w AS (PARTITION BY u ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT t, u, 'USER_CLICK_SHOW_5MIN_' || u AS store_key,
       CASE WHEN rn = 1 THEN clicks ELSE fc + clicks END AS rt_u_click,
       CASE WHEN rn = 1 THEN shows ELSE fs + shows END AS rt_u_reveal,
       fc AS stored_click, fs AS stored_reveal
FROM fw"""
        tail = "," + tail
    gated = (f"res AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY t) AS tot FROM g) "
             f"WHERE tot >= {gate})")
    head = f"""WITH {_raw_sql(vv)},
{parsed}
e AS (SELECT *, unnest({_triggers(length, step, mode)}) AS t FROM rec),
g AS (SELECT t, u, {agg}, count(*) AS n FROM e GROUP BY t, u),
{gated}"""
    return head + (tail if not vv else "\n" + tail)


ORACLE_SQL.update({
    "messages_click_show": _messages_sql(False),
    "messages_completion": _messages_sql(True),
    "parse_actions": PARSE_ACTIONS_SQL,
    "parse_vv": PARSE_VV_SQL,
    "reject_reasons": REJECT_REASONS_SQL,
    "route_kinds": ROUTE_KINDS_SQL,
    "props_extract": PROPS_EXTRACT_SQL,
    "live_set_at": LIVE_SET_AT_SQL,
    "window_snapshot": WINDOW_SNAPSHOT_SQL,
    "user_rolling": USER_ROLLING_SQL,
    "keyed_first_write": KEYED_FIRST_WRITE_SQL,
    "keyed_accumulate": KEYED_ACCUMULATE_SQL,
    "keyed_most_clicks": KEYED_MOST_CLICKS_SQL,
    "feed_profile_sliding": _feed_profile_sql(300),
    "feed_click_show_4h_live": f"""WITH {_ACT},
edges AS (SELECT contid, sec + 1 AS t FROM act UNION SELECT contid, sec + 14401 FROM act),
spans AS (SELECT contid, t AS t_from, lead(t) OVER (PARTITION BY contid ORDER BY t) AS t_to FROM edges)
SELECT s.contid, t_from, t_to, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(shows) AS BIGINT) AS shows, count(*) AS n
FROM spans s JOIN act a ON a.contid = s.contid AND a.sec < t_from AND a.sec >= t_from - 14400
GROUP BY 1, 2, 3""",
    "profile_value_read": f"""SELECT 'USER_CLICK_SHOW_5MIN_' || u || ':' || t AS store_key, rt_u_click, rt_u_reveal, rt_u_rpt
FROM ({USER_PROFILE_READ_SQL})""",
    "props_nested": """SELECT event_id, CAST(json_extract(j, '$.user') AS VARCHAR) AS user_json,
       json_extract_string(j, '$.user.id') AS user_id, json_extract_string(j, '$.items[1]') AS second_item,
       json_extract_string(j, '$.none') AS none, json_extract_string(j, '$.user.vip') AS vip,
       CAST(json_extract_string(j, '$.n') AS BIGINT) AS n
FROM (SELECT event_id, '{"user":{"id":"' || user_id || '","vip":' || (user_id % 2 = 0) || '},"items":[' || event_id
             || ',' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '],"none":null,"n":' || event_id % 10 || '}' AS j
      FROM events)""",
    "profile_value_bytes": f"""SELECT 'USER_CLICK_SHOW_5MIN_' || u || ':' || t AS store_key, rt_u_click, rt_u_reveal, rt_u_rpt
FROM ({USER_PROFILE_READ_SQL})""",
    "props_variant": """SELECT event_id, json_type(props) AS kind,
       CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(props, '$.k') END AS k_kind,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS k_text,
       json_extract(props, '$.k.deeper') IS NULL AS no_deeper FROM events""",
    "user_sequence_2h": USER_SEQUENCE_2H_SQL,
    "bounded_intake_2h": BOUNDED_INTAKE_2H_SQL,
    "frame_log_scan": """SELECT CAST(doc_id AS INTEGER) AS msg_id, md5(text) AS payload_md5
FROM documents WHERE doc_id % 5 <> 0""",
    "frame_log_quarantine": """SELECT CASE WHEN doc_id % 10 = 0 THEN 'checksum' ELSE 'lost' END AS status,
       CASE WHEN doc_id % 10 = 0 THEN CAST(doc_id AS INTEGER) END AS msg_id,
       CASE WHEN doc_id % 10 = 0 THEN strlen(text) + 12 ELSE 10 END AS size
FROM documents WHERE doc_id % 5 = 0""",
    "keyed_first_write_reference": KEYED_FIRST_WRITE_REFERENCE_SQL,
    "profile_store": f"""WITH {_TUMBLING_RESULTS}
SELECT 'USER_CLICK_SHOW_5MIN_' || u AS store_key, arg_min(clicks, t) AS rt_u_click,
       arg_min(shows, t) AS rt_u_reveal
FROM res GROUP BY u""",
    "feed_profile_read": f"""SELECT t, contid, {", ".join(
        f"coalesce({p}{m}, {'0.0' if m == 'rpt' else '0'}) AS {p}{m}"
        for p in ("rt_f_", "rt_f_2h_", "rt_f_4h_") for m in ("click", "reveal", "rpt"))}
FROM ({_feed_profile_sql()})""",
    "sequence_summary": SEQUENCE_SUMMARY_SQL,
    "bounded_intake": BOUNDED_INTAKE_SQL,
    "frame_integrity": FRAME_INTEGRITY_SQL,
    "frame_status_counts": FRAME_STATUS_COUNTS_SQL,
})
ORACLE_SQL["feed_value_bytes"] = ORACLE_SQL["feed_profile_read"]

# Messages of the newer two thirds of the time: a log's start at its newest offset skips the first.
ORACLE_SQL["messages_click_show_newer"] = _messages_sql(False, "tumbling").replace("FROM events)", "FROM newer)").replace(
    "WITH src", """WITH newer AS (
  SELECT * FROM events WHERE CAST(floor(epoch(ts)) AS BIGINT) >= (
    SELECT min(CAST(floor(epoch(ts)) AS BIGINT)) + (max(CAST(floor(epoch(ts)) AS BIGINT)) - min(CAST(floor(epoch(ts)) AS BIGINT)) + 3) // 3
    FROM events)),
src""", 1)
