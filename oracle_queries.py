"""DuckDB oracle SQL for every registered query.

Each oracle rebuilds the jobs' inputs from the driver's tables in SQL and
computes the expected result independently of the Spark code: JSON through
DuckDB's JSON functions, first use with ``row_number``, set operations with
``EXCEPT``/``IN``/``NOT EXISTS``, the payload through unnest + re-aggregate.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

# Fixed values, written out here so that an error in the library's own shows. Weight of each of the
# first 17 digits of an 18-digit number, and the check character for the weighted sum mod 11.
POWER_WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
CHECK_CODES = "10x98765432"
# Province code -> name, in code order.
PROVINCES = [
    ("11", "北京"), ("12", "天津"), ("13", "河北"), ("14", "山西"), ("15", "内蒙古"),
    ("21", "辽宁"), ("22", "吉林"), ("23", "黑龙江"),
    ("31", "上海"), ("32", "江苏"), ("33", "浙江"), ("34", "安徽"), ("35", "福建"),
    ("36", "江西"), ("37", "山东"),
    ("41", "河南"), ("42", "湖北"), ("43", "湖南"), ("44", "广东"), ("45", "广西"),
    ("46", "海南"),
    ("50", "重庆"), ("51", "四川"), ("52", "贵州"), ("53", "云南"), ("54", "西藏"),
    ("61", "陕西"), ("62", "甘肃"), ("63", "青海"), ("64", "宁夏"), ("65", "新疆"),
    ("71", "台湾"), ("81", "香港"), ("82", "澳门"), ("91", "国外"),
]
FORMAT_ANY = r"(^\d{15}$)|(\d{17}(?:\d|x|X)$)"
FORMAT_15 = r"^[1-9]\d{7}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])\d{3}$"
FORMAT_18 = r"^[1-9]\d{5}[1-9]\d{3}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])\d{3}([\d|x|X]{1})$"


class Q:
    """Parameters of the registered queries."""

    DAY_RANGE = ("2024-01-05", "2024-01-20")
    ALL_DAYS = ("2000-01-01", "2099-12-31")
    ORDERS_AS_OF, ORDERS_DAYS = "2001-08-01", 730
    DEVICES_AS_OF, DEVICES_DAYS = "2024-01-31", 7
    USERS_LOADED_BEFORE = "2017-06-01 00:00:00"
    USERS_AS_OF = "2017-09-01 00:00:00"
    IDCARD_AS_OF = "2024-06-30"
    URL_PS, URL_ES_PS = "page,ref,utm_source", "page_no,ref_code"
    RESYNC_DAY = "2030-01-01"


# ---- SQL snippets -----------------------------------------------------------


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def jsplit(x: str, sep: str) -> str:
    """JVM String.split: trailing empty strings dropped."""
    stripped = f"regexp_replace({x}, '(?:{sep})+$', '')"
    return (f"(CASE WHEN {x} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({stripped}, '{sep}') END)")


def digits(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '^[0-9]+$'), false)"


def psum(x: str) -> str:
    return "(" + " + ".join(f"TRY_CAST(substr({x}, {i + 1}, 1) AS INTEGER) * {w}"
                            for i, w in enumerate(POWER_WEIGHTS)) + ")"


CHECK = CHECK_CODES


def check(sum_expr: str) -> str:
    return f"substr('{CHECK}', CAST(({sum_expr}) % 11 + 1 AS INTEGER), 1)"


def valid18(x: str) -> str:
    return (f"coalesce(length({x}) = 18 AND {digits(f'substr({x}, 1, 17)')} AND "
            f"lower(substr({x}, 18, 1)) = {check(psum(f'substr({x}, 1, 17)'))}, false)")


def lenient(y: str, m: str, d: str) -> str:
    return (f"CAST(make_date(CAST({y} AS BIGINT), 1, 1) + to_months(CAST({m} AS INTEGER) - 1) "
            f"+ to_days(CAST({d} AS INTEGER) - 1) AS DATE)")


def yymmdd(t: str, as_of: str) -> str:
    """Lenient yyMMdd of chars 7-12 with the 80-years-back two-digit window."""
    a = datetime.fromisoformat(as_of)
    start = a.replace(year=a.year - 80)
    sy, syy = start.year, start.year % 100
    century = sy - syy
    yy, mm, dd = (f"TRY_CAST(substr({t}, {p}, 2) AS INTEGER)" for p in (7, 9, 11))
    plain = lenient(f"{century} + {yy} + CASE WHEN {yy} < {syy} THEN 100 ELSE 0 END", mm, dd)
    same = lenient(f"{century} + {yy}", mm, dd)
    later = lenient(f"{century} + {yy} + 100", mm, dd)
    return (f"(CASE WHEN {yy} <> {syy} THEN {plain} "
            f"WHEN CAST({same} AS TIMESTAMP) < TIMESTAMP '{start.isoformat(sep=' ')}' THEN {later} "
            f"ELSE {same} END)")


def _authority(u: str) -> str:
    return f"regexp_extract({jtrim(u)}, '(?i)^(https?|ftp|file)://([^/?#]*)', 2)"


def _after_user(u: str) -> str:
    return f"regexp_replace({_authority(u)}, '^[^@]*@', '')"


def url_ok(u: str) -> str:
    """A known scheme; a host without stray colons or brackets; an empty or 32-bit port."""
    rest = _after_user(u)
    port = f"regexp_extract({rest}, ':([^:\\]]*)$', 1)"
    shape = f"regexp_matches({rest}, '^(\\[[0-9A-Fa-f:.%]*\\]|[^:\\[\\]]*)(:[+]?[0-9]*)?$')"
    number = f"({port} = '' OR TRY_CAST({port} AS INTEGER) IS NOT NULL)"
    return f"coalesce(regexp_matches({jtrim(u)}, '(?i)^(https?|ftp|file):') AND {shape} AND {number}, false)"


def url_domain(u: str) -> str:
    return f"regexp_extract({_after_user(u)}, '^(\\[[^\\]]*\\]|[^:]*)', 1)"


def url_path(u: str) -> str:
    path = f"regexp_extract({jtrim(u)}, '(?i)^(https?|ftp|file):(//[^/?#]*)?([^?#]*)', 3)"
    return f"regexp_replace({path}, '//', '/', 'g')"


def raw_pairs(u: str) -> str:
    """list of [name, value] for params with exactly one '='."""
    parts = jsplit(u, "\\?")
    query = f"(CASE WHEN len({parts}) > 1 THEN {parts}[2] END)"
    return (f"list_filter(list_transform({jsplit(f'coalesce({query}, {chr(39)}{chr(39)})', '&')}, "
            f"lambda p: {jsplit('p', '=')}), lambda kv: len(kv) = 2)")


def renamed(u: str, ps: str, es: str) -> str:
    """list of {key, value}: params renamed via the zipped ps/es lists."""
    psl, esl = jsplit(ps, ","), jsplit(es, ",")
    zipped = (f"list_transform(generate_series(1, least(len({psl}), len({esl}))), "
              f"lambda i: {{'ps': {psl}[i], 'es': {esl}[i]}})")
    target = f"list_filter({zipped}, lambda r: r.ps = kv[1])[-1].es"
    named = f"list_transform({raw_pairs(u)}, lambda kv: {{'key': {target}, 'value': kv[2]}})"
    return f"list_filter({named}, lambda e: e.key IS NOT NULL AND {jtrim('e.key')} <> '')"


def dedup_json(entries: str) -> str:
    """JSON object of key/value structs; the last value of a key wins; keys sorted."""
    kept = (f"list_filter({entries}, lambda e, i: NOT list_contains("
            f"list_transform(list_slice({entries}, i + 1, len({entries})), lambda y: y.key), e.key))")
    return f"CAST(to_json(map_from_entries(list_sort({kept}))) AS VARCHAR)"


def ios_entries(c: str) -> str:
    cleaned = f"translate({c}, ';{{}}' || chr(9), ',')"
    kv = f"list_transform({jsplit(cleaned, ',')}, lambda p: {jsplit('p', '=')})"
    return (f"list_transform(list_filter({kv}, lambda x: len(x) = 2), "
            f"lambda x: {{'key': {jtrim('x[1]')}, 'value': {jtrim('x[2]')}}})")


# ---- derived inputs ---------------------------------------------------------

def _event_url(e: str) -> str:
    v = lambda x: f"CAST({x} AS VARCHAR)"
    return (f"CASE {e} % 4 "
            f"WHEN 0 THEN 'http://h' || {v(f'{e} % 17')} || '.example.com/a//b///c?page=' || {v(f'{e} % 5')}"
            f" || '&ref=r' || {v(f'{e} % 3')} || '&x=1=2&q=#top' "
            f"WHEN 1 THEN 'https://www.site' || {v(f'{e} % 9')} || '.example.org//p' || {v(f'{e} % 7')}"
            f" || '?utm_source=feed&page=' || {v(f'{e} % 4')} "
            f"WHEN 2 THEN CASE {e} % 44 WHEN 2 THEN 'http://h.com:abc/p?page=1' WHEN 6 THEN 'file:///var//log/a?page=2' "
            f"WHEN 10 THEN 'http://u@[::1]:80/p?ref=z' ELSE 'ftp://files.example.net/pub//f' || {v(f'{e} % 10')} END "
            f"ELSE 'foo://bad/' || {v(e)} END")


LOGS = f"""logs AS (
  SELECT event_id AS eid,
    CAST(CASE WHEN user_id % 10 = 0 THEN 0 ELSE user_id END AS BIGINT) AS uid,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' WHEN event_id % 13 = 0 THEN chr(9)
         ELSE 'd' || CAST(event_id % 500 AS VARCHAR) END AS deviceid,
    CASE WHEN event_id % 3 = 0 THEN (CASE WHEN event_id % 19 = 0 THEN 'iOS' ELSE 'ios' END)
         WHEN event_id % 3 = 1 THEN 'android'
         ELSE (CASE WHEN event_id % 2 = 0 THEN 'H5' ELSE 'h5' END) END AS plateform,
    CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
         WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END AS INTEGER) AS eventid,
    CASE WHEN event_id % 3 = 0 THEN
           (CASE WHEN event_id % 4 = 0 THEN '{{hello}}'
                 ELSE '{{k=' || kk || '; uid=' || CAST(user_id AS VARCHAR) || ';' || chr(9)
                      || 'bad=;a=b=c;url=' || url || '}}' END)
         ELSE (CASE WHEN event_id % 17 = 0 THEN 'not json {{' || kk
                    WHEN event_id % 23 = 0 THEN '{{"k": ' || kk || '}} tail'
                    WHEN event_id % 29 = 0 THEN '{{"k": ' || kk || '}}{{"k": 1}}'
                    WHEN event_id % 5 = 0 THEN '{{"k": ' || kk || ', "Url": "' || url || '"}}'
                    ELSE '{{"k": ' || kk || ', "url": "' || url || '", "tags": {{"a": 1}}, " UID ": "'
                         || CAST(user_id AS VARCHAR) || '"}}' END) END AS eventcontent,
    bt AS begintime,
    bt + event_id % 5000 AS uploadtime,
    '10.0.' || CAST(event_id % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
    'v' || CAST(event_id % 3 AS VARCHAR) AS version,
    event_type AS pmenu,
    'm' || CAST(event_id % 6 AS VARCHAR) AS menu,
    CASE WHEN event_id % 2 = 0 THEN 'wifi' ELSE '4g' END AS net,
    'c' || CAST(event_id % 4 AS VARCHAR) AS channel,
    'app' AS client,
    'os' || CAST(event_id % 5 AS VARCHAR) AS os,
    'sp' || CAST(event_id % 2 AS VARCHAR) AS subplateform,
    strftime(ts, '%Y-%m-%d') AS p_day
  FROM (SELECT *, epoch_us(ts) // 1000 AS bt, regexp_extract(props, '([0-9]+)', 1) AS kk,
               {_event_url('event_id')} AS url FROM events) ev
)"""

LOG_COLS = ("uid, deviceid, plateform, eventid, eventcontent, begintime, uploadtime, ip, version, "
            "pmenu, menu, net, channel, client, os, subplateform, p_day")

SRC = f"""src AS (
  SELECT *, CASE WHEN coalesce(plateform = 'ios', false) AND {jtrim("coalesce(eventcontent, '')")} <> ''
                 AND len(ios) > 0 THEN {dedup_json('ios')} ELSE eventcontent END AS source
  FROM (SELECT *, {ios_entries('eventcontent')} AS ios FROM logs) x
)"""


def _detail_row(attribute, target, datatype, ps, es, plat, status):
    q = lambda s: "NULL::VARCHAR" if s is None else f"'{s}'"
    return (f"{{'attribute': '{attribute}', 'target_attribute': '{target}', 'datatype': '{datatype}', "
            f"'ps': {q(ps)}, 'es_ps': {q(es)}, 'plateform': {plat}, 'status': {status}}}")


_URL_PLAT = ("(CASE WHEN t % 4 = 0 THEN 'all' WHEN t % 4 = 1 THEN 'IOS' WHEN t % 4 = 2 THEN 'android' "
             "ELSE 'H5' END)")
_UID_PLAT = "(CASE WHEN t % 20 = 0 THEN 'all' ELSE 'ios' END)"
_COMMON = [
    _detail_row("k", "k_val", "string", None, None, "'all'", 1),
    _detail_row("url", "link", "url", "page,ref,utm_source,x,q", "page_no,ref_code,src,,", _URL_PLAT, 1),
    _detail_row("uid", "user_ref", "string", None, None, _UID_PLAT, 1),
    _detail_row("K", "never", "string", None, None, "'all'", 1),
    _detail_row("k", "k_old", "string", None, None, "'all'", 0),
]
_LATE = [_detail_row("k", "k_dup", "string", None, None, "'all'", 1),
         _detail_row("tags", "tags_copy", "string", None, None, "'all'", 1)]
_EARLY = [_detail_row("tags", "tags_n", "number", None, None, "'all'", 1)]

MAPPING = f"""actions AS (SELECT DISTINCT CAST(eventid AS BIGINT) AS a FROM logs),
mapper AS (SELECT a AS action_id, unnest(CASE WHEN a <= 2 THEN [a * 10, a * 10 + 5] ELSE [a * 10] END) AS template_id
           FROM actions),
template AS (SELECT DISTINCT template_id AS id FROM mapper WHERE template_id <> 30),
templates AS (SELECT DISTINCT template_id AS t FROM mapper),
detail_raw AS (SELECT t AS template_id,
                 unnest(CASE WHEN t % 10 = 5 THEN [{', '.join(_COMMON + _LATE)}]
                        ELSE [{', '.join(_COMMON + _EARLY)}] END) AS d FROM templates),
detail AS (SELECT template_id, d.attribute AS attribute, d.target_attribute AS target_attribute,
                  d.datatype AS datatype, d.ps AS ps, d.es_ps AS es_ps, d.plateform AS plateform, d.status AS status
           FROM detail_raw),
mt AS (SELECT m.action_id, m.template_id FROM mapper m LEFT JOIN template tp ON m.template_id = tp.id),
act AS (SELECT action_id, max(template_id) AS template_id FROM mt GROUP BY action_id),
det AS (SELECT template_id, attribute,
               max({{'target_attribute': target_attribute, 'datatype': datatype, 'ps': ps, 'es_ps': es_ps,
                    'plateform': plateform}}) AS a
        FROM detail WHERE status = 1 GROUP BY template_id, attribute),
mapping_flat AS (SELECT act.action_id, det.attribute, det.a.target_attribute AS target_attribute,
                        det.a.datatype AS datatype, det.a.ps AS ps, det.a.es_ps AS es_ps, det.a.plateform AS plateform
                 FROM act JOIN det ON act.template_id = det.template_id)"""

# Payload: one row per (event, applicable attribute), fields computed per row,
# re-aggregated per event in attribute order.
PAYLOAD = f"""obj AS (
  SELECT eid, source,
         CASE WHEN (CASE WHEN json_valid(source) THEN json_type(source) = 'OBJECT' ELSE false END)
              THEN json_keys(source) ELSE []::VARCHAR[] END AS keys
  FROM src),
attr_rows AS (
  SELECT o.eid, o.source, m.*,
         CASE WHEN list_contains(o.keys, m.attribute)
              THEN json_extract_string(o.source, '$."' || m.attribute || '"') ELSE '' END AS v
  FROM obj o JOIN src s ON o.eid = s.eid
  JOIN mapping_flat m ON m.action_id = CAST(s.eventid AS BIGINT)
  WHERE list_contains(list_transform(o.keys, lambda k: lower({jtrim('k')})), m.attribute)
    AND coalesce(lower(m.plateform) = 'all' OR lower(m.plateform) = lower(s.plateform), false)),
field_rows AS (
  SELECT eid, attribute,
    CASE WHEN datatype = 'string' AND v IS NOT NULL AND target_attribute IS NOT NULL
           THEN [{{'key': target_attribute, 'value': v}}]
         WHEN datatype = 'url' AND v IS NOT NULL AND ps IS NOT NULL AND es_ps IS NOT NULL AND {url_ok('v')}
           THEN [{{'key': 'domain', 'value': {url_domain('v')}}}, {{'key': 'path', 'value': {url_path('v')}}}]
                || {renamed('v', 'ps', 'es_ps')}
         ELSE []::STRUCT(key VARCHAR, value VARCHAR)[] END AS f
  FROM attr_rows),
derived AS (SELECT eid, flatten(list(f ORDER BY attribute)) AS d FROM field_rows GROUP BY eid),
payload AS (
  SELECT s.eid, coalesce(len(d.d), 0) AS n_fields,
         {dedup_json("(CASE WHEN s.source IS NULL THEN []::STRUCT(key VARCHAR, value VARCHAR)[] ELSE [{'key': 'source', 'value': s.source}] END) || coalesce(d.d, []::STRUCT(key VARCHAR, value VARCHAR)[])")} AS eventcontent
  FROM src s LEFT JOIN derived d ON s.eid = d.eid)"""


def _trade() -> str:
    return """trade AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN 'o' || CAST(o_orderkey - 1 AS VARCHAR)
              ELSE 'o' || CAST(o_orderkey AS VARCHAR) END AS uuid,
    o_custkey AS uid, o_orderkey * 10 AS schemeid, 'i' || CAST(o_orderkey % 1000 AS VARCHAR) AS issueno,
    CAST(o_orderkey % 7 AS INTEGER) AS lotteryid, CAST(o_orderkey % 5 AS INTEGER) AS playtypeid,
    CAST(o_orderkey % 3 AS INTEGER) AS superplaytypeid, o_orderpriority AS betnumber,
    CAST(o_custkey % 20 AS INTEGER) AS hteamid, 't' || CAST(o_custkey % 20 AS VARCHAR) AS hteam,
    CAST((o_custkey + 7) % 20 AS INTEGER) AS vteamid, 't' || CAST((o_custkey + 7) % 20 AS VARCHAR) AS vteam,
    o_custkey % 9 AS tournamentid, 'cup' || CAST(o_custkey % 9 AS VARCHAR) AS tournamentname,
    o_orderstatus AS matchresult, CAST(o_orderstatus = 'F' AS INTEGER) AS iswin, o_orderdate AS datetime,
    'pc' || CAST(o_orderkey % 4 AS VARCHAR) AS platformcode, CAST(o_orderkey % 4 + 1 AS INTEGER) AS multiple,
    '1x1' AS bunch, '1.5' AS betsp, '2.0' AS winsp, o_totalprice AS money,
    strftime(o_orderdate, '%Y-%m-%d') AS p_day
  FROM orders),
existing AS (SELECT uuid AS _id, p_day FROM trade WHERE matchresult = 'F' AND uuid IS NOT NULL)"""


USERS = """users AS (
  SELECT c_custkey AS uid,
    CASE WHEN c_custkey % 5 = 0 THEN ' ' || c_name || chr(9) ELSE c_name END AS username,
    TIMESTAMP '2017-01-01 00:00:00'
      + to_minutes(c_custkey * 525600 // (SELECT max(c_custkey) FROM customer)) AS registerdate,
    CASE WHEN c_custkey % 4 = 0 THEN 'iPhone' WHEN c_custkey % 4 = 1 THEN ' Android '
         WHEN c_custkey % 4 = 2 THEN NULL ELSE 'H5' END AS registerplateform,
    ' v' || CAST(c_custkey % 3 AS VARCHAR) || ' ' AS app_version,
    c_mktsegment AS channel,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'os' || CAST(c_custkey % 5 AS VARCHAR) END AS phone_os,
    'phone-' || CAST(c_nationkey AS VARCHAR) AS phone_name
  FROM customer)"""


def _platform(p: str) -> str:
    return f"(CASE WHEN lower({jtrim(p)}) = 'iphone' THEN 'ios' ELSE lower({jtrim(p)}) END)"


def _user_base(alias: str = "u") -> str:
    return (f"{alias}.uid AS uid, {jtrim(f'coalesce({alias}.username, {chr(39)}{chr(39)})')} AS username, "
            f"strftime({alias}.registerdate, '%Y-%m-%d') AS register_day, "
            f"strftime({alias}.registerdate, '%Y-%m-%d %H:%M:%S') AS register_time, "
            f"coalesce({_platform(f'{alias}.registerplateform')}, '') AS register_plateform, "
            f"coalesce({alias}.app_version, '') AS register_app_version, "
            f"{jtrim(f'coalesce({alias}.channel, {chr(39)}{chr(39)})')} AS register_channel, "
            f"{jtrim(f'coalesce({alias}.phone_os, {chr(39)}{chr(39)})')} AS register_phone_os, "
            f"{jtrim(f'coalesce({alias}.phone_name, {chr(39)}{chr(39)})')} AS register_phone_name")


LINES = """lines AS (
  SELECT concat_ws('#',
    CASE WHEN c_custkey % 17 = 0 THEN 'x' WHEN c_custkey % 19 = 0 THEN '0'
         WHEN c_custkey % 13 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 24, '0') ELSE ' ' || CAST(c_custkey AS VARCHAR) END,
    replace(c_name, '#', ''),
    CASE WHEN c_custkey % 29 = 0 THEN '2017-13-01 10:00:00' WHEN c_custkey % 31 = 0 THEN '2017-1-2 3:4:5'
         WHEN c_custkey % 37 = 0 THEN '2017-01-02 03:04:05.0' WHEN c_custkey % 43 = 0 THEN '2017-01-02'
         ELSE strftime(TIMESTAMP '2017-01-01 00:00:00' + to_hours(CAST(c_custkey * 5 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END,
    c_mktsegment,
    'os' || CAST(c_custkey % 5 AS VARCHAR),
    CASE WHEN c_custkey % 3 = 0 THEN ' iPhone' WHEN c_custkey % 3 = 1 THEN 'Android' ELSE 'H5 ' END,
    ' v' || CAST(c_custkey % 4 AS VARCHAR),
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE '"p' || CAST(c_custkey % 11 AS VARCHAR) || '"' END) AS value
  FROM customer)"""

def _field(group: int) -> str:
    shape = r"^\s*([0-9]+)-\s*([0-9]+)-\s*([0-9]+) \s*([0-9]+):\s*([0-9]+):\s*([0-9]+)"
    return f"TRY_CAST(regexp_extract({jtrim('parts[3]')}, '{shape}', {group}) AS BIGINT)"


PARSED = f"""parsed AS (
  SELECT value, parts, len(parts) AS n,
         TRY_CAST(regexp_extract({jtrim('parts[1]')}, '^[+]?(-?[0-9]+)$', 1) AS BIGINT) AS uid0,
         make_date(CAST(d[1] + floor((d[2] - 1) / 12) AS BIGINT), CAST((d[2] - 1) % 12 + 1 AS BIGINT), 1)
           + to_days(CAST(d[3] - 1 AS INTEGER)) + to_hours(d[4]) + to_minutes(d[5]) + to_seconds(d[6]) AS ts
  FROM (SELECT value, parts, [{', '.join(_field(g) for g in range(1, 7))}] AS d
        FROM (SELECT value, string_split(value, '#') AS parts FROM lines) x) y),
checked AS (
  SELECT *, CASE WHEN n >= 8 AND uid0 IS NOT NULL AND ts IS NOT NULL THEN uid0 ELSE 0 END AS uid FROM parsed)"""


def _idcards() -> str:
    provinces = ", ".join(f"'{p}'" for p in ["11", "32", "44", "51", "65", "81"])
    return f"""idsrc AS (
  SELECT c_custkey AS k,
         (CASE WHEN c_custkey % 41 = 0 THEN '99' ELSE [{provinces}][CAST(c_custkey % 6 + 1 AS INTEGER)] END)
         || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
         || strftime(DATE '1950-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER), '%Y%m%d')
         || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS h
  FROM customer),
idc AS (
  SELECT k AS uid,
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN ''
         WHEN k % 83 = 0 THEN substr(h, 1, 10) || 'AB12C'
         WHEN k % 7 = 0 THEN substr(h, 1, 6) || substr(h, 9, 9)
         WHEN k % 11 = 0 THEN ' ' || h || upper({check(psum('h'))}) || ' '
         WHEN k % 13 = 0 THEN lower(h || upper({check(psum('h'))}))
         WHEN k % 3 = 0 THEN h || CASE WHEN {check(psum('h'))} = '1' THEN '2' ELSE '1' END
         ELSE h || upper({check(psum('h'))}) END AS idcard
  FROM idsrc)"""


def _converted(as_of: str) -> str:
    """conv: t, converted (15 -> 18), valid_any, birth15 (lenient yyMMdd)."""
    t = "t"
    birth = yymmdd(t, as_of)
    h17 = f"(substr({t}, 1, 6) || lpad(CAST(year(birth15) AS VARCHAR), 4, '0') || substr({t}, 9, 7))"
    return f"""trimmed AS (SELECT uid, idcard, {jtrim('idcard')} AS t FROM idc),
conv0 AS (SELECT *, CASE WHEN length(t) = 15 AND {digits('t')} THEN {birth} END AS birth15 FROM trimmed),
conv AS (SELECT *,
           CASE WHEN length(t) = 15 AND {digits('t')} THEN {h17} || {check(psum(h17))} END AS converted,
           coalesce(length(t) = 15 AND {digits('t')}, false) OR {valid18('t')} AS valid_any
         FROM conv0)"""


def _province(code: str) -> str:
    return "(CASE " + code + " " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in PROVINCES) + " ELSE '' END)"


def _enriched(as_of: str) -> str:
    y = "TRY_CAST(substr(id18, 7, 4) AS INTEGER)"
    m = "TRY_CAST(substr(id18, 11, 2) AS INTEGER)"
    d = "TRY_CAST(substr(id18, 13, 2) AS INTEGER)"
    return f"""{_converted(as_of)},
enr0 AS (SELECT *, CASE WHEN length(t) = 15 THEN converted ELSE t END AS id18 FROM conv WHERE valid_any),
enr AS (
  SELECT uid, idcard,
         CASE WHEN TRY_CAST(substr(id18, 17, 1) AS INTEGER) % 2 <> 0 THEN 1 ELSE 2 END AS gender,
         {_province('substr(id18, 1, 2)')} AS birth_province,
         coalesce(CASE WHEN {y} >= 1 THEN strftime({lenient(y, m, d)}, '%Y-%m-%d %H:%M:%S') END, '') AS birthday
  FROM enr0),
cards AS (SELECT uid, idcard, CAST(gender AS INTEGER) AS gender, birth_province, birthday
          FROM enr WHERE birthday <> '' AND idcard <> '')"""


def _strict(as_of: str) -> str:
    a = date.fromisoformat(as_of)
    yy, mm, dd = ("TRY_CAST(substr(idcard, 7, 2) AS INTEGER)", "TRY_CAST(substr(idcard, 9, 2) AS INTEGER)",
                  "TRY_CAST(substr(idcard, 11, 2) AS INTEGER)")
    codes = ", ".join(f"'{c}'" for c, _ in PROVINCES)
    by = "year(b)"
    leap = f"(({by} % 4 = 0 AND {by} % 100 <> 0) OR {by} % 400 = 0)"
    maxday = (f"(CASE WHEN {mm} IN (1, 3, 5, 7, 8, 10, 12) THEN 31 WHEN {mm} IN (4, 6, 9, 11) THEN 30 "
              f"WHEN {leap} THEN 29 ELSE 28 END)")
    return (f"coalesce(length(idcard) = 15 AND {digits('idcard')} AND substr(idcard, 1, 2) IN ({codes}) "
            f"AND NOT (CAST(b AS TIMESTAMP) > TIMESTAMP '{a.isoformat()} 00:00:00') "
            f"AND NOT ({yy} < 50 AND {yy} > {a.year % 100}) AND {mm} BETWEEN 1 AND 12 "
            f"AND {dd} >= 1 AND {dd} <= {maxday}, false)")


def _fmt(pattern: str, col: str, guard: bool) -> str:
    p = pattern.replace("'", "''")
    m = f"regexp_full_match({col}, '{p}')"
    return f"coalesce({col} <> '' AND {m}, false)" if guard else m


def _footprint(lo: str, hi: str) -> str:
    return f"""fp AS (SELECT uid, deviceid, channel, version, plateform, begintime FROM logs
        WHERE uid > 0 AND deviceid IS NOT NULL AND deviceid <> '' AND p_day BETWEEN '{lo}' AND '{hi}'),
first_use AS (SELECT * FROM fp QUALIFY row_number() OVER (
        PARTITION BY uid, deviceid, channel, version, plateform ORDER BY begintime ASC NULLS FIRST) = 1)"""


def _ms_text(ms: str) -> str:
    return f"strftime(make_timestamp(coalesce({ms}, 0) * 1000), '%Y-%m-%d %H:%M:%S')"


def _sql() -> dict[str, str]:
    lo, hi = Q.DAY_RANGE
    all_lo, all_hi = Q.ALL_DAYS
    since_orders = (date.fromisoformat(Q.ORDERS_AS_OF) - timedelta(days=Q.ORDERS_DAYS)).isoformat()
    since_devices = (date.fromisoformat(Q.DEVICES_AS_OF) - timedelta(days=Q.DEVICES_DAYS)).isoformat()
    event_key = ("md5(CAST(coalesce(uid, 0) AS VARCHAR) || coalesce(deviceid, 'null') || "
                 "CAST(coalesce(eventid, 0) AS VARCHAR) || CAST(coalesce(begintime, 0) AS VARCHAR))")
    dev = "coalesce(deviceid, '')"
    identified = f"NOT (coalesce(uid, 0) = 0 AND {jtrim(dev)} = '')"
    user_cols = ("uid, username, register_day, register_time, register_plateform, register_app_version, "
                 "register_channel, register_phone_os, register_phone_name")
    out = {}
    out["logs_day_range"] = f"WITH {LOGS} SELECT {LOG_COLS} FROM logs WHERE p_day BETWEEN '{lo}' AND '{hi}'"
    out["logs_identified"] = (f"WITH {LOGS} SELECT uid, deviceid, eventid, begintime, p_day FROM logs "
                              f"WHERE {identified}")
    out["log_event_key"] = f"WITH {LOGS} SELECT {event_key} AS _id, uid, deviceid, eventid, begintime FROM logs"
    out["log_event_clock"] = (
        f"WITH {LOGS} SELECT uid, eventid, begintime, "
        f"CAST(hour(make_timestamp(begintime * 1000)) AS INTEGER) AS hour, "
        f"CAST(minute(make_timestamp(begintime * 1000)) AS INTEGER) AS minute, "
        f"{_ms_text('begintime')} AS eventtime FROM logs")
    out["payload_ios_pairs"] = (
        f"WITH {LOGS}, {SRC} SELECT begintime, plateform, eventcontent, "
        f"CAST(len(list_distinct(list_transform(ios, lambda e: e.key))) AS INTEGER) AS n_pairs, "
        f"{dedup_json('ios')} AS pairs, source, CAST(to_json(MAP {{'source': source}}) AS VARCHAR) AS wrapped FROM src")
    is_obj = "(CASE WHEN json_valid(source) THEN json_type(source) = 'OBJECT' ELSE false END)"
    vals = ", ".join(f"CASE WHEN {is_obj} THEN coalesce(json_extract_string(source, '$.\"{a}\"'), '') END AS {a}_value"
                     for a in ("k", "url", "uid"))
    out["payload_json"] = (
        f"WITH {LOGS}, {SRC} SELECT begintime, source, coalesce({is_obj}, false) AS is_object, "
        f"CASE WHEN {is_obj} THEN array_to_string(list_sort(list_distinct(list_transform(json_keys(source), "
        f"lambda k: lower({jtrim('k')})))), ',') END AS keys, {vals} FROM src")
    out["event_mapping"] = (f"WITH {LOGS}, {MAPPING} SELECT action_id, attribute, target_attribute, datatype, "
                            f"ps, es_ps, plateform FROM mapping_flat")
    out["log_mapped_attributes"] = (
        f"WITH {LOGS}, {SRC}, {MAPPING}, {PAYLOAD} SELECT s.begintime, s.uid, s.eventid, s.plateform, "
        f"CAST(p.n_fields AS INTEGER) AS n_fields, p.eventcontent FROM src s JOIN payload p ON s.eid = p.eid")
    ok = url_ok("url")
    out["url_domain_path"] = (f"SELECT page_id, url, CASE WHEN {ok} THEN {url_domain('url')} END AS domain, "
                              f"CASE WHEN {ok} THEN {url_path('url')} END AS path FROM pages")
    ps, es = f"'{Q.URL_PS}'", f"'{Q.URL_ES_PS}'"
    fields = (f"[{{'key': 'domain', 'value': {url_domain('url')}}}, {{'key': 'path', 'value': {url_path('url')}}}]"
              f" || {renamed('url', ps, es)}")
    out["url_query_params"] = (
        f"SELECT page_id, CAST(len({raw_pairs('url')}) AS INTEGER) AS n_params, "
        f"array_to_string(list_transform({raw_pairs('url')}, lambda kv: kv[1] || '=' || kv[2]), '&') AS raw_params, "
        f"array_to_string(list_transform({renamed('url', ps, es)}, lambda e: e.key || '=' || e.value), '&') AS renamed, "
        f"CASE WHEN {ok} THEN {dedup_json(fields)} END AS fields FROM pages")
    out["log_documents"] = (
        f"WITH {LOGS}, {SRC}, {MAPPING}, {PAYLOAD}, docs AS ("
        f" SELECT {event_key} AS _id, coalesce(uid, 0) AS uid, deviceid, plateform, coalesce(eventid, 0) AS eventid,"
        f" p.eventcontent, s.eventcontent AS raw, coalesce(begintime, 0) AS begintime, coalesce(uploadtime, 0) AS uploadtime, ip, version,"
        f" pmenu, menu, net, channel, client, os, p_day,"
        f" CAST(hour(make_timestamp(begintime * 1000)) AS INTEGER) AS hour,"
        f" CAST(minute(make_timestamp(begintime * 1000)) AS INTEGER) AS minute, {_ms_text('begintime')} AS eventtime"
        f" FROM src s JOIN payload p ON s.eid = p.eid"
        f" WHERE {identified} AND p_day BETWEEN '{all_lo}' AND '{all_hi}')"
        f" SELECT * EXCLUDE (raw) FROM docs QUALIFY row_number() OVER (PARTITION BY _id ORDER BY uploadtime DESC, raw DESC) = 1")
    out["orders_except_keys"] = f"WITH {_trade()} SELECT uuid FROM trade EXCEPT SELECT _id AS uuid FROM existing"
    out["orders_semi_join"] = (
        f"WITH {_trade()}, nk AS (SELECT uuid FROM trade EXCEPT SELECT _id AS uuid FROM existing) "
        f"SELECT uuid, uid, schemeid, p_day FROM trade WHERE uuid IN (SELECT uuid FROM nk)")
    order_fields = ("uid, schemeid, issueno, lotteryid, playtypeid, superplaytypeid, betnumber, hteamid, hteam, "
                    "vteamid, vteam, tournamentid, tournamentname, matchresult, iswin, "
                    "strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, platformcode, multiple, bunch, betsp, "
                    "winsp, money, p_day")
    out["orders_sync_new"] = (
        f"WITH {_trade()} SELECT uuid AS _id, {order_fields} FROM trade t "
        f"WHERE p_day >= '{since_orders}' AND uuid IS NOT NULL AND NOT EXISTS ("
        f"SELECT 1 FROM existing e WHERE e.p_day >= '{since_orders}' AND e._id = t.uuid) "
        f"QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY uid DESC, schemeid DESC) = 1")
    out["orders_resync"] = (
        f"WITH {_trade()}, firsts AS (SELECT uuid AS _id, uid, schemeid, betnumber, p_day FROM trade WHERE uuid IS NOT NULL), "
        f"again AS (SELECT uuid AS _id, uid, schemeid, 'again' AS betnumber, '{Q.RESYNC_DAY}' AS p_day FROM trade "
        f"WHERE matchresult = 'O' AND uuid IS NOT NULL) "
        f"SELECT * FROM (SELECT * FROM again UNION ALL SELECT * FROM firsts WHERE _id NOT IN (SELECT _id FROM again)) "
        f"QUALIFY row_number() OVER (PARTITION BY _id ORDER BY uid DESC, schemeid DESC) = 1")
    out["users_text_parse"] = (
        f"WITH {LINES}, {PARSED} SELECT uid, {jtrim('parts[2]')} AS username, "
        f"strftime(ts, '%Y-%m-%d') AS register_day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS register_time, "
        f"{_platform('parts[6]')} AS register_plateform, {jtrim('parts[7]')} AS register_app_version, "
        f"{jtrim('parts[4]')} AS register_channel, {jtrim('parts[5]')} AS register_phone_os, "
        f"{jtrim('parts[8]')} AS register_phone_name FROM checked WHERE uid <> 0")
    out["users_text_quarantine"] = f"WITH {LINES}, {PARSED} SELECT value AS line FROM checked WHERE uid = 0"
    out["users_high_water"] = "SELECT CAST(coalesce(max(c_custkey), -1) AS BIGINT) AS max_uid FROM customer"
    loaded = f"SELECT * FROM users WHERE registerdate < TIMESTAMP '{Q.USERS_LOADED_BEFORE}'"
    out["users_incremental"] = (
        f"WITH {USERS}, hw AS (SELECT CAST(coalesce(max(uid), -1) AS BIGINT) AS m FROM ({loaded}) x) "
        f"SELECT {_user_base('u')} FROM users u, hw WHERE u.uid > hw.m AND hw.m > 0 "
        f"AND u.registerdate < TIMESTAMP '{Q.USERS_AS_OF}' - INTERVAL 5 MINUTE")
    out["devices_recent"] = (
        "WITH firsts AS (SELECT event_id // 4 AS dev, "
        "min({'ms': epoch_us(ts) // 1000, 'event_id': event_id, 'user_id': user_id}) AS f FROM events GROUP BY 1), "
        "dv AS (SELECT f.user_id AS uid, strftime(make_timestamp(f.ms * 1000), '%Y-%m-%d') AS registerday, "
        "'dev' || CAST(dev AS VARCHAR) AS deviceid, f.ms AS registertime, "
        "CASE WHEN f.event_id % 3 = 0 THEN 'ios' WHEN f.event_id % 3 = 1 THEN 'android' ELSE 'h5' END AS registerplateform, "
        "'c' || CAST(f.event_id % 4 AS VARCHAR) AS channel, 'v' || CAST(f.event_id % 3 AS VARCHAR) AS version FROM firsts) "
        f"SELECT deviceid AS _id, uid, deviceid, registerday AS register_day, {_ms_text('registertime')} AS register_time, "
        "registerplateform AS register_plateform, version AS register_app_version, channel AS register_channel "
        f"FROM dv WHERE registerday >= '{since_devices}'")
    out["tracks_first_use"] = (f"WITH {LOGS}, {_footprint(all_lo, all_hi)} SELECT uid, deviceid, channel, version, "
                               f"plateform, begintime, {_ms_text('begintime')} AS firstUseTime FROM first_use")
    out["tracks_row_number"] = (f"WITH {LOGS}, {_footprint(all_lo, all_hi)} SELECT uid, deviceid, channel, version, "
                                f"plateform, begintime FROM first_use")
    out["tracks_by_user"] = (
        f"WITH {LOGS}, {_footprint(all_lo, all_hi)}, tr AS (SELECT uid, deviceid, channel, version, plateform, "
        f"{_ms_text('begintime')} AS ft FROM first_use) "
        "SELECT uid, to_json(list({'deviceid': deviceid, 'channel': channel, 'app_version': version, "
        "'plateform': plateform, 'firstUseTime': ft} ORDER BY deviceid, channel, version, plateform, ft))::VARCHAR AS base_track "
        "FROM tr GROUP BY uid")
    out["tracks_two_runs"] = out["tracks_by_user"]
    head = "substr(idcard, 1, 17)"
    ps17 = f"CASE WHEN {digits(head)} AND length({head}) = 17 THEN {psum(head)} END"
    out["idcard_checksum"] = (
        f"WITH {_idcards()} SELECT uid, idcard, {digits('idcard')} AS is_digits, {ps17} AS power_sum, "
        f"{check(ps17)} AS check_code, {valid18('idcard')} AS valid_18 FROM idc")
    out["idcard_convert15"] = (f"WITH {_idcards()}, {_converted(Q.IDCARD_AS_OF)} "
                               f"SELECT uid, idcard, converted, valid_any FROM conv")
    out["idcard_formats"] = (
        f"WITH {_idcards()}, st AS (SELECT *, CASE WHEN length(idcard) = 15 AND {digits('idcard')} "
        f"THEN {yymmdd('idcard', Q.IDCARD_AS_OF)} END AS b FROM idc) "
        f"SELECT uid, idcard, {_fmt(FORMAT_ANY, 'idcard', True)} AS format_any, "
        f"{_fmt(FORMAT_15, 'idcard', True)} AS format_15, {_fmt(FORMAT_18, 'idcard', False)} AS format_18, "
        f"{_strict(Q.IDCARD_AS_OF)} AS valid_15_strict FROM st")
    out["idcard_enrich"] = f"WITH {_idcards()}, {_enriched(Q.IDCARD_AS_OF)} SELECT * FROM cards"
    target = f"target AS (SELECT {_user_base('u')} FROM ({loaded}) u)"
    out["upsert_users"] = (
        f"WITH {USERS}, {target}, {_idcards()}, {_enriched(Q.IDCARD_AS_OF)} "
        f"SELECT coalesce(c.uid, t.uid) AS uid, t.username, t.register_day, t.register_time, t.register_plateform, "
        f"t.register_app_version, t.register_channel, t.register_phone_os, t.register_phone_name, "
        f"c.idcard, c.gender, c.birth_province, c.birthday FROM target t FULL OUTER JOIN cards c ON t.uid = c.uid")
    out["replace_users"] = (
        f"WITH {USERS}, {target}, {_idcards()}, {_enriched(Q.IDCARD_AS_OF)} "
        f"SELECT {user_cols}, NULL::VARCHAR AS idcard, NULL::INTEGER AS gender, NULL::VARCHAR AS birth_province, "
        f"NULL::VARCHAR AS birthday FROM target WHERE uid NOT IN (SELECT uid FROM cards) "
        f"UNION ALL SELECT uid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, idcard, gender, birth_province, "
        f"birthday FROM cards")
    return out


ORACLE_SQL: dict[str, str] = _sql()
