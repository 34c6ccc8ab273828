"""DuckDB oracle SQL for every driver query (same column names and types).

Each statement computes the expected relation directly from the driver
tables, mirroring the fixture rules in ``sources.fixtures``.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


TS = "'%Y-%m-%dT%H:%M:%SZ'"
TS_MICROS = "'%Y-%m-%dT%H:%M:%S.%fZ'"

oracle("stale_candidates", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS issue_id, strftime(m.last_ship, {TS}) AS last_message_time
FROM orders o
JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) m
  ON m.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'O' AND o.o_orderpriority = '1-URGENT'
  AND m.last_ship < TIMESTAMP '1999-12-25 00:00:00'
""")

# ------------------------------------------------------------------ ingest
oracle("ingest_pages_items", """
SELECT CAST(c_custkey AS VARCHAR) AS account_id, CAST(c_custkey // 100 AS BIGINT) AS page_no,
       row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS pos,
       c_name AS name, c_mktsegment AS segment
FROM customer
""")

_PAGES = """
c AS (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS run, CAST(c_custkey // 100 AS BIGINT) AS page FROM customer),
p AS (SELECT run, page, count(*) AS n FROM c GROUP BY run, page),
f AS (SELECT run, page, CASE WHEN (run + page) % 11 = 0 THEN 0 ELSE n END AS n_items FROM p)"""


def _cut_oracle(cont: str) -> str:
    return f"""
WITH {_PAGES},
w AS (SELECT *, coalesce(bool_or(NOT ({cont})) OVER (PARTITION BY run ORDER BY page
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM f),
k AS (SELECT run, page FROM w WHERE NOT stopped AND n_items > 0)
SELECT CAST(c.run AS VARCHAR) AS run_id, c.page AS page_no,
       row_number() OVER (PARTITION BY c.run, c.page ORDER BY c.c_custkey) - 1 AS pos,
       CAST(c.c_custkey AS VARCHAR) AS account_id
FROM c JOIN k ON c.run = k.run AND c.page = k.page
WHERE (c.run + c.page) % 11 <> 0
"""


oracle("ingest_cursor_cut", _cut_oracle(
    "n_items > 0 AND NOT (run % 7 = 0 AND page = 2) AND page <> run % 5 + 3"))
oracle("ingest_offset_cut", _cut_oracle("n_items > 0 AND page <> run % 4 + 5"))

oracle("ingest_offset_gaps", f"""
WITH {_PAGES},
o AS (SELECT run, page, n_items,
        CAST(coalesce(sum(n_items) OVER (PARTITION BY run ORDER BY page
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + CASE WHEN run % 6 = 1 AND page = 4 THEN 1 ELSE 0 END AS BIGINT) AS off FROM f),
g AS (SELECT a.run, a.page, a.off,
        CAST(CASE WHEN a.page = 0 THEN 0 ELSE b.off + b.n_items END AS BIGINT) AS expected
      FROM o a LEFT JOIN o b ON b.run = a.run AND b.page = a.page - 1)
SELECT CAST(run AS VARCHAR) AS run_id, page AS page_no, off AS "offset", expected AS expected_offset
FROM g WHERE off IS DISTINCT FROM expected
""")

oracle("ingest_rejects", """
SELECT 'issues' AS object_type,
       CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0
            THEN 'missing_id' ELSE 'ok' END AS reason, count(*) AS n
FROM orders GROUP BY 1, 2
UNION ALL
SELECT 'messages', CASE WHEN l_orderkey % 101 = 0 THEN 'missing_issue_id' ELSE 'ok' END, count(*)
FROM lineitem GROUP BY 1, 2
""")

oracle("ingest_contacts_by_account", """
SELECT 'ct' || CAST(c_custkey AS VARCHAR) AS contact_id, CAST(c_nationkey AS VARCHAR) AS account_id,
       c_name AS name
FROM customer WHERE c_custkey % 10 <> 0 AND c_nationkey = 7
""")

oracle("ingest_issue_messages", """
SELECT CAST(conv_id AS VARCHAR) AS issue_id, CAST(turn AS VARCHAR) AS message_id,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       CASE role WHEN 'user' THEN 'user' || CAST(conv_id AS VARCHAR) || '@customer.example'
                 WHEN 'assistant' THEN 'agent' || CAST(conv_id % 13 AS VARCHAR) || '@staff.example' END AS author
FROM conversations WHERE conv_id % 13 <> 0
""")

ISSUE_STATE = ("CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'waiting_on_customer' "
               "WHEN 'P' THEN 'on_hold' ELSE o_orderstatus END")

oracle("point_lookup", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id, {ISSUE_STATE} AS state,
       strftime(o_orderdate, {TS}) AS created_at
FROM orders WHERE o_orderkey IN (1, 2)
""")

oracle("keyed_lookup", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id, CASE WHEN o_orderkey % 2 = 0 THEN 'closed' ELSE {ISSUE_STATE} END AS state
FROM orders WHERE o_orderkey IN (1, 2)
""")

oracle("record_cap", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS rank, CAST(o_orderkey AS VARCHAR) AS issue_id
FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 500) t
""")

oracle("ndjson_load", f"""
SELECT event_id, event_type, strftime(ts, {TS_MICROS}) AS ts,
       '2024-02-01T12:00:00.000000Z' AS updated_at
FROM events
""")

# ------------------------------------------------------------------ filters
oracle("filter_equals", "SELECT event_id FROM events WHERE event_type = 'click'")
oracle("filter_in", "SELECT event_id FROM events WHERE event_type IN ('view', 'purchase')")
oracle("filter_time_range", """
SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
""")
oracle("filter_after", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00'")
oracle("filter_before", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-05 00:00:00'")
oracle("filter_and_extra", """
SELECT event_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 00:00:00'
  AND event_type IN ('purchase', 'signup') AND NOT (value < 5)
""")
oracle("filter_shaped", "SELECT event_id FROM events WHERE value < 5 AND event_type = 'error'")

oracle("chunk_30d", f"""
WITH t AS (SELECT o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS m FROM orders),
c AS (SELECT CASE
        WHEN m >= TIMESTAMP '1996-01-01' AND m < TIMESTAMP '1999-06-15'
          THEN CAST(floor((epoch_us(m) - epoch_us(TIMESTAMP '1996-01-01')) / 2592000000000) AS BIGINT)
        WHEN m = TIMESTAMP '1999-06-15'
          THEN CAST(ceil((epoch_us(TIMESTAMP '1999-06-15') - epoch_us(TIMESTAMP '1996-01-01')) / 2592000000000) AS BIGINT) - 1
      END AS chunk_no FROM t)
SELECT chunk_no,
       strftime(TIMESTAMP '1996-01-01' + to_days(CAST(30 * chunk_no AS INTEGER)), {TS}) AS chunk_start,
       strftime(least(TIMESTAMP '1996-01-01' + to_days(CAST(30 * (chunk_no + 1) AS INTEGER)),
                      TIMESTAMP '1999-06-15'), {TS}) AS chunk_end,
       count(*) AS n
FROM c WHERE chunk_no IS NOT NULL GROUP BY chunk_no
""")


def _ids_oracle(window: bool, state: str | None) -> str:
    lo, hi = "TIMESTAMP '1997-03-01'", "TIMESTAMP '1997-06-30'"
    fp, jp = ["TRUE"], ["TRUE"]
    if window:
        fp.append(f"(o_orderdate BETWEEN {lo} AND {hi} OR ls BETWEEN {lo} AND {hi})")
        jp.append(f"(o_orderdate BETWEEN {lo} AND {hi} OR "
                  f"o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) BETWEEN {lo} AND {hi})")
    if state:
        disp = ("CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Waiting on Customer' "
                "WHEN 'P' THEN 'On Hold' END")
        fp.append(f"{disp} = '{state}'")
        jp.append(f"{ISSUE_STATE} = '{state.lower().replace(' ', '_')}'")
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id FROM orders o
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ls FROM lineitem GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
WHERE {' AND '.join(fp)}
UNION
SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE {' AND '.join(jp)}
"""


oracle("issue_ids_window", _ids_oracle(True, None))
oracle("issue_ids_state", _ids_oracle(False, "Waiting on Customer"))
oracle("issue_ids_union", _ids_oracle(True, "Closed"))
oracle("issue_ids_by_code", _ids_oracle(False, "On Hold"))

# ------------------------------------------------------------------ JSON
oracle("json_scalar", """
SELECT event_id, json_extract_string(props, '$.k') AS p_k, CAST(NULL AS VARCHAR) AS o,
       CAST(user_id AS VARCHAR) AS o_x, CAST(NULL AS VARCHAR) AS a, CAST(event_id AS VARCHAR) AS a0,
       CAST(NULL AS VARCHAR) AS n, event_type AS s,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS t, '' AS e,
       CAST(NULL AS VARCHAR) AS missing
FROM events
""")

_TEAM_MEMBERS = """
SELECT 'n' || CAST(n.n_nationkey AS VARCHAR) AS team_id, n.n_name AS team_name, s.s_suppkey
FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey
UNION ALL
SELECT 'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name, s.s_suppkey
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey JOIN supplier s ON s.s_nationkey = n.n_nationkey
"""
STAFF_EMAIL = "CASE WHEN s_suppkey % 10 <> 9 THEN 'agent' || CAST(s_suppkey AS VARCHAR) || '@staff.example' END"

oracle("json_array_unnest", f"""
SELECT team_id, 's' || CAST(s_suppkey AS VARCHAR) AS user_id, {STAFF_EMAIL} AS email
FROM ({_TEAM_MEMBERS}) m
""")

oracle("json_ts", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id, strftime(o_orderdate, {TS}) AS created_at,
       CAST(epoch(o_orderdate) AS BIGINT) AS created_epoch
FROM orders
""")

# ------------------------------------------------------------------ dedup
_LI_TIES = ("l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, "
            "l_returnflag, l_linestatus")


def _dedup_oracle(order: str) -> str:
    return f"""
SELECT issue_id, message_id, l_partkey, l_suppkey FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS issue_id, CAST(l_linenumber AS VARCHAR) AS message_id,
         l_partkey, l_suppkey,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM lineitem) t
WHERE rn = 1
"""


oracle("dedup_first", _dedup_oracle(f"l_shipdate, {_LI_TIES}"))
oracle("dedup_latest", _dedup_oracle(f"l_shipdate DESC, {_LI_TIES}"))
oracle("dedup_counts", """
SELECT count(*) AS original, CAST(0 AS BIGINT) AS null_keys,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS kept,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS removed
FROM lineitem
""")

# ------------------------------------------------------------------ upsert
oracle("upsert_merge", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id,
       CASE WHEN o_orderdate >= DATE '1995-01-01' THEN 'closed' ELSE {ISSUE_STATE} END AS state
FROM orders
""")
oracle("upsert_batches", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS issue_id,
       CASE WHEN o_orderdate >= DATE '1996-06-01' THEN 'new'
            WHEN o_orderdate >= DATE '1995-01-01' THEN 'closed'
            WHEN o_orderdate >= DATE '1994-01-01' THEN 'on_hold' ELSE {ISSUE_STATE} END AS state
FROM orders
""")
oracle("truncate_audit", """
SELECT 'accounts' AS table_name, CAST(count(*) AS BIGINT) AS rows_before, CAST(0 AS BIGINT) AS rows_after
FROM customer
""")
oracle("high_water_mark", f"SELECT strftime(max(ts), {TS_MICROS}) AS high_water_mark FROM events")
oracle("incremental_cut", """
SELECT event_id FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00')
""")

# ------------------------------------------------------------------ text + threads
# What a tag is, the entities in the order they are decoded, and
# Unicode white space, written out here apart from the code under test.
_TAG = "<[^>]+>"
_ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
_SPACES = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_strip(expr: str) -> str:
    """J8 in DuckDB: same tag pattern, same entity order, same whitespace class."""
    t = f"regexp_replace(coalesce({expr}, ''), {_q(_TAG)}, '', 'g')"
    for ent, rep in _ENTITIES:
        t = f"replace({t}, {_q(ent)}, {_q(rep)})"
    t = f"regexp_replace({t}, {_q(_SPACES)}, ' ', 'g')"
    return f"trim({t}, ' ')"


oracle("strip_html", f"SELECT page_id, {sql_strip('html')} AS text FROM pages")

oracle("team_directory", f"""
SELECT DISTINCT {STAFF_EMAIL} AS email, 's' || CAST(s_suppkey AS VARCHAR) AS user_id, team_name
FROM ({_TEAM_MEMBERS}) m
""")

_TEAM_OF = f"""
SELECT email, min(team_name) AS team_name FROM (
  SELECT {STAFF_EMAIL} AS email, team_name FROM ({_TEAM_MEMBERS}) m) x
WHERE email IS NOT NULL GROUP BY email
"""
_TEAM_ALL = f"""
SELECT DISTINCT {STAFF_EMAIL} AS email, 's' || CAST(s_suppkey AS VARCHAR) AS user_id, team_name
FROM ({_TEAM_MEMBERS}) m
"""
_LI_AUTHOR = ("CASE WHEN l_linenumber % 2 = 1 THEN 'agent' || CAST(l_suppkey AS VARCHAR) || '@staff.example' "
              "ELSE 'c' || CAST(l_partkey AS VARCHAR) || '@customer.example' END")


def _message_team_oracle(team_sql: str) -> str:
    return f"""
SELECT CAST(l_orderkey AS VARCHAR) AS issue_id, CAST(l_linenumber AS VARCHAR) AS message_id,
       {_LI_AUTHOR} AS author, coalesce(t.team_name, 'Customer') AS team
FROM lineitem LEFT JOIN ({team_sql}) t ON t.email = {_LI_AUTHOR}
"""


oracle("message_team", _message_team_oracle(_TEAM_OF))
oracle("message_team_fanout", _message_team_oracle(_TEAM_ALL))

_EV_AUTHOR = ("CASE WHEN event_type = 'error' THEN NULL "
              "WHEN event_type = 'purchase' THEN 'agent' || CAST(event_id % 13 AS VARCHAR) || '@staff.example' "
              "ELSE 'user' || CAST(user_id AS VARCHAR) || '@customer.example' END")
_EV_BODY = "'<div><p>' || event_type || ' &amp;&nbsp;</p>' || chr(10) || '<b>' || props || '</b></div>'"


def _line(ts: str, author: str, body: str, team: str | None) -> str:
    who = f"coalesce({author}, 'None')"
    if team:
        who = f"CASE WHEN {team} <> 'Customer' THEN {who} || '(' || {team} || ')' ELSE {who} END"
    return f"'[' || coalesce({ts}, 'None') || '] ' || {who} || ': ' || {sql_strip(body)}"


def _thread_oracle(head: int, tail: int, team_sql: str | None, fan_out: bool = False) -> str:
    team_join = ""
    team_col = "NULL"
    order = "ts, message_id"
    if team_sql:
        team_join = f"LEFT JOIN ({team_sql}) t ON t.email = m.author"
        team_col = "coalesce(t.team_name, 'Customer')"
        if fan_out:
            order = "ts, message_id, t.team_name NULLS FIRST, t.user_id NULLS FIRST"
    line = _line("ts", "author", "body", "team" if team_sql else None)
    return f"""
WITH m AS (SELECT CAST(user_id AS VARCHAR) AS issue_id, CAST(event_id AS VARCHAR) AS message_id,
                  strftime(ts, {TS_MICROS}) AS ts, {_EV_AUTHOR} AS author, {_EV_BODY} AS body FROM events),
j AS (SELECT m.*, {team_col} AS team,
             row_number() OVER (PARTITION BY issue_id ORDER BY {order}) AS rn,
             count(*) OVER (PARTITION BY issue_id) AS n
      FROM m {team_join})
SELECT issue_id, count(*) AS n_lines, string_agg({line}, chr(10) ORDER BY rn) AS conversation
FROM j WHERE rn <= {head} OR rn > n - {tail}
GROUP BY issue_id
"""


oracle("thread_triage", _thread_oracle(3, 6, _TEAM_OF))
oracle("thread_closing", _thread_oracle(5, 15, None))
oracle("thread_triage_fanout", _thread_oracle(3, 6, _TEAM_ALL, fan_out=True))

_CHAT_AUTHOR = ("CASE role WHEN 'user' THEN 'user' || CAST(conv_id AS VARCHAR) || '@customer.example' "
                "WHEN 'assistant' THEN 'agent' || CAST(conv_id % 13 AS VARCHAR) || '@staff.example' END")
_CHAT_TS = ("strftime(TIMESTAMP '2024-03-01 00:00:00' + to_hours(CAST(conv_id % 1000 AS INTEGER)) "
            f"+ to_minutes(CAST(turn AS INTEGER)), {TS})")
_CHAT = f"""
SELECT CAST(conv_id AS VARCHAR) AS issue_id, CAST(turn AS VARCHAR) AS message_id, conv_id, turn,
       {_CHAT_AUTHOR} AS author, {_CHAT_TS} AS ts, text AS body FROM conversations
"""

oracle("author_line", f"""
SELECT c.issue_id, c.message_id,
       {_line('c.ts', 'c.author', 'c.body', "coalesce(t.team_name, 'Customer')")} AS line
FROM ({_CHAT}) c LEFT JOIN ({_TEAM_OF}) t ON t.email = c.author
""")

# ------------------------------------------------------------------ triage
from .functions.prompts import system_text  # noqa: E402

# The label keys, written out here apart from the code under test.
_RESOLUTIONS = ("bug_fix feature_request referred_to_public_resource referred_with_internal_knowledge customer_love no_action").split()
_CATEGORIES = (
    "admin_authentication_access admin_billing_refunds admin_data_deletion admin_general_account_management "
    "admin_security_privacy_and_compliance langchain_oss_python anggraph_platform langgraph_studio langsmith_administration "
    "langsmith_annotations langsmith_automation_rules langsmith_dashboards langsmith_datasets_experiments langsmith_evaluation "
    "langsmith_observability langsmith_playground langsmith_pricing langsmith_prompt_hub langsmith_sdk langsmith_insights "
    "langgraph_oss_js langchain_oss_js other_partnerships other_sales other_spam other_marketing_promotional").split()


def _list(labels) -> str:
    return "[" + ", ".join(map(_q, labels)) + "]"


K = "o_orderkey"
RES_LABEL = (f"CASE WHEN {K} % 3 = 0 THEN NULL WHEN {K} % 7 = 4 THEN '' WHEN {K} % 13 = 0 THEN 'bug_fixed' "
             f"ELSE {_list(_RESOLUTIONS)}[{K} % 6 + 1] END")
CAT_LABEL = (f"CASE WHEN {K} % 5 = 0 THEN NULL WHEN {K} % 17 = 0 THEN 'langgraph_platform' "
             f"ELSE {_list(_CATEGORIES)}[{K} % 26 + 1] END")
TAGS = (f"CASE {K} % 7 WHEN 0 THEN ['vip', 'auto-classified'] WHEN 1 THEN NULL WHEN 2 THEN []::VARCHAR[] "
        f"WHEN 3 THEN ['vip', 'vip', 'auto-closed'] ELSE ['p' || substr(o_orderpriority, 1, 1)] END")


def _appended(tags: str, tag: str) -> str:
    return (f"CASE WHEN list_contains(coalesce({tags}, []::VARCHAR[]), {_q(tag)}) THEN {tags} "
            f"ELSE list_append(coalesce({tags}, []::VARCHAR[]), {_q(tag)}) END")


oracle("unclassified", f"""
SELECT row_number() OVER (ORDER BY o_orderdate DESC, issue_id) AS rank, issue_id, created_at FROM (
  SELECT CAST({K} AS VARCHAR) AS issue_id, o_orderdate, strftime(o_orderdate, {TS}) AS created_at
  FROM orders
  WHERE o_orderstatus = 'F' AND ({K} % 3 = 0 OR {K} % 5 = 0)
    AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31'
  ORDER BY o_orderdate DESC, issue_id LIMIT 250) t
""")

oracle("typed_filters", f"""
WITH i AS (SELECT {K} AS k, CASE WHEN {K} % 10 = 0 THEN 'on_hold' ELSE {ISSUE_STATE} END AS state, o_orderpriority AS p,
                  o_orderdate + to_days(CAST({K} % 30 AS INTEGER)) AS modified FROM orders)
SELECT 'unclassified' AS kind, CAST(k AS VARCHAR) AS issue_id FROM i WHERE state = 'closed' AND (k % 3 = 0 OR k % 5 = 0)
UNION ALL SELECT 'waiting', CAST(k AS VARCHAR) FROM i WHERE state = 'waiting_on_customer' AND p = '1-URGENT'
UNION ALL SELECT 'modified', CAST(k AS VARCHAR) FROM i WHERE modified BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '1996-08-01'
""")

oracle("missing_fields", f"""
SELECT issue_id, is_closed, missing, missing <> '' AS needs_classification FROM (
  SELECT CAST({K} AS VARCHAR) AS issue_id, o_orderstatus = 'F' AS is_closed,
         concat_ws(',', CASE WHEN coalesce({RES_LABEL}, '') = '' THEN 'resolution' END,
                        CASE WHEN coalesce({CAT_LABEL}, '') = '' THEN 'category' END) AS missing
  FROM orders) t
""")

_TAX_VALUES = ", ".join([f"('resolution', {_q(r)})" for r in _RESOLUTIONS] + [f"('category', {_q(c)})" for c in _CATEGORIES])
oracle("taxonomy_check", f"""
WITH l AS (SELECT 'resolution' AS field, {RES_LABEL} AS label FROM orders
           UNION ALL SELECT 'category', {CAT_LABEL} FROM orders),
t(field, label) AS (VALUES {_TAX_VALUES})
SELECT field, label, count(*) AS n FROM l
WHERE label IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.field = l.field AND t.label = l.label)
GROUP BY field, label
""")

oracle("label_recode", f"""
SELECT CAST({K} AS VARCHAR) AS issue_id,
       CASE WHEN r = 'bug_fix' THEN 'big_fix' ELSE r END AS resolution,
       CASE WHEN c = 'langgraph_platform' THEN 'langgraph_langgraph_platform' ELSE c END AS category
FROM (SELECT {K}, {RES_LABEL} AS r, {CAT_LABEL} AS c FROM orders) t
""")

oracle("tag_append", f"""
SELECT CAST({K} AS VARCHAR) AS issue_id, array_to_string({_appended(TAGS, 'auto-classified')}, '|') AS tags
FROM orders
""")


def _chat_thread(head: int, tail: int, body: str = "text") -> str:
    line = _line("ts", "author", "body", "team")
    return f"""
SELECT issue_id, conv_id, count(*) AS n_lines, string_agg({line}, chr(10) ORDER BY rn) AS conversation FROM (
  SELECT c.*, coalesce(t.team_name, 'Customer') AS team,
         row_number() OVER (PARTITION BY issue_id ORDER BY ts, message_id) AS rn,
         count(*) OVER (PARTITION BY issue_id) AS n
  FROM ({_CHAT.replace("text AS body", f"{body} AS body")}) c LEFT JOIN ({_TEAM_OF}) t ON t.email = c.author) j
WHERE rn <= {head} OR rn > n - {tail}
GROUP BY issue_id, conv_id
"""


oracle("request_text", f"""
SELECT issue_id,
       CASE conv_id % 3 WHEN 0 THEN {_q(system_text(['resolution']))}
                        WHEN 1 THEN {_q(system_text(['category']))}
                        ELSE {_q(system_text(['resolution', 'category']))} END AS system,
       '<Conversation History>' || chr(10) || conversation || chr(10) || '</Conversation History>' AS "user"
FROM ({_chat_thread(3, 6)}) x
""")

# md5 of the instruction texts (field set; plain, debug) and of the question text.
_DIGESTS = {0: ("9ff8cd46726fede12501ecceaf6ba1d0", "6f086c0c548779d7e6750328eda87b61"),
            1: ("5c842a90f95afada74921f57d3ce3993", "3c922d6f1017ba5cdca7d7be62b81e30"),
            2: ("8b7fb5ea03df257441b2f96ae2465486", "8372930bf8cbac8b84bb1a12dc8ccd65")}
_QUESTION_DIGEST = "575aaa75c29cad083e403e00814a2be6"
_CHAT_USER = "'<Conversation History>' || chr(10) || conversation || chr(10) || '</Conversation History>'"
oracle("request_digests", " UNION ALL ".join(
    f"SELECT issue_id, '{form}' AS form, CASE conv_id % 3 WHEN 0 THEN '{_DIGESTS[0][i]}' WHEN 1 THEN '{_DIGESTS[1][i]}' "
    f"ELSE '{_DIGESTS[2][i]}' END AS system_md5, {_CHAT_USER} AS \"user\" FROM ({_chat_thread(3, 6)}) x"
    for i, form in enumerate(("plain", "debug"))) + f"""
UNION ALL SELECT issue_id, 'question', '{_QUESTION_DIGEST}', {_CHAT_USER} || '' || chr(10) || '' || chr(10) || 'Pylon Issue ID: ' || issue_id FROM ({_chat_thread(3, 6)}) x
""")

oracle("response_gate", """
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'low' WHEN 1 THEN 'pass' WHEN 2 THEN 'pass' WHEN 3 THEN 'low'
                   WHEN 4 THEN 'pass' WHEN 5 THEN 'error' WHEN 6 THEN 'error' ELSE 'none' END AS gate
FROM labels
""")

_RES_OUT = "CASE WHEN {q} = 1 THEN 'big_fix' ELSE 'no_action' END"
_CAT_OUT = "CASE WHEN {t} = 1 THEN 'other_spam' ELSE 'langgraph_langgraph_platform' END"
oracle("accepted_fields", f"""
SELECT doc_id, CASE doc_id % 8
         WHEN 1 THEN 'resolution=' || {_RES_OUT.format(q='quality')}
         WHEN 2 THEN 'resolution=' || {_RES_OUT.format(q='quality')} || ';category=' || {_CAT_OUT.format(t='toxic')}
         ELSE '' END AS fields
FROM labels WHERE doc_id % 8 IN (1, 2, 4)
""")

_CLASSIFY_OUTCOME = f"""
WITH t AS (SELECT {K} AS k, * FROM orders WHERE o_orderstatus = 'F' AND ({K} % 3 = 0 OR {K} % 5 = 0)),
o AS (SELECT t.*, CASE WHEN k NOT IN (SELECT l_orderkey FROM lineitem) THEN 'no_conversation'
                        WHEN k % 9 = 0 THEN 'skipped'
                        WHEN k % 8 IN (0, 3, 7) THEN 'skipped'
                        WHEN k % 8 IN (5, 6) THEN 'exception'
                        ELSE 'updated' END AS outcome FROM t)"""

oracle("classify_report", f"""
{_CLASSIFY_OUTCOME}
SELECT count(*) AS total_processed,
       CAST(count_if(outcome IN ('updated', 'update_failed')) AS BIGINT) AS total_classified,
       CAST(count_if(outcome = 'updated') AS BIGINT) AS total_updated,
       CAST(count_if(outcome IN ('no_conversation', 'update_failed', 'exception')) AS BIGINT) AS total_errors,
       count_if(outcome IN ('no_conversation', 'update_failed', 'exception')) = 0 AS success
FROM o
""")
oracle("classify_outcomes", f"""
{_CLASSIFY_OUTCOME}
SELECT outcome, count(*) AS n FROM o GROUP BY outcome
""")
oracle("update_outbox", f"""
{_CLASSIFY_OUTCOME}
SELECT CAST(k AS VARCHAR) AS issue_id, 'classify' AS kind,
       {_RES_OUT.format(q='k % 2')} AS resolution,
       CASE WHEN k % 8 = 2 THEN {_CAT_OUT.format(t='CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END')} END AS category,
       array_to_string({_appended(TAGS, 'auto-classified')}, '|') AS tags
FROM o WHERE outcome = 'updated' AND k % 8 IN (1, 2)
""")

# ------------------------------------------------------------------ closing
_STALE = f"""
SELECT o.o_orderkey AS k, o.* FROM orders o
JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) m
  ON m.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'O' AND o.o_orderpriority = '1-URGENT'
  AND m.last_ship < TIMESTAMP '1999-12-25 00:00:00'
"""
oracle("current_state_lookup", f"""
SELECT CAST(k AS VARCHAR) AS issue_id,
       CASE WHEN k % 11 = 0 THEN 'closed' ELSE 'waiting_on_customer' END AS state
FROM ({_STALE}) s
""")

_CLOSE = f"""
WITH x AS (SELECT *, k % 11 = 0 AS closed_now, (k % 3 = 0 OR k % 7 = 4) AS res_missing,
                  (k % 5 = 0) AS cat_missing FROM ({_STALE}) s),
c AS (SELECT *, (NOT closed_now AND (res_missing OR cat_missing)) AS needs,
             CASE WHEN k % 9 = 0 THEN 'skipped' WHEN k % 8 IN (0, 3, 7) THEN 'skipped'
                  WHEN k % 8 IN (5, 6) THEN 'exception' ELSE 'updated' END AS cls FROM x),
y AS (SELECT *, needs AND cls = 'updated' AS cls_updated,
             needs AND cls = 'updated' AND k % 8 IN (1, 2) AS cls_written,
             res_missing AND NOT (needs AND cls = 'updated' AND k % 8 IN (1, 2)) AS res_left,
             cat_missing AND NOT (needs AND cls = 'updated' AND k % 8 = 2) AS cat_left FROM c),
o AS (SELECT *, CASE WHEN closed_now THEN 'already_closed'
                     WHEN res_left OR cat_left THEN 'still_unclassified'
                     WHEN k % 10 = 0 THEN 'analysis_failed'
                     WHEN k % 4 IN (0, 1) THEN 'not_resolved'
                     ELSE 'closed' END AS outcome FROM y)"""

oracle("close_outcomes", f"{_CLOSE}\nSELECT outcome, count(*) AS n FROM o GROUP BY outcome")
oracle("close_report", f"""
{_CLOSE}
SELECT count(*) AS total_processed,
       CAST(count_if(outcome IN ('closed', 'not_resolved')) AS BIGINT) AS total_analyzed,
       CAST(count_if(outcome = 'closed') AS BIGINT) AS total_closed,
       CAST(count_if(cls_updated) AS BIGINT) AS total_classified,
       CAST(count_if(outcome IN ('still_unclassified', 'no_conversation', 'analysis_failed')) AS BIGINT) AS total_errors,
       count_if(outcome IN ('still_unclassified', 'no_conversation', 'analysis_failed')) = 0 AS success
FROM o
""")
_TAGS_AFTER_CLS = f"CASE WHEN cls_written THEN {_appended(TAGS, 'auto-classified')} ELSE {TAGS} END"
oracle("close_outbox", f"""
{_CLOSE}
SELECT CAST(k AS VARCHAR) AS issue_id, 'close' AS kind, 'closed' AS state,
       array_to_string({_appended(_TAGS_AFTER_CLS, 'auto-closed')}, '|') AS tags
FROM o WHERE outcome = 'closed'
""")

oracle("question_summary", """
SELECT CAST(conv_id AS VARCHAR) AS issue_id, CAST(count_if(role = 'user') AS BIGINT) AS n_questions,
       CASE WHEN conv_id % 10 = 0 THEN false
            ELSE coalesce(bool_and(CASE WHEN role = 'user' THEN coalesce(turn < last_answer, false) END), true)
       END AS all_resolved
FROM (SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last_answer FROM conversations) c
GROUP BY conv_id
""")

oracle("messages_of_selected", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS issue_id, CAST(l_linenumber AS VARCHAR) AS message_id
FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) IN ({_ids_oracle(True, None)})
""")

# ------------------------------------------------------------------ replicate
_BAD_ID = f"({K} % 97 = 0 OR {K} % 89 = 0 OR {K} % 83 = 0)"
oracle("replicate_report", f"""
WITH r AS (
  SELECT 'accounts' AS object_type, 'accounts' AS table_name, count(*) AS total_processed,
         CAST(0 AS BIGINT) AS total_errors, count(DISTINCT c_custkey // 100) AS total_batches,
         count(*) AS rows_kept FROM customer
  UNION ALL
  SELECT 'issues', 'issues', count_if(NOT {_BAD_ID}), count_if({_BAD_ID}),
         count(DISTINCT CASE WHEN NOT {_BAD_ID} THEN {K} // 100 END), count_if(NOT {_BAD_ID}) FROM orders
  UNION ALL
  SELECT 'messages', 'messages', count(*), 0, count(DISTINCT l_orderkey),
         (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem
  UNION ALL
  SELECT 'contacts', 'contacts', count(*), 0, count(DISTINCT c_custkey // 100), count(*) FROM customer
  UNION ALL
  SELECT 'users', 'users', count(*), 0, count(DISTINCT s_suppkey // 100), count(*) FROM supplier
  UNION ALL
  SELECT 'teams', 'teams', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region), 0,
         (SELECT count(DISTINCT n_nationkey // 5) FROM nation) + (SELECT count(DISTINCT r_regionkey // 5) FROM region),
         (SELECT count(*) FROM nation) + (SELECT count(*) FROM region)),
a AS (SELECT object_type, table_name, CAST(total_processed AS BIGINT) AS total_processed,
             CAST(total_errors AS BIGINT) AS total_errors, CAST(total_batches AS BIGINT) AS total_batches,
             CAST(rows_kept AS BIGINT) AS rows_kept FROM r
      UNION ALL
      SELECT 'all', NULL, CAST(sum(total_processed) AS BIGINT), CAST(sum(total_errors) AS BIGINT),
             CAST(sum(total_batches) AS BIGINT), CAST(sum(rows_kept) AS BIGINT) FROM r)
SELECT *, total_errors = 0 AS success FROM a
""")

# The planted account pages: run, page, place, id, name (see the fixture).
_PLANTED = """p AS (
  SELECT c_custkey AS k, 'r0' AS run, c_custkey // 100 AS page, c_custkey % 100 AS pos, 'a' AS mark FROM customer
  UNION ALL SELECT c_custkey, 'r0', c_custkey // 100 + 1, 100, 'b' FROM customer WHERE c_custkey % 100 = 0
  UNION ALL SELECT c_custkey, 'r0', c_custkey // 100, 200, 'c' FROM customer WHERE c_custkey % 100 = 7
  UNION ALL SELECT c_custkey, 'r1', c_custkey // 500, c_custkey % 500, 'd' FROM customer WHERE c_custkey % 5 = 0),
g AS (SELECT *, k % 50 = 49 AND mark = 'a' AS no_id FROM p WHERE NOT (run = 'r0' AND page % 6 = 1))"""
oracle("replicate_write", f"""
WITH {_PLANTED}
SELECT CAST(k AS VARCHAR) AS account_id, run || '-' || CAST(page AS VARCHAR) || mark AS name
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY run DESC, page DESC, pos) AS rn FROM g WHERE NOT no_id) t WHERE rn = 1
""")
oracle("replicate_counters", f"""
WITH {_PLANTED}
SELECT 'accounts' AS object_type, 'accounts' AS table_name, CAST(count_if(NOT no_id) AS BIGINT) AS total_processed,
       CAST(count_if(no_id) + (SELECT count(DISTINCT page) FROM p WHERE run = 'r0' AND page % 6 = 1) AS BIGINT) AS total_errors,
       CAST(count(DISTINCT CASE WHEN NOT no_id THEN run || CAST(page AS VARCHAR) END) AS BIGINT) AS total_batches,
       CAST(count(DISTINCT CASE WHEN NOT no_id THEN k END) AS BIGINT) AS rows_kept FROM g
""")
oracle("bad_pages", f"""
WITH {_PLANTED}
SELECT DISTINCT 'accounts' AS object_type, run AS run_id, CAST(page AS BIGINT) AS page_no FROM p WHERE run = 'r0' AND page % 6 = 1
""")
_RUN_SIZES = "SELECT run, count(*) AS n, count(DISTINCT k) AS keys FROM g WHERE NOT no_id GROUP BY run"
oracle("flush_counters", f"""
WITH {_PLANTED},
r AS ({_RUN_SIZES}),
sizes(flush_size) AS (VALUES (40), (250), (500), (100))
SELECT CAST(flush_size AS BIGINT) AS flush_size, 'accounts' AS object_type, 'accounts' AS table_name,
       CAST((SELECT sum(n) FROM r) AS BIGINT) AS total_processed,
       CAST((SELECT count_if(no_id) FROM g) + (SELECT count(DISTINCT page) FROM p WHERE run = 'r0' AND page % 6 = 1) AS BIGINT) AS total_errors,
       CAST((SELECT sum((n + flush_size - 1) // flush_size) FROM r) AS BIGINT) AS total_batches,
       CAST((SELECT count(DISTINCT k) FROM g WHERE NOT no_id) AS BIGINT) AS rows_kept
FROM sizes
""")
oracle("replicate_flushed", f"""
WITH {_PLANTED},
f AS (SELECT *, (row_number() OVER (PARTITION BY run ORDER BY page, pos) - 1) // 250 AS flush FROM g WHERE NOT no_id)
SELECT CAST(k AS VARCHAR) AS account_id, run || '-' || CAST(page AS VARCHAR) || mark AS name
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY run DESC, flush DESC, page, pos) AS rn FROM f) t WHERE rn = 1
""")
oracle("replicate_all", ORACLES["replicate_report"])
oracle("run_log", f"""
WITH t AS (SELECT {K} AS k FROM orders WHERE o_orderstatus = 'F' AND ({K} % 3 = 0 OR {K} % 5 = 0)),
c AS (SELECT k, k IN (SELECT l_orderkey FROM lineitem) AS has,
             k IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber % 2 = 0) AS hit FROM t),
u AS (SELECT count(*) AS n FROM supplier)
SELECT 'replicate all' AS command, o AS object_type, n AS total_processed, CAST(0 AS BIGINT) AS total_errors,
       CAST(NULL AS BIGINT) AS total_classified, CAST(NULL AS BIGINT) AS rows_before, CAST(NULL AS BIGINT) AS rows_after,
       true AS success, false AS failed FROM u, (VALUES ('users'), ('all')) v(o)
UNION ALL
SELECT 'classify', NULL, count(*), CAST(count_if(NOT has) AS BIGINT), CAST(count_if(hit) AS BIGINT), NULL, NULL, count_if(NOT has) = 0, false FROM c
UNION ALL
SELECT 'truncate', NULL, NULL, NULL, NULL, n, 0, NULL, false FROM u
""")
oracle("replicate_chunked", f"""
WITH m AS (SELECT {K} AS k, o_orderdate + to_days(CAST({K} % 30 AS INTEGER)) AS m_at, {_BAD_ID} AS bad FROM orders),
c AS (SELECT *, least(date_diff('day', TIMESTAMP '1996-01-01', m_at) // 240, 5) AS chunk_no FROM m
      WHERE m_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-15')
SELECT CAST(chunk_no AS BIGINT) AS chunk_no, CAST(CASE WHEN chunk_no = 1 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       count(*) AS total_processed, CAST(CASE WHEN chunk_no = 1 THEN 1 ELSE 0 END AS BIGINT) AS failed, count(*) AS in_table
FROM c WHERE NOT bad GROUP BY chunk_no
""")
_EDITED = "CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN 'edited ' || text ELSE text END"
oracle("incremental_conversations", f"""
SELECT issue_id, n_lines, conversation,
       conv_id IN (SELECT conv_id FROM conversations WHERE conv_id % 3 = 0 AND turn = 0) AS rebuilt
FROM ({_chat_thread(3, 6, _EDITED)}) x
""")
oracle("reject_rows", f"""
WITH {_PLANTED}
SELECT 'accounts' AS object_type, run AS run_id, CAST(page AS BIGINT) AS page_no, 'missing_id' AS reject_reason FROM g WHERE no_id
""")
oracle("replicate_issues_filtered", f"""
SELECT CAST({K} AS VARCHAR) AS issue_id, {ISSUE_STATE} AS state FROM orders
WHERE NOT {_BAD_ID} AND o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'
  AND o_orderdate + to_days(CAST({K} % 30 AS INTEGER)) BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '1998-01-15'
""")
oracle("replicate_messages_selected", f"""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS issue_id, CAST(l_linenumber AS VARCHAR) AS message_id
FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) IN ({_ids_oracle(True, None)})
""")
oracle("load_accounts", "SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS name FROM customer")
oracle("load_issues", f"""
SELECT CAST({K} AS VARCHAR) AS issue_id, {ISSUE_STATE} AS state,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'slack' ELSE 'email' END AS source
FROM orders
WHERE NOT {_BAD_ID} AND o_orderstatus IN ('F', 'P')
  AND o_orderdate + to_days(CAST({K} % 30 AS INTEGER)) BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'
""")
oracle("load_users", f"""
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS user_id, {STAFF_EMAIL} AS email FROM supplier
""")
oracle("load_teams", """
SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS team_id, n_name AS name,
       (SELECT count(*) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS n_users FROM nation n
UNION ALL
SELECT 'r' || CAST(r_regionkey AS VARCHAR), r_name,
       (SELECT count(*) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        WHERE n.n_regionkey = r.r_regionkey) FROM region r
""")

oracle("ndjson_reload", "SELECT event_id, event_type, user_id FROM events")
oracle("batch_scores", """
SELECT CAST(doc_id AS VARCHAR) AS issue_id,
       CASE WHEN doc_id % 17 <> 0 THEN CAST(len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS VARCHAR) END AS response,
       CASE WHEN doc_id % 17 = 0 THEN 'RuntimeError: scorer down' END AS error
FROM documents
""")

# ------------------------------------------------------------------ scorer
_KW = sorted({("resolution", r, w) for r in _RESOLUTIONS for w in r.split("_")} |
             {("category", c, w) for c in _CATEGORIES for w in c.split("_")})
_KW_VALUES = ", ".join(f"({_q(f)}, {_q(lab)}, {_q(w)})" for f, lab, w in _KW)
oracle("keyword_scores", f"""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
k(field, label, word) AS (VALUES {_KW_VALUES})
SELECT doc_id, field, label, count(*) AS hits FROM w JOIN k ON k.word = w.word GROUP BY doc_id, field, label
""")

# ------------------------------------------------------------------ streaming
oracle("stream_upsert", """
SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS name,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN c_mktsegment || '-v2'
            ELSE c_mktsegment END AS segment
FROM customer
""")
oracle("stream_chain_cut", """
SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS name FROM customer
WHERE NOT (c_nationkey % 3 = 0 AND c_custkey % 6 > 2
           AND c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey % 6 = 2))
""")

# ------------------------------------------------------------------ classify by keywords
_SAID = ("text || CASE length(text) % 5 WHEN 0 THEN ' billing refunds, Billing!' "
         "WHEN 1 THEN ' bug fix bug fix bug fix bug fix bug fix bug fix bug fix bug fix' WHEN 2 THEN ' spam' ELSE '' END")
_VALUE = "CASE label WHEN 'bug_fix' THEN 'big_fix' WHEN 'langgraph_platform' THEN 'langgraph_langgraph_platform' ELSE label END"
oracle("classify_keywords", f"""
WITH x AS ({_chat_thread(3, 6, _SAID)}),
w AS (SELECT issue_id, unnest(regexp_split_to_array(lower(conversation), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM x),
k(field, label, word) AS (VALUES {_KW_VALUES}),
h AS (SELECT issue_id, field, label, count(*) AS hits FROM w JOIN k ON k.word = w.word GROUP BY ALL),
b AS (SELECT issue_id, field, label, round(hits / sum(hits) OVER (PARTITION BY issue_id, field), 4) AS conf,
             row_number() OVER (PARTITION BY issue_id, field ORDER BY hits DESC, label) AS rn FROM h),
f AS (SELECT issue_id, min(conf) AS low, string_agg(field || '=' || {_VALUE}, ';' ORDER BY field DESC) AS fields FROM b WHERE rn = 1 GROUP BY 1)
SELECT x.issue_id, CASE WHEN low >= 0.8 THEN 'updated' ELSE 'skipped' END AS outcome, CASE WHEN low >= 0.8 THEN fields END AS fields
FROM x LEFT JOIN f USING (issue_id)
""")
oracle("score_resumed", """
SELECT CAST(doc_id AS VARCHAR) AS issue_id, CASE WHEN n % 17 = 0 THEN '2:' ELSE '1:' END || CAST(n AS VARCHAR) AS response
FROM (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS n FROM documents) t
""")
