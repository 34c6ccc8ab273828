"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query builds the reference's data shape from the driver tables (see
``sources.fixtures``) and runs the library operator over the whole tables.
Timestamps are emitted as RFC 3339 text; counts as BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.jsonx import to_text_ts
from .operators import closing
from .session import configure
from .sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def reg(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return reg


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return fx.table(spark, d, name)


AS_OF = dt.datetime(2000, 1, 1)
UPDATED_SEGMENTS = ("AUTOMOBILE", "BUILDING")   # accounts re-landed by the stream scenario


# ------------------------------------------------------------------ closing
@query("stale_candidates")
def q_stale_candidates(spark, d):
    """P9+A1+P10+L2+JN2: stale Slack issues waiting on the customer."""
    issues = fx.warehouse(spark, d, "issues")
    msgs = fx.warehouse(spark, d, "li_messages")
    out = closing.stale_candidates(issues, msgs, as_of=AS_OF)
    return out.select("issue_id", to_text_ts("last_message_time").alias("last_message_time"))


def _pages(records: DataFrame, run, page, pos, pagination=None) -> DataFrame:
    return fx.page_envelopes(records, run, page, pos, "record", pagination)


# ------------------------------------------------------------------ ingest
@query("ingest_pages_items")
def q_ingest_pages_items(spark, d):
    """S1+J1+J5: account records in 100-record pages -> exploded rows."""
    from .sources.objects import to_rows
    from .sources.pages import explode_items, parse_pages
    from .functions.jsonx import json_value
    recs = fx.account_records(T(spark, d, "customer"))
    k = F.col("key")
    pages = _pages(recs, F.lit("r0"), (k / 100).cast("long"), k)
    rows = to_rows(explode_items(parse_pages(pages)), "accounts")
    return rows.select("account_id", "page_no", "pos",
                       json_value("data", "$.name").alias("name"),
                       json_value("data", "$.segment").alias("segment"))


def _planted_pages(spark, d, kind: str) -> DataFrame:
    """Customer records paged per nation run (page = key div 100) with planted
    stops: cursor runs stop on has_next_page=false / missing cursor / empty
    data; offset runs carry offsets with one planted gap."""
    recs = fx.account_records(T(spark, d, "customer")).join(
        T(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey"), "key")
    run, page = F.col("c_nationkey"), (F.col("key") / 100).cast("long")
    pages = _pages(recs, run.cast("string"), page, F.col("key"))
    r, p = F.col("run_id").cast("long"), F.col("page_no")
    empty = (r + p) % 11 == 0
    body = F.when(empty, F.regexp_replace("body", r'^\{"data":\[.*\],"pagination"', '{"data":[],"pagination"')) \
            .otherwise(F.col("body"))
    if kind == "cursor":
        pag = F.struct((~((r % 7 == 0) & (p == 2))).alias("has_next_page"),
                       F.when(p != r % 5 + 3, F.concat(F.lit("c"), (p + 1).cast("string"))).alias("cursor"))
    else:
        pag = F.struct((p != r % 4 + 5).alias("has_next_page"), F.lit(None).cast("string").alias("cursor"))
    body = F.regexp_replace(body, r',"pagination":\{.*\}\}$', "")
    return pages.select("run_id", "page_no",
                        F.concat(body, F.lit(',"pagination":'), F.to_json(pag), F.lit("}")).alias("body"))


@query("ingest_cursor_cut")
def q_ingest_cursor_cut(spark, d):
    """Cursor chains cut at the first stopping page of each run."""
    from .sources.pages import cursor_chain, explode_items, parse_pages
    from .sources.objects import to_rows
    kept = cursor_chain(parse_pages(_planted_pages(spark, d, "cursor")))
    rows = to_rows(explode_items(kept), "accounts")
    return rows.select("run_id", "page_no", "pos", "account_id")


def _offset_pages(spark, d) -> DataFrame:
    """Offset pages: offset = records of earlier pages of the run, except a
    planted +1 gap at page 4 of runs with run % 6 = 1."""
    from .sources.pages import parse_pages
    pages = parse_pages(_planted_pages(spark, d, "offset"))
    # offsets are landed values; compute them here from the page sizes
    planted = F.when((F.col("run_id").cast("long") % 6 == 1) & (F.col("page_no") == 4), 1).otherwise(0)
    return fx.items_before(pages).withColumn("offset", (F.col("items_before") + planted).cast("long")) \
                              .drop("items_before")


@query("ingest_offset_cut")
def q_ingest_offset_cut(spark, d):
    """S3: offset chains cut where data is empty or has_next_page is false."""
    from .sources.pages import explode_items, offset_chain, parse_pages
    from .sources.objects import to_rows
    kept = offset_chain(parse_pages(_planted_pages(spark, d, "offset")))
    rows = to_rows(explode_items(kept), "accounts")
    return rows.select("run_id", "page_no", "pos", "account_id")


@query("ingest_offset_gaps")
def q_ingest_offset_gaps(spark, d):
    """S3 gap report: pages whose offset is not the running item count."""
    from .sources.pages import offset_gaps
    return offset_gaps(_offset_pages(spark, d))


@query("ingest_rejects")
def q_ingest_rejects(spark, d):
    """Records with a falsy id (issues) or without a parent id (messages)
    are split off with a reason; counts per object and reason."""
    from .sources.objects import to_rows
    from .sources.pages import explode_items, parse_pages
    recs = fx.bad_id_records(fx.warehouse(spark, d, "issue_records"))
    items = explode_items(parse_pages(_pages(recs, F.lit("r0"), F.col("page_no"), F.col("pos"))))
    iss = to_rows(items, "issues").select(F.lit("issues").alias("object_type"), "reject_reason")
    li = T(spark, d, "lineitem")
    parent = F.when(F.col("l_orderkey") % 101 != 0, F.col("l_orderkey").cast("string"))
    mitems = li.select(parent.alias("issue_id"), F.parse_json(F.to_json(F.struct(
        F.col("l_linenumber").cast("string").alias("id")))).alias("item"))
    msg = to_rows(mitems, "messages").select(F.lit("messages").alias("object_type"), "reject_reason")
    u = iss.unionByName(msg)
    return (u.groupBy("object_type", F.coalesce("reject_reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).cast("long").alias("n")))


@query("ingest_contacts_by_account")
def q_ingest_contacts_by_account(spark, d):
    """Contacts (offset pages) with the optional account_id equality."""
    from .sources.objects import to_rows
    from .sources.pages import explode_items, offset_chain, parse_pages
    from .functions.jsonx import json_value
    recs = fx.contact_records(T(spark, d, "customer"))
    k = F.col("key")
    run = F.concat(F.lit("r"), (k / 1000).cast("long").cast("string"))   # one offset run per 1000 keys
    pages = _pages(recs, run, (k / 100).cast("long"), k)
    rows = to_rows(explode_items(offset_chain(parse_pages(pages))), "contacts")
    return rows.where(F.col("account_id") == "7") \
               .select("contact_id", "account_id", json_value("data", "$.name").alias("name"))


@query("ingest_issue_messages")
def q_ingest_issue_messages(spark, d):
    """One unpaginated response per issue; the parent id comes from the
    request (landing partition); a NULL data array gives no rows."""
    from .sources.objects import to_rows
    from .sources.pages import explode_items, parse_pages
    from .functions.text import author_email
    from .functions.jsonx import json_value
    conv = T(spark, d, "conversations")
    m = fx.chat_messages(conv).select("issue_id", "message_id", F.col("message_id").cast("long").alias("turn"),
                                      F.to_json("data").alias("record"))
    g = fx.response_pages(m, "issue_id", "turn", F.col("turn"))
    body = F.when(F.col("issue_id").cast("long") % 13 == 0, F.lit('{"data":null}')) \
            .otherwise(F.concat(F.lit('{"data":'), F.col("data"), F.lit("}")))
    pages = g.select("issue_id", "page_no", body.alias("body"))
    rows = to_rows(explode_items(parse_pages(pages), keep=("issue_id", "page_no")), "messages")
    d_ = F.col("data")
    return rows.select("issue_id", "message_id", "pos",
                       author_email(json_value(d_, "$.author.user.email"),
                                    json_value(d_, "$.author.contact.email")).alias("author"))


@query("point_lookup")
def q_point_lookup(spark, d):
    """Lookup by id; single-record bodies are unwrapped from ``data``
    when wrapped (every other issue is landed wrapped)."""
    from .sources.pages import lookup, unwrap_body
    from .functions.jsonx import json_value
    f = fx.warehouse(spark, d, "issue_records")
    body = F.when(F.col("key") % 2 == 0, F.concat(F.lit('{"data":'), F.col("record"), F.lit("}"))) \
            .otherwise(F.col("record"))
    bodies = f.select("issue_id", F.parse_json(body).alias("body"))
    hit = lookup(bodies, "issue_id", "1").unionByName(lookup(bodies, "issue_id", "2"))
    u = unwrap_body(F.col("body"))
    return hit.select("issue_id", json_value(u, "$.state").alias("state"),
                      json_value(u, "$.created_at").alias("created_at"))


@query("keyed_lookup")
def q_keyed_lookup(spark, d):
    """S10 on a keyed table of two versions: three keys (in the base only, in
    both, in none), each from the files of one bucket."""
    from functools import reduce
    from .operators.merge import KeyedTable
    from .session import scratch_path
    from .functions.jsonx import json_value
    f = fx.warehouse(spark, d, "issue_records")
    t = KeyedTable(spark, scratch_path(spark, "lookup"), "issues")
    t.upsert(_issue_rows(f, F.col("record")))
    t.upsert(_issue_rows(f.where(F.col("key") % 2 == 0), _state_set(F.col("record"), "closed")))
    found = reduce(DataFrame.unionByName, [t.lookup(k) for k in ("1", "2", "no such key")])
    return found.select("issue_id", json_value("data", "$.state").alias("state"))


@query("record_cap")
def q_record_cap(spark, d):
    """The first 500 records in landing order (the cap is the feature)."""
    from .sources.pages import cap_records, explode_items, parse_pages
    from pyspark.sql import Window
    recs = fx.warehouse(spark, d, "issue_records")
    items = explode_items(parse_pages(_pages(recs, F.lit("r0"), F.col("page_no"), F.col("pos"))))
    capped = cap_records(items, 500)
    w = Window.orderBy("run_id", "page_no", "pos")
    return capped.select(F.row_number().over(w).cast("long").alias("rank"),
                         F.try_variant_get("item", "$.id", "string").alias("issue_id"))


@query("ndjson_load")
def q_ndjson_load(spark, d):
    """S12+J6+J7: typed NDJSON (explicit schema, FAILFAST), one batch stamp,
    timestamps re-serialised as RFC 3339 with a 'Z'."""
    from .sources.pages import parse_ndjson
    ev = T(spark, d, "events")
    lines = ev.select(F.to_json(F.struct(F.col("event_id"), F.col("event_type"),
                                         F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                                         "user_id")).alias("line"))
    schema = "event_id bigint, event_type string, ts timestamp, user_id bigint"
    rows = parse_ndjson(lines, "line", schema)
    stamp = F.to_timestamp(F.lit("2024-02-01 12:00:00"))
    rows = rows.withColumn("updated_at", stamp)
    return rows.select("event_id", "event_type", to_text_ts("ts", micros=True).alias("ts"),
                       to_text_ts("updated_at", micros=True).alias("updated_at"))


@query("ndjson_reload")
def q_ndjson_reload(spark, d):
    """S12+J6: a table holding every order is truncated and loaded again from
    NDJSON files of the events, then read back."""
    from .operators.merge import KeyedTable
    from .plans.load import reload_ndjson
    from .session import scratch_path
    schema = "event_id bigint, event_type string, user_id bigint"
    t = KeyedTable(spark, scratch_path(spark, "ndjson-table"), keys=["event_id"],
                   schema=spark.createDataFrame([], schema + ", updated_at timestamp").schema)
    o = T(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("event_id"), F.col("o_orderstatus").alias("event_type"),
                                     F.col("o_custkey").cast("long").alias("user_id"), F.current_timestamp().alias("updated_at"),
                                     F.lit(0).cast("long").alias("page_no"), F.lit(0).cast("long").alias("pos"))
    t.upsert(o)
    path = scratch_path(spark, "ndjson-files")
    T(spark, d, "events").select("event_id", "event_type", "user_id").write.mode("overwrite").json(path)
    reload_ndjson(spark, path, schema, t)
    return t.read().select("event_id", "event_type", "user_id")


# ------------------------------------------------------------------ filters
def _event_issues(spark, d) -> DataFrame:
    """Events as issue-like records: state = event type, modified_at = ts,
    bucket = 'low' below value 5 else 'high'."""
    ev = T(spark, d, "events")
    rec = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"),
                             F.col("event_type").alias("state"),
                             to_text_ts("ts", micros=True).alias("modified_at"),
                             F.col("user_id").cast("string").alias("user"),
                             F.when(F.col("value") < 5, "low").otherwise("high").alias("bucket")))
    return ev.select("event_id", F.parse_json(rec).alias("data"))


def _filtered(spark, d, **kw) -> DataFrame:
    from .operators.filters import issue_predicate, json_field
    return _event_issues(spark, d).where(issue_predicate(json_field(), **kw)).select("event_id")


@query("filter_equals")
def q_filter_equals(spark, d):
    """One state -> ``equals``."""
    return _filtered(spark, d, states=["click"])


@query("filter_in")
def q_filter_in(spark, d):
    """Several states -> ``in``."""
    return _filtered(spark, d, states=["view", "purchase"])


@query("filter_time_range")
def q_filter_time_range(spark, d):
    """Both bounds -> ``time_range`` (inclusive)."""
    return _filtered(spark, d, modified_start=dt.datetime(2024, 1, 10), modified_end=dt.datetime(2024, 1, 20))


@query("filter_after")
def q_filter_after(spark, d):
    """Start only -> ``time_is_after`` (strict)."""
    return _filtered(spark, d, modified_start=dt.datetime(2024, 1, 25))


@query("filter_before")
def q_filter_before(spark, d):
    """End only -> ``time_is_before`` (strict)."""
    return _filtered(spark, d, modified_end=dt.datetime(2024, 1, 5))


@query("filter_and_extra")
def q_filter_and_extra(spark, d):
    """Plain extra mapping -> equals leaf, AND-ed with range and states."""
    return _filtered(spark, d, modified_start=dt.datetime(2024, 1, 8), modified_end=dt.datetime(2024, 1, 22),
                     states=["purchase", "signup"], extra={"bucket": "high"})


@query("filter_shaped")
def q_filter_shaped(spark, d):
    """A shaped extra body passes through, AND-ed with the built leaves."""
    return _filtered(spark, d, states=["error"],
                     extra={"filter": {"field": "bucket", "operator": "equals", "values": ["low"]}})


CHUNK_START, CHUNK_END = fx.CHUNK_START, fx.CHUNK_END


@query("chunk_30d")
def q_chunk_30d(spark, d):
    """30-day chunks of [start, end] by arithmetic; count per chunk."""
    from .operators.filters import chunk_index, chunks
    from .functions.jsonx import json_ts
    iss = fx.warehouse(spark, d, "issues")
    tagged = iss.select(chunk_index(json_ts("data", "$.modified_at"), CHUNK_START, CHUNK_END).alias("chunk_no")) \
                .where(F.col("chunk_no").isNotNull())
    counts = tagged.groupBy("chunk_no").agg(F.count(F.lit(1)).cast("long").alias("n"))
    c = chunks(spark, CHUNK_START, CHUNK_END)
    return counts.join(c, "chunk_no").select("chunk_no", to_text_ts("chunk_start").alias("chunk_start"),
                                               to_text_ts("chunk_end").alias("chunk_end"), "n")


WINDOW_START, WINDOW_END = dt.datetime(1997, 3, 1, 10, 30), dt.datetime(1997, 6, 30, 15, 0)


def _ids(spark, d, **kw) -> DataFrame:
    from .operators.filters import issue_ids
    return issue_ids(spark, fx.warehouse(spark, d, "flat_issues"), fx.warehouse(spark, d, "issues"), **kw)


@query("issue_ids_window")
def q_issue_ids_window(spark, d):
    """P4+U1: created or latest-message time within day-cut bounds."""
    return _ids(spark, d, start=WINDOW_START, end=WINDOW_END)


@query("issue_ids_state")
def q_issue_ids_state(spark, d):
    """P5+P6+U1: display-form state on the flat table, code form on JSON."""
    return _ids(spark, d, state="Waiting on Customer")


@query("issue_ids_by_code")
def q_issue_ids_by_code(spark, d):
    """P6+L3: the state given as a code; ids in order."""
    return _ids(spark, d, state="on_hold", ordered=True)


@query("issue_ids_union")
def q_issue_ids_union(spark, d):
    """P4+P5+U1: time window and state together."""
    return _ids(spark, d, start=WINDOW_START, end=WINDOW_END, state="Closed")


# ------------------------------------------------------------------ JSON
@query("json_scalar")
def q_json_scalar(spark, d):
    """JSON_VALUE rules - scalars as text; objects, arrays, JSON null
    and missing paths as NULL."""
    from .functions.jsonx import json_value
    ev = T(spark, d, "events")
    doc = F.concat(F.lit('{"p":'), F.col("props"), F.lit(',"o":{"x":'), F.col("user_id").cast("string"),
                   F.lit('},"a":['), F.col("event_id").cast("string"), F.lit('],"n":null,"s":"'),
                   F.col("event_type"), F.lit('","t":'),
                   F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"), F.lit(',"e":""}'))
    v = F.parse_json(doc)
    cols = {"p_k": "$.p.k", "o": "$.o", "o_x": "$.o.x", "a": "$.a", "a0": "$.a[0]", "n": "$.n",
            "s": "$.s", "t": "$.t", "e": "$.e", "missing": "$.zz"}
    return ev.select("event_id", *[json_value(v, p).alias(k) for k, p in cols.items()])


@query("json_array_unnest")
def q_json_array_unnest(spark, d):
    """J2/JN4: UNNEST of the users array of each team (inner: no users -> no rows)."""
    from .functions.jsonx import json_array, json_value
    teams = fx.warehouse(spark, d, "teams")
    u = teams.select("team_id", F.explode(json_array("data", "$.users")).alias("u"))
    return u.select("team_id", json_value("u", "$.id").alias("user_id"), json_value("u", "$.email").alias("email"))


@query("json_ts")
def q_json_ts(spark, d):
    """RFC 3339 text -> TIMESTAMP (strict), re-emitted as text + epoch."""
    from .functions.jsonx import json_ts
    iss = fx.warehouse(spark, d, "issues")
    ts = json_ts("data", "$.created_at")
    return iss.select("issue_id", to_text_ts(ts).alias("created_at"),
                      F.unix_seconds(ts).cast("long").alias("created_epoch"))


# ------------------------------------------------------------------ dedup
@query("dedup_first")
def q_dedup_first(spark, d):
    """A5 parity mode: first seen per (issue_id, message_id)."""
    from .operators.dedup import dedup_first
    m = fx.warehouse(spark, d, "li_messages")
    return dedup_first(m, ["issue_id", "message_id"], seen=["seen"]) \
        .select("issue_id", "message_id", "l_partkey", "l_suppkey")


@query("dedup_latest")
def q_dedup_latest(spark, d):
    """A5 contract mode: greatest updated_at, ties -> first seen."""
    from .operators.dedup import dedup_latest
    m = fx.warehouse(spark, d, "li_messages")
    return dedup_latest(m, ["issue_id", "message_id"], seen=["seen"]) \
        .select("issue_id", "message_id", "l_partkey", "l_suppkey")


@query("dedup_counts")
def q_dedup_counts(spark, d):
    """Original, null-key, kept and removed rows."""
    from .operators.dedup import dedup_counts
    return dedup_counts(fx.warehouse(spark, d, "li_messages"), ["issue_id", "message_id"])


# ------------------------------------------------------------------ upsert (I2-I4, JN5, I7, A2, A3)
def _state_set(record, new_state: str):
    return F.regexp_replace(record, r'"state":"[^"]*"', f'"state":"{new_state}"')


def _issue_rows(f: DataFrame, record) -> DataFrame:
    return f.select("issue_id", F.parse_json(record).alias("data"),
                    F.to_timestamp(F.lit("2024-06-01 00:00:00")).alias("updated_at"), "page_no", "pos")


def _created(since: str) -> Column:
    return F.col("created_day") >= F.lit(since).cast("date")


@query("upsert_merge")
def q_upsert_merge(spark, d):
    """I3/JN5: a first load of the issues created before 1996, then a second
    load of every issue created since 1995, now closed: the overlap is
    updated, the rest inserted. MERGE through the keyed table (the second
    load is a version of its own); the result holds every issue."""
    from .operators.merge import KeyedTable
    from .session import scratch_path
    from .functions.jsonx import json_value
    f = fx.warehouse(spark, d, "issue_records")
    t = KeyedTable(spark, scratch_path(spark, "upsert_merge"), "issues")
    t.upsert(_issue_rows(f.where(~_created("1996-01-01")), F.col("record")))
    t.upsert(_issue_rows(f.where(_created("1995-01-01")), _state_set(F.col("record"), "closed")))
    return t.read().select("issue_id", json_value("data", "$.state").alias("state"))


@query("upsert_batches")
def q_upsert_batches(spark, d):
    """I4: after a first load (issues created before 1996), three batches of
    overlapping creation ranges in one pass - later batch wins, first row
    inside a batch wins (batch 3 holds each of its keys twice)."""
    from .operators.merge import KeyedTable
    from .session import scratch_path
    from .functions.jsonx import json_value
    f = fx.warehouse(spark, d, "issue_records")
    t = KeyedTable(spark, scratch_path(spark, "upsert_batches"), "issues")
    t.upsert(_issue_rows(f.where(~_created("1996-01-01")), F.col("record")))
    rec = F.col("record")
    b1 = _issue_rows(f.where(_created("1994-01-01")), _state_set(rec, "on_hold")).withColumn("batch_no", F.lit(1))
    b2 = _issue_rows(f.where(_created("1995-01-01")), _state_set(rec, "closed")).withColumn("batch_no", F.lit(2))
    b3a = _issue_rows(f.where(_created("1996-06-01")), _state_set(rec, "new")).withColumn("batch_no", F.lit(3))
    b3b = _issue_rows(f.where(_created("1996-06-01")).withColumn("pos", F.col("pos") + 1000),
                      _state_set(rec, "waiting_on_you")).withColumn("batch_no", F.lit(3))
    t.upsert(b1.unionByName(b2).unionByName(b3a).unionByName(b3b), keep="batches")
    return t.read().select("issue_id", json_value("data", "$.state").alias("state"))


@query("truncate_audit")
def q_truncate_audit(spark, d):
    """I7+A2: load the accounts table (every customer), truncate it, audit
    rows before/after."""
    from .operators.merge import KeyedTable
    from .plans.truncate import truncate
    from .session import scratch_path
    recs = fx.account_records(T(spark, d, "customer"))
    rows = recs.select(F.col("key").cast("string").alias("account_id"), F.parse_json("record").alias("data"),
                       F.current_timestamp().alias("updated_at"), (F.col("key") / 100).cast("long").alias("page_no"),
                       F.col("key").alias("pos"))
    t = KeyedTable(spark, scratch_path(spark, "accounts"), "accounts")
    t.upsert(rows)
    return truncate(t, "accounts")


def _event_table(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("event_id").cast("string").alias("event_id"),
                     F.col("ts").cast("timestamp").alias("updated_at"))


@query("high_water_mark")
def q_high_water_mark(spark, d):
    """A3: MAX(updated_at) of a table."""
    from .streaming.incremental import high_water_mark
    hwm = high_water_mark(_event_table(T(spark, d, "events")))
    return hwm.select(to_text_ts("high_water_mark", micros=True).alias("high_water_mark"))


@query("incremental_cut")
def q_incremental_cut(spark, d):
    """ST2: source rows changed after the target's high-water mark."""
    from .streaming.incremental import incremental_cut
    ev = T(spark, d, "events")
    target = _event_table(ev.where(F.col("ts") <= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
    src = ev.select(F.col("event_id"), F.col("ts").cast("timestamp").alias("changed_at"))
    return incremental_cut(src, F.col("changed_at"), target).select("event_id")


# ------------------------------------------------------------------ text + threads (J4, J8-J10, A4, JN1, W1, W2, A7)
@query("strip_html")
def q_strip_html(spark, d):
    """Tags dropped, six entities decoded in order, Unicode whitespace
    collapsed, trimmed - over every page."""
    from .functions.text import strip_html
    return T(spark, d, "pages").select("page_id", strip_html("html").alias("text"))


def _teams(spark, d) -> DataFrame:
    return fx.warehouse(spark, d, "teams")


@query("team_directory")
def q_team_directory(spark, d):
    """A4+J2: DISTINCT (email, user_id, team_name) over all team members."""
    from .operators.threads import staff_directory
    return staff_directory(_teams(spark, d))


def _message_team(spark, d, fan_out: bool) -> DataFrame:
    from .operators.threads import message_rows, staff_directory, team_by_email
    from .functions.text import team_label
    rows = message_rows(fx.warehouse(spark, d, "li_messages"))
    directory = staff_directory(_teams(spark, d))
    t = (directory if fan_out else team_by_email(directory)).select(F.col("email").alias("_e"), "team_name")
    j = rows.join(t, rows.author == t._e, "left")
    return j.select("issue_id", "message_id", "author", team_label(F.col("team_name")).alias("team"))


@query("message_team")
def q_message_team(spark, d):
    """JN1+J4+J10: author -> staff team (one per e-mail) or 'Customer'."""
    return _message_team(spark, d, fan_out=False)


@query("message_team_fanout")
def q_message_team_fanout(spark, d):
    """JN1 parity mode (Q6): one row per team of a staff author."""
    return _message_team(spark, d, fan_out=True)


@query("thread_triage")
def q_thread_triage(spark, d):
    """Triage conversations (first 3 + last 6) for every thread."""
    from .operators.threads import triage_conversations
    return triage_conversations(fx.warehouse(spark, d, "ev_messages"), _teams(spark, d))


@query("thread_closing")
def q_thread_closing(spark, d):
    """Closing conversations (first 5 + last 15) for every thread."""
    from .operators.threads import closing_conversations
    return closing_conversations(fx.warehouse(spark, d, "ev_messages"))


@query("thread_triage_fanout")
def q_thread_triage_fanout(spark, d):
    """E6 parity mode (Q6): staff in two teams repeat their lines, and the
    repeats count towards the 3 + 6 window."""
    from .operators.threads import triage_conversations
    return triage_conversations(fx.warehouse(spark, d, "ev_messages"), _teams(spark, d), fan_out=True)


@query("author_line")
def q_author_line(spark, d):
    """J4+J9+J10: one formatted line per chat message."""
    from .operators.threads import message_rows, staff_directory, team_by_email
    from .functions.text import conversation_line, team_label
    rows = message_rows(fx.warehouse(spark, d, "chat_messages"))
    t = team_by_email(staff_directory(_teams(spark, d))).withColumnRenamed("email", "_e")
    j = rows.join(t, rows.author == t._e, "left")
    return j.select("issue_id", "message_id",
                    conversation_line(F.col("ts"), F.col("author"), F.col("body"),
                                      team_label(F.col("team_name"))).alias("line"))


# ------------------------------------------------------------------ triage
def _issues(spark, d) -> DataFrame:
    return fx.warehouse(spark, d, "issues")


@query("unclassified")
def q_unclassified(spark, d):
    """P8+L1: closed issues missing a label, created in bounds, newest first,
    capped at 250 records (the cap is the feature)."""
    from .operators.triage import unclassified
    from pyspark.sql import Window
    u = unclassified(_issues(spark, d), created_start="1996-01-01T00:00:00Z",
                     created_end="2000-12-31T00:00:00Z", limit=250)
    w = Window.orderBy(F.col("created_at").desc(), F.col("issue_id"))
    return u.select(F.row_number().over(w).cast("long").alias("rank"), "issue_id",
                    to_text_ts("created_at").alias("created_at"))


@query("typed_filters")
def q_typed_filters(spark, d):
    """S11+P1+P8+P9: a keyed table of two versions read with its typed
    columns: unclassified issues, the waiting pool, and a modified_at range,
    all by plain columns that reach the files' statistics."""
    from .operators.filters import issue_predicate, table_field
    from .operators.merge import KeyedTable
    from .operators.triage import unclassified
    from .session import scratch_path
    f = fx.warehouse(spark, d, "issue_records")
    t = KeyedTable(spark, scratch_path(spark, "typed"), "issues")
    t.upsert(_issue_rows(f, F.col("record")))
    t.upsert(_issue_rows(f.where(F.col("key") % 10 == 0), _state_set(F.col("record"), "on_hold")))
    issues = t.read(typed=True)
    window = issue_predicate(table_field(issues), modified_start=dt.datetime(1996, 2, 1), modified_end=dt.datetime(1996, 8, 1))
    told = lambda df, kind: df.select(F.lit(kind).alias("kind"), "issue_id")
    return told(unclassified(issues, ordered=False), "unclassified").unionByName(told(closing.waiting_pool(issues), "waiting")) \
        .unionByName(told(issues.where(window), "modified"))


@query("missing_fields")
def q_missing_fields(spark, d):
    """P11+P12: closed flag and falsy label fields per issue."""
    from .operators.closing import is_closed, missing_fields
    i = _issues(spark, d)
    m = missing_fields(F.col("data"))
    return i.select("issue_id", is_closed(F.col("data")).alias("is_closed"),
                    F.array_join(m, ",").alias("missing"), (F.size(m) > 0).alias("needs_classification"))


def _labels_long(spark, d) -> DataFrame:
    from .functions.jsonx import json_value
    i = _issues(spark, d)
    return i.select(F.explode(F.array(
        F.struct(F.lit("resolution").alias("field"), json_value("data", "$.custom_fields.resolution.value").alias("label")),
        F.struct(F.lit("category").alias("field"), json_value("data", "$.custom_fields.category.value").alias("label")))
    ).alias("x")).select("x.field", "x.label").where(F.col("label").isNotNull())


@query("taxonomy_check")
def q_taxonomy_check(spark, d):
    """Labels in use that are not in the taxonomy (anti join against the
    fixed-size taxonomy table), with counts."""
    from .functions.labels import taxonomy
    tax = F.broadcast(taxonomy(spark).select("field", "label"))
    out = _labels_long(spark, d).join(tax, ["field", "label"], "left_anti")
    return out.groupBy("field", "label").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("label_recode")
def q_label_recode(spark, d):
    """Write-back recoding of labels (unknown labels pass)."""
    from .functions.jsonx import json_value
    from .functions.labels import recode_category, recode_resolution
    i = _issues(spark, d)
    return i.select("issue_id",
                    recode_resolution(json_value("data", "$.custom_fields.resolution.value")).alias("resolution"),
                    recode_category(json_value("data", "$.custom_fields.category.value")).alias("category"))


@query("tag_append")
def q_tag_append(spark, d):
    """Append 'auto-classified' unless present; order/duplicates kept."""
    from .functions.labels import TAG_CLASSIFIED, append_tag
    i = _issues(spark, d)
    tags = F.try_variant_get("data", "$.tags", "array<string>")
    return i.select("issue_id", F.array_join(append_tag(tags, TAG_CLASSIFIED), "|").alias("tags"))


def _chat_conversations(spark, d) -> DataFrame:
    from .operators.threads import triage_conversations
    return triage_conversations(fx.warehouse(spark, d, "chat_messages"), _teams(spark, d))


@query("request_text")
def q_request_text(spark, d):
    """Per-issue request (system variant by field set, user text)."""
    from .operators.triage import requests
    convs = _chat_conversations(spark, d)
    k = F.col("issue_id").cast("long") % 3
    fields = (F.when(k == 0, F.array(F.lit("resolution"))).when(k == 1, F.array(F.lit("category")))
               .otherwise(F.array(F.lit("resolution"), F.lit("category"))))
    targets = convs.select("issue_id", fields.alias("fields"))
    return requests(targets, convs).select("issue_id", "system", "user")


@query("request_digests")
def q_request_digests(spark, d):
    """J13 in all variants: every chat as a plain, a debug and a question
    request; the system text as its digest."""
    from .operators.triage import requests
    from .plans.close import question_requests
    convs = _chat_conversations(spark, d)
    k = F.col("issue_id").cast("long") % 3
    fields = (F.when(k == 0, F.array(F.lit("resolution"))).when(k == 1, F.array(F.lit("category")))
               .otherwise(F.array(F.lit("resolution"), F.lit("category"))))
    targets = convs.select("issue_id", fields.alias("fields"))
    told = lambda df, form: df.select("issue_id", F.lit(form).alias("form"), F.md5(F.col("system").cast("binary")).alias("system_md5"), "user")
    return told(requests(targets, convs), "plain").unionByName(told(requests(targets, convs, debug=True), "debug")) \
        .unionByName(told(question_requests(convs, convs), "question"))


def planted_response(key, quality, toxic):
    """Scorer responses planted by key (8 shapes: low/ok confidences, strong
    and weak fields, absent, JSON null and text confidence, bad JSON)."""
    res = F.when(quality == 1, F.lit("bug_fix")).otherwise(F.lit("no_action"))
    cat = F.when(toxic == 1, F.lit("other_spam")).otherwise(F.lit("langgraph_platform"))
    q = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    v = key % 8
    return (F.when(v == 0, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "confidence": 0.79}')))
             .when(v == 1, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "confidence": 0.8}')))
             .when(v == 2, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "resolution_confidence": 1, "category": '),
                                    q(cat), F.lit(', "category_confidence": 0.95}')))
             .when(v == 3, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "resolution_confidence": 0.9, "category": '),
                                    q(cat), F.lit(', "category_confidence": 0.5}')))
             .when(v == 4, F.concat(F.lit('{"category": '), q(cat), F.lit("}")))
             .when(v == 5, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "confidence": null}')))
             .when(v == 6, F.concat(F.lit('{"resolution": '), q(res), F.lit(', "confidence": "0.9"}')))
             .otherwise(F.lit("not json {")))


def _label_responses(spark, d) -> DataFrame:
    lab = T(spark, d, "labels")
    return lab.select(F.col("doc_id").cast("string").alias("issue_id"),
                      planted_response(F.col("doc_id"), F.col("quality"), F.col("toxic")).alias("response"))


@query("response_gate")
def q_response_gate(spark, d):
    """J14+J16: parse and gate every scored response."""
    from .functions.labels import gate
    from .operators.triage import parse_response
    r = _label_responses(spark, d).select("issue_id", parse_response(F.col("response")).alias("v"))
    g = gate(r, F.col("v"), "g")
    return g.select(F.col("issue_id").cast("long").alias("doc_id"),
                    F.when(F.col("v").isNull(), F.lit("none")).otherwise(F.col("g")).alias("gate"))


@query("accepted_fields")
def q_accepted_fields(spark, d):
    """J17+J11: fields taken from passing responses (slug=value list)."""
    from .functions.labels import accepted_staged, gate_staged, response_features
    from .operators.triage import parse_response
    r = _label_responses(spark, d).select("issue_id", parse_response(F.col("response")).alias("v"))
    # features staged once; gate and fields are plain column logic over them
    st = r.select("issue_id", F.col("v").isNull().alias("_none"), *response_features(F.col("v")))
    a = st.select("issue_id", "_none", gate_staged().alias("g"), accepted_staged().alias("f"))
    # keep passing responses: exploding a one-element array (NULL when the row
    # fails) keeps the rule in the projection; a Filter on ``g`` would be
    # pushed below it and inline the whole staged chain into one method
    ok = a.select("issue_id", F.explode(F.when(~F.col("_none") & (F.col("g") == "pass"),
                                               F.array(F.col("f")))).alias("f"))
    return ok.select(F.col("issue_id").cast("long").alias("doc_id"),
                     F.array_join(F.transform("f", lambda x: F.concat(x["slug"], F.lit("="), x["value"])), ";")
                     .alias("fields"))


def _issue_responses(issues_keys: DataFrame) -> DataFrame:
    """Landed scorer responses for issues (none when key % 9 = 0)."""
    k = F.col("key")
    return issues_keys.select(F.col("issue_id"), F.when(k % 9 != 0, planted_response(
        k, k % 2, F.when(k % 3 == 0, 1).otherwise(0))).alias("response"))


def _classify_run(spark, d) -> dict:
    from .plans.classify import classify
    from .operators.scorer import replay
    iss = _issues(spark, d)
    msgs = fx.warehouse(spark, d, "li_messages")
    landed = _issue_responses(iss)
    return classify(iss, msgs, _teams(spark, d), responder=lambda r: replay(r, landed),
                    created_at=F.to_timestamp(F.lit("2024-06-02 00:00:00")))


def _output(spark, run: dict, key: str) -> DataFrame:
    """One output of a command, stored; the command's caches are released."""
    from .plans import release
    from .session import scratch_path
    path = scratch_path(spark, key)
    try:
        run[key].write.parquet(path)
    finally:
        release(run)
    return spark.read.schema(run[key].schema).parquet(path)


@query("classify_report")
def q_classify_report(spark, d):
    """E4+A10: counters of the classify run over all unclassified issues."""
    return _output(spark, _classify_run(spark, d), "counters")


@query("classify_outcomes")
def q_classify_outcomes(spark, d):
    """Issues per outcome of the truth table."""
    dec = _output(spark, _classify_run(spark, d), "decisions")
    return dec.groupBy("outcome").agg(F.count(F.lit(1)).cast("long").alias("n"))


def _payload_cols(outbox: DataFrame, schema: str) -> DataFrame:
    return outbox.select("issue_id", "kind", F.from_json("payload", schema).alias("p"))


@query("classify_keywords")
def q_classify_keywords(spark, d):
    """E4+F1: a classify run whose labels come from the conversations: closed
    chat issues scored by the keywords in their (truncated) text, parsed,
    gated, and turned into updates."""
    from .plans.classify import classify
    run = classify(fx.warehouse(spark, d, "chat_issues"), fx.warehouse(spark, d, "keyword_messages"), _teams(spark, d),
                   created_at=F.to_timestamp(F.lit("2024-06-02 00:00:00")))
    dec = _output(spark, run, "decisions")
    fields = F.array_join(F.transform("custom_fields", lambda x: F.concat(x["slug"], F.lit("="), x["value"])), ";")
    return dec.select("issue_id", "outcome", fields.alias("fields"))


@query("update_outbox")
def q_update_outbox(spark, d):
    """J19+I8: classification outbox rows, payload read back into columns."""
    ob = _payload_cols(_output(spark, _classify_run(spark, d), "outbox"),
                       "custom_fields array<struct<slug:string,value:string>>, tags array<string>")
    cf = F.col("p.custom_fields")
    pick = lambda s: F.try_element_at(F.filter(cf, lambda x: x["slug"] == s), F.lit(1))["value"]
    return ob.select("issue_id", "kind", pick("resolution").alias("resolution"),
                     pick("category").alias("category"), F.array_join("p.tags", "|").alias("tags"))


# ------------------------------------------------------------------ closing (E5, JN6, JN7, J15, J20, A11)
def _current_snapshot(spark, d, ids: DataFrame) -> DataFrame:
    """The service's current state of the issues ``ids``: the warehouse issues
    with keys % 11 = 0 closed since the last load (merged on the key)."""
    from .operators.keysets import restrict_to
    from .operators.merge import merge
    f = restrict_to(fx.warehouse(spark, d, "issue_records"), ids)
    base = _issue_rows(f, F.col("record")).select("issue_id", "data")
    changed = _issue_rows(f.where(F.col("key") % 11 == 0), _state_set(F.col("record"), "closed")) \
        .select("issue_id", "data")
    return merge(base, changed, ["issue_id"])


def planted_question_response(key):
    """Question-analysis responses planted by key: none (key % 10 = 0),
    unresolved (key % 4 = 0), all_resolved as the *string* "true" (key % 4 = 1),
    resolved otherwise."""
    qs = F.lit('[{"id": 1, "question": "q", "resolved": true}, {"id": 2, "question": "r", "resolved": true}]')
    body = lambda ar: F.concat(F.lit('{"pylon_issue_id": "'), key.cast("string"),
                               F.lit('", "questions": '), qs, F.lit(', "quantity": "2", "all_resolved": '),
                               F.lit(ar), F.lit("}"))
    return (F.when(key % 10 == 0, F.lit(None).cast("string"))
             .when(key % 4 == 0, body("false")).when(key % 4 == 1, body('"true"')).otherwise(body("true")))


def _close_run(spark, d) -> dict:
    from .plans.close import close
    from .operators.scorer import replay
    iss = _issues(spark, d)
    msgs = fx.warehouse(spark, d, "li_messages")
    keys = iss.select("issue_id", "key")
    label_landed = _issue_responses(keys)
    q_landed = keys.select("issue_id", planted_question_response(F.col("key")).alias("response"))
    return close(iss, lambda ids: _current_snapshot(spark, d, ids).join(keys, "issue_id"), msgs, _teams(spark, d), AS_OF,
                 question_responder=lambda r: replay(r, q_landed),
                 label_responder=lambda r: replay(r, label_landed),
                 created_at=F.to_timestamp(F.lit("2024-06-02 00:00:00")))


@query("current_state_lookup")
def q_current_state_lookup(spark, d):
    """JN7: candidates joined once with the current snapshot."""
    from .operators.closing import current_state
    from .functions.jsonx import json_value
    from .session import scratch_path
    cand = closing.stale_candidates(_issues(spark, d), fx.warehouse(spark, d, "li_messages"), AS_OF, ordered=False)
    path = scratch_path(spark, "candidates")            # computed once: they choose the snapshot's rows too
    cand.select("issue_id").write.parquet(path)
    ids = spark.read.schema("issue_id string").parquet(path)
    cs = current_state(ids, _current_snapshot(spark, d, ids))
    return cs.select("issue_id", json_value("current", "$.state").alias("state"))


@query("close_report")
def q_close_report(spark, d):
    """E5+A11: closing counters over all stale candidates."""
    return _output(spark, _close_run(spark, d), "counters")


@query("close_outcomes")
def q_close_outcomes(spark, d):
    """E5: candidates per outcome of the truth table."""
    dec = _output(spark, _close_run(spark, d), "decisions")
    return dec.groupBy("outcome").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("close_outbox")
def q_close_outbox(spark, d):
    """J20+I9: close outbox rows, payload read back into columns."""
    ob = _payload_cols(_output(spark, _close_run(spark, d), "outbox"), "state string, tags array<string>")
    return ob.select("issue_id", "kind", F.col("p.state").alias("state"),
                     F.array_join("p.tags", "|").alias("tags"))


QUESTION_SLICE = 100


@query("question_summary")
def q_question_summary(spark, d):
    """J15+A12: question responses parsed into count and all_resolved; a
    string "true" does not count (Q14). Every user turn of a conversation is a
    question, with its whole text; responses are landed in slices of
    QUESTION_SLICE turn numbers (as a responder answers long threads), so no
    conversation is collected whole, and a conversation's slices are summed."""
    from .operators.closing import parse_questions
    turns = T(spark, d, "conversations").select("conv_id", "turn", "role", "text").dropDuplicates(["conv_id", "turn"])
    last = turns.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_answer"))
    g = (turns.join(last, "conv_id").groupBy("conv_id", F.floor(F.col("turn") / QUESTION_SLICE).alias("slice"), "last_answer")
         .agg(F.array_sort(F.collect_list(F.when(F.col("role") == "user", F.struct("turn", "text")))).alias("qs")))
    qs = F.transform("qs", lambda x, i: F.struct(
        (i + 1).alias("id"), x["text"].alias("question"),
        F.coalesce(x["turn"] < F.col("last_answer"), F.lit(False)).alias("resolved")))
    built = g.select("conv_id", qs.alias("questions"))
    all_res = F.forall("questions", lambda x: x["resolved"])
    resp = built.select("conv_id", F.to_json(F.struct(
        F.col("conv_id").cast("string").alias("pylon_issue_id"), "questions",
        F.size("questions").cast("string").alias("quantity"),
        F.when(F.col("conv_id") % 10 == 0, F.when(all_res, "true").otherwise("false"))
         .alias("all_resolved_text"),
        F.when(F.col("conv_id") % 10 != 0, all_res).alias("all_resolved"))).alias("response"))
    resp = resp.select("conv_id", F.regexp_replace("response", '"all_resolved_text":', '"all_resolved":')
                       .alias("response"))
    a = parse_questions(F.col("response"))
    return resp.groupBy(F.col("conv_id").cast("string").alias("issue_id")).agg(
        F.sum(a["n_questions"]).cast("long").alias("n_questions"), F.every(a["all_resolved"]).alias("all_resolved"))


@query("messages_of_selected")
def q_messages_of_selected(spark, d):
    """JN6+L3: messages of the issues selected by the time window."""
    from .plans.replicate import selected_messages
    ids = _ids(spark, d, start=WINDOW_START, end=WINDOW_END)
    m = fx.warehouse(spark, d, "li_messages").select("issue_id", "message_id")
    return selected_messages(m, ids)


# ------------------------------------------------------------------ replicate
@query("replicate_report")
def q_replicate_report(spark, d):
    """E1-E3+A8+A9: every object type from landed pages -> rows -> rejects ->
    dedup; per-object counters plus the overall rollup row."""
    from .operators.runlog import with_overall
    from .plans.replicate import items_from_pages, replicate_rows
    from .schema import REPLICATION_ORDER
    parts = []
    for t in REPLICATION_ORDER:
        pages = fx.warehouse(spark, d, f"pages_{t}")
        _, counters = replicate_rows(items_from_pages(pages, t), t)
        parts.append(counters)
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return with_overall(res)


def _replicated(spark, d) -> dict:
    """The planted account pages replicated into a keyed table, with stored
    rejects and bad pages."""
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_object
    from .session import scratch_path
    out = {k: scratch_path(spark, f"replicate-{k}") for k in ("rejects", "bad")}
    out["table"] = KeyedTable(spark, scratch_path(spark, "replicate"), "accounts")
    out["counters"] = replicate_object(spark, fx.warehouse(spark, d, "replicate_pages"), "accounts", out["table"],
                                       rejects_path=out["rejects"], bad_pages_path=out["bad"])
    return out


@query("replicate_write")
def q_replicate_write(spark, d):
    """E1 with the write: landed pages (a run that comes again, keys on two
    pages and twice on one, cut pages mid-run, empty ids) into a keyed table,
    read back."""
    from .functions.jsonx import json_value
    return _replicated(spark, d)["table"].read().select("account_id", json_value("data", "$.name").alias("name"))


@query("replicate_counters")
def q_replicate_counters(spark, d):
    """A8 of the write: rejects and bad pages are the errors."""
    return _replicated(spark, d)["counters"]


@query("flush_counters")
def q_flush_counters(spark, d):
    """I5+A8: the planted account pages written in flushes of fewer records
    than a page holds, of a page's, of more, and page by page."""
    from functools import reduce
    from .operators.merge import KeyedTable
    from .plans.replicate import flush_size, replicate_object
    from .session import scratch_path
    pages = fx.warehouse(spark, d, "replicate_pages")
    out = []
    for size in (flush_size(40), flush_size(batch_size=250), flush_size(5000), flush_size(save_each_page=True)):
        t = KeyedTable(spark, scratch_path(spark, f"flush-{size}"), "accounts")
        out.append(replicate_object(spark, pages, "accounts", t, flush=size).select(F.lit(size).cast("long").alias("flush_size"), "*"))
    return reduce(DataFrame.unionByName, out)


@query("replicate_flushed")
def q_replicate_flushed(spark, d):
    """I5+I4: which record of a key stays depends on the flush it was written
    in: flushes of 250 records across pages, later flush wins, inside a flush
    the first."""
    from .functions.jsonx import json_value
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_object
    from .session import scratch_path
    t = KeyedTable(spark, scratch_path(spark, "flushed"), "accounts")
    replicate_object(spark, fx.warehouse(spark, d, "replicate_pages"), "accounts", t, flush=250)
    return t.read().select("account_id", json_value("data", "$.name").alias("name"))


@query("replicate_all")
def q_replicate_all(spark, d):
    """E3 with its writes: every object type into its keyed table, three at a
    time; counters and the overall row, as the run log has them."""
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_all
    from .schema import REPLICATION_ORDER
    from .session import scratch_path
    tables = {t: KeyedTable(spark, scratch_path(spark, f"all-{t}"), t) for t in REPLICATION_ORDER}
    log = scratch_path(spark, "run-log")
    replicate_all(spark, {t: fx.warehouse(spark, d, f"pages_{t}") for t in REPLICATION_ORDER}, tables, log_path=log, at_once=3)
    return spark.read.parquet(log).select("object_type", "table_name", "total_processed", "total_errors", "total_batches", "rows_kept", "success")


@query("run_log")
def q_run_log(spark, d):
    """What replicate, classify and truncate write to the run log."""
    from .operators.merge import KeyedTable
    from .plans import release
    from .plans.classify import classify
    from .plans.replicate import replicate_all
    from .plans.truncate import truncate
    from .session import scratch_path
    log = scratch_path(spark, "run-log")
    users = KeyedTable(spark, scratch_path(spark, "log-users"), "users")
    replicate_all(spark, {"users": fx.warehouse(spark, d, "pages_users")}, {"users": users}, log_path=log)
    release(classify(_issues(spark, d), fx.warehouse(spark, d, "li_messages"), _teams(spark, d), log_path=log))
    truncate(users, "users", log_path=log)
    return spark.read.parquet(log).select("command", "object_type", "total_processed", "total_errors", "total_classified", "rows_before",
                                          "rows_after", "success", F.col("error").isNotNull().alias("failed"))


@query("replicate_chunked")
def q_replicate_chunked(spark, d):
    """P3+E1+I10: issues in chunks of 240 days, each with its own landing
    folder. The source fails once for the second chunk: the others are
    written, and a second run of the command does that chunk alone."""
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_chunked
    from .session import scratch_path
    landed = fx.warehouse(spark, d, "pages_issue_chunks")
    table, log = KeyedTable(spark, scratch_path(spark, "chunked"), "issues"), scratch_path(spark, "chunk-log")
    down = {1}

    def fetch(chunk_no: int) -> DataFrame:
        if chunk_no in down:
            down.discard(chunk_no)
            raise ConnectionError("source down")
        return landed.where(F.col("chunk_no") == chunk_no).drop("chunk_no")

    for _ in range(2):
        out = replicate_chunked(spark, fetch, table, CHUNK_START, CHUNK_END, log, "issues", days=fx.CHUNK_DAYS)
    done = out.groupBy("chunk_no").agg(F.count(F.lit(1)).cast("long").alias("attempts"), F.max("total_processed").alias("total_processed"),
                                       F.count(F.when(F.col("status") == "failed", 1)).cast("long").alias("failed"))
    kept = table.read().select(_chunk_of("data").alias("chunk_no")).groupBy("chunk_no").agg(F.count(F.lit(1)).cast("long").alias("in_table"))
    return done.join(kept, "chunk_no")


def _chunk_of(data: str) -> Column:
    from .functions.jsonx import json_ts
    from .operators.filters import chunk_index
    return chunk_index(json_ts(data, "$.modified_at"), CHUNK_START, CHUNK_END, fx.CHUNK_DAYS)


@query("incremental_conversations")
def q_incremental_conversations(spark, d):
    """ST2+E6: conversations of all issues, then a second load of messages (a
    changed first message for every third issue) and an incremental run that
    rebuilds only what it touched."""
    from .operators.merge import KeyedTable
    from .plans.incremental import conversation_table, refresh_conversations
    from .session import scratch_path
    m = fx.warehouse(spark, d, "chat_messages").withColumns({
        "updated_at": F.current_timestamp(), "page_no": F.lit(0).cast("long"), "pos": F.lit(0).cast("long")})
    messages = KeyedTable(spark, scratch_path(spark, "inc-messages"), "messages")
    target = conversation_table(spark, scratch_path(spark, "inc-conversations"))
    messages.upsert(m)
    refresh_conversations(messages, _teams(spark, d), target)
    first = m.where((F.col("issue_id").cast("long") % 3 == 0) & (F.col("message_id") == "0"))
    changed = F.parse_json(F.regexp_replace(F.to_json("data"), '"message_html":"', '"message_html":"edited '))
    messages.upsert(first.withColumn("data", changed))
    rebuilt = refresh_conversations(messages, _teams(spark, d), target).withColumn("rebuilt", F.lit(True))
    return target.read().join(rebuilt, "issue_id", "left").select("issue_id", "n_lines", "conversation",
                                                                  F.coalesce("rebuilt", F.lit(False)).alias("rebuilt"))


@query("bad_pages")
def q_bad_pages(spark, d):
    """Pages that do not parse, as the write stored them."""
    path = _replicated(spark, d)["bad"]
    return spark.read.schema("object_type string, run_id string, page_no long, body string").parquet(path) \
                .select("object_type", "run_id", "page_no")


@query("reject_rows")
def q_reject_rows(spark, d):
    """Rejected records, as the write stored them."""
    path = _replicated(spark, d)["rejects"]
    return spark.read.schema("object_type string, run_id string, page_no long, pos long, reject_reason string, record string") \
                .parquet(path).select("object_type", "run_id", "page_no", "reject_reason")


@query("replicate_issues_filtered")
def q_replicate_issues_filtered(spark, d):
    """E1+P1+P2: issues replicated under a time range, states and a field
    filter, written and read back."""
    from .functions.jsonx import json_value
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_object
    from .session import scratch_path
    t = KeyedTable(spark, scratch_path(spark, "issues-filtered"), "issues")
    replicate_object(spark, fx.warehouse(spark, d, "pages_issues"), "issues", t, issue_filter={
        "modified_start": dt.datetime(1995, 6, 1), "modified_end": dt.datetime(1998, 1, 15),
        "states": ["closed", "waiting_on_customer"], "extra": {"source": ["slack", 5, True]}})
    return t.read().select("issue_id", json_value("data", "$.state").alias("state"))


@query("replicate_messages_selected")
def q_replicate_messages_selected(spark, d):
    """E2+P4+JN6: messages of the issues that the time window selects, written
    and read back."""
    from .operators.merge import KeyedTable
    from .plans.replicate import replicate_object
    from .session import scratch_path
    t = KeyedTable(spark, scratch_path(spark, "messages-selected"), "messages")
    replicate_object(spark, fx.warehouse(spark, d, "pages_messages"), "messages", t,
                     issue_ids=_ids(spark, d, start=WINDOW_START, end=WINDOW_END))
    return t.read().select("issue_id", "message_id")


def _loaded(spark, d, object_type: str) -> DataFrame:
    from .plans.replicate import items_from_pages, replicate_rows
    kept, _ = replicate_rows(items_from_pages(fx.warehouse(spark, d, f"pages_{object_type}"), object_type),
                             object_type)
    return kept


@query("load_accounts")
def q_load_accounts(spark, d):
    """S4+J5: accounts table rows (cursor pages)."""
    from .functions.jsonx import json_value
    return _loaded(spark, d, "accounts").select("account_id", json_value("data", "$.name").alias("name"))


@query("load_issues")
def q_load_issues(spark, d):
    """S5+P1+J5: issues from search pages, filtered by a modified_at range
    and states (the search body), then transformed."""
    from .functions.jsonx import json_value
    from .plans.replicate import items_from_pages, replicate_rows, select_items
    items = select_items(items_from_pages(fx.warehouse(spark, d, "pages_issues"), "issues"), "issues", issue_filter={
        "modified_start": dt.datetime(1996, 1, 1), "modified_end": dt.datetime(1997, 12, 31), "states": ["closed", "on_hold"]})
    kept, _ = replicate_rows(items, "issues")
    return kept.select("issue_id", json_value("data", "$.state").alias("state"),
                       json_value("data", "$.source").alias("source"))


@query("load_users")
def q_load_users(spark, d):
    """S7+J5: users table rows (offset pages)."""
    from .functions.jsonx import json_value
    return _loaded(spark, d, "users").select("user_id", json_value("data", "$.email").alias("email"))


@query("load_teams")
def q_load_teams(spark, d):
    """S8+J5: teams table rows with their member count."""
    from .functions.jsonx import json_array, json_value
    t = _loaded(spark, d, "teams")
    return t.select("team_id", json_value("data", "$.name").alias("name"),
                    F.coalesce(F.size(json_array("data", "$.users")), F.lit(0)).cast("long").alias("n_users"))


# ------------------------------------------------------------------ scorer (F1)
def _count_words(batch):
    """A scorer that fails for whole batches: on every 17th request."""
    if (batch["issue_id"].astype(int) % 17 == 0).any():
        raise RuntimeError("scorer down")
    return batch["user"].map(lambda t: str(len(t.split())))


@query("batch_scores")
def q_batch_scores(spark, d):
    """F1 as Arrow batches: an external scorer over every document's whole
    text; a failing request loses its own response only, with the reason."""
    from .operators.scorer import score_with
    reqs = T(spark, d, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit("count").alias("system"),
                                           F.coalesce("text", F.lit("")).alias("user"))
    return score_with(reqs, _count_words)


@query("score_resumed")
def q_score_resumed(spark, d):
    """F1 resumable: every document's text is asked; the scorer fails for some
    requests, and a second run asks only those (answers name their run)."""
    from .operators.scorer import score_logged
    from .session import scratch_path
    reqs = T(spark, d, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit("count").alias("system"),
                                           F.coalesce("text", F.lit("")).alias("user"))
    log = scratch_path(spark, "responses")
    score_logged(reqs, _count_or_fail, log, slices=3)
    return score_logged(reqs, _count_again, log, slices=3)


def _count_or_fail(batch):
    words = batch["user"].map(lambda t: len(t.split()))
    if (words % 17 == 0).any():
        raise RuntimeError("scorer down")
    return "1:" + words.astype(str)


def _count_again(batch):
    return "2:" + batch["user"].map(lambda t: str(len(t.split())))


@query("keyword_scores")
def q_keyword_scores(spark, d):
    """F1 default scorer: taxonomy keyword hits per document and label over
    the whole text of every document."""
    from .operators.scorer import keyword_hits, keyword_table
    h = keyword_hits(T(spark, d, "documents"), "doc_id", "text", keyword_table(spark))
    return h.select(F.col("id").alias("doc_id"), "field", "label", "hits")


# ------------------------------------------------------------------ streaming (ST1)
@query("stream_upsert")
def q_stream_upsert(spark, d):
    """ST1: account pages landed as files are drained by a Structured
    Streaming query (availableNow, 100 files per micro-batch) into the keyed
    table; update pages landed afterwards are picked up by a restart from
    the same checkpoint, and the later batch wins. The update pages re-land
    every account of two market segments with a changed segment."""
    from .functions.jsonx import json_value
    from .operators.merge import KeyedTable
    from .session import scratch_path
    from .sources.pages import write_landed
    from .streaming.pages_stream import stream_upsert
    cust = T(spark, d, "customer")
    recs = fx.account_records(cust)
    k = F.col("key")
    pag = F.struct(F.lit(True).alias("has_next_page"),
                   F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")).alias("cursor"))
    first = _pages(recs, F.lit("r0"), (k / 100).cast("long"), k, pag)
    upd = fx.account_records(cust.where(F.col("c_mktsegment").isin(*UPDATED_SEGMENTS))).withColumn(
        "record", F.regexp_replace("record", r'"segment":"([^"]*)"', '"segment":"$1-v2"'))
    second = _pages(upd, F.lit("r0"), (k / 100).cast("long") + 1000, k, pag)
    root, ck = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    table = KeyedTable(spark, scratch_path(spark, "accounts"), "accounts", landing=True)
    write_landed(first, root)
    stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=100).awaitTermination()
    write_landed(second, root + "/updates")
    stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=100).awaitTermination()
    t = table.read()
    return t.select("account_id", json_value("data", "$.name").alias("name"),
                    json_value("data", "$.segment").alias("segment"))


@query("stream_chain_cut")
def q_stream_chain_cut(spark, d):
    """ST1+S2: a run per nation, one page file a trigger's share; the page
    that ends every third run lands last, after a restart, and one more page
    behind it later still. The table reads as the chain says."""
    from .functions.jsonx import json_value
    from .operators.merge import KeyedTable
    from .session import scratch_path
    from .sources.pages import write_landed
    from .streaming.pages_stream import stream_upsert
    cust = T(spark, d, "customer")
    k, n = F.col("key"), F.col("nation")
    recs = fx.account_records(cust).join(cust.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation")), "key")
    page = (k % 6).cast("long")
    plain = _pages(recs, n.cast("string"), page, k, F.struct(F.lit(True).alias("has_next_page"), F.lit("c").alias("cursor")))
    stop = _pages(recs, n.cast("string"), page, k, F.struct(F.lit(False).alias("has_next_page"), F.lit("c").alias("cursor")))
    last = (F.col("run_id").cast("int") % 3 == 0) & (F.col("page_no") == 2)
    root, ck = scratch_path(spark, "chain-landing"), scratch_path(spark, "chain-ckpt")
    table = KeyedTable(spark, scratch_path(spark, "chain"), "accounts", landing=True)
    for part, pages in (("a", plain.where(~last & (F.col("page_no") < 5))), ("b", stop.where(last)), ("c", plain.where(F.col("page_no") == 5))):
        write_landed(pages, f"{root}/{part}")
        stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=60).awaitTermination()
    return table.read().select("account_id", json_value("data", "$.name").alias("name"))
