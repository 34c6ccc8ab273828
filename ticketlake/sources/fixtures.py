"""Reference-shaped records derived from the driver tables (FIXTURES.md §3).

The driver data is TPC-H-like; these builders give it the shape of the
support-desk API so the real operators run on it:

* ``orders``        -> issues   (state, source, custom_fields, tags planted by key)
* ``lineitem``      -> messages (repeated keys: the dedup fixture)
* ``events``        -> long threads (49-86 messages per user: truncation fixture)
* ``conversations`` -> chat threads (2-8 turns)
* ``nation``/``region`` x ``supplier`` -> teams with staff users
* ``customer``      -> accounts and contacts; ``supplier`` -> users

Every rule here is plain column arithmetic, mirrored one-to-one by the SQL
oracles. All builders are narrow projections over one scan: no shuffles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import json_ts, to_text_ts
from ..functions.labels import CATEGORIES, RESOLUTIONS
from ..operators.filters import chunk_index

# Planted state/source mapping and e-mail domains of the fixtures.
ORDER_STATE = {"F": "closed", "O": "waiting_on_customer", "P": "on_hold"}
SLACK_PRIORITY = "1-URGENT"
STAFF_DOMAIN = "@staff.example"
CUSTOMER_DOMAIN = "@customer.example"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(labels: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x[0]) for x in labels]), (idx + 1).cast("int"))


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols))


def staff_email(key: Column) -> Column:
    return F.concat(F.lit("agent"), _s(key), F.lit(STAFF_DOMAIN))


def customer_email(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), _s(key), F.lit(CUSTOMER_DOMAIN))


# ---------------------------------------------------------------- issues
def issue_label_columns(k: Column) -> dict:
    """Planted custom-field labels of issue key ``k`` (NULL = field absent)."""
    resolution = (F.when(k % 3 == 0, F.lit(None).cast("string"))
                   .when(k % 7 == 4, F.lit(""))
                   .when(k % 13 == 0, F.lit("bug_fixed"))
                   .otherwise(_pick(RESOLUTIONS, k % 6)))
    category = (F.when(k % 5 == 0, F.lit(None).cast("string"))
                 .when(k % 17 == 0, F.lit("langgraph_platform"))
                 .otherwise(_pick(CATEGORIES, k % 26)))
    return {"resolution": resolution, "category": category}


def issue_tags(k: Column, priority: Column) -> Column:
    """Planted tags: already tagged, NULL, empty, repeated, or one priority tag."""
    return (F.when(k % 7 == 0, F.array(F.lit("vip"), F.lit("auto-classified")))
             .when(k % 7 == 1, F.lit(None).cast("array<string>"))
             .when(k % 7 == 2, F.array().cast("array<string>"))
             .when(k % 7 == 3, F.array(F.lit("vip"), F.lit("vip"), F.lit("auto-closed")))
             .otherwise(F.array(F.concat(F.lit("p"), F.substring(priority, 1, 1)))))


def issue_frame(orders: DataFrame) -> DataFrame:
    """Issue records as typed columns plus the JSON text ``record``."""
    k = F.col("o_orderkey")
    labels = issue_label_columns(k)
    state = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ORDER_STATE.items() for x in kv]),
                                    F.col("o_orderstatus")), F.col("o_orderstatus"))
    created = F.col("o_orderdate")
    res_obj = F.when(labels["resolution"].isNotNull(), F.struct(labels["resolution"].alias("value"))) \
               .when(k % 6 == 3, F.struct(F.lit(None).cast("string").alias("value")))
    cat_obj = F.when(labels["category"].isNotNull(), F.struct(labels["category"].alias("value")))
    record = _json(
        _s(k).alias("id"),
        state.alias("state"),
        F.when(F.col("o_orderpriority") == SLACK_PRIORITY, F.lit("slack")).otherwise(F.lit("email")).alias("source"),
        _s("o_custkey").alias("account_id"),
        to_text_ts(created).alias("created_at"),
        to_text_ts(created + F.make_interval(days=(k % 30).cast("int"))).alias("modified_at"),
        to_text_ts(created + F.make_interval(days=(k % 90).cast("int"))).alias("latest_message_time"),
        issue_tags(k, F.col("o_orderpriority")).alias("tags"),
        F.struct(res_obj.alias("resolution"), cat_obj.alias("category")).alias("custom_fields"),
    )
    return orders.select(
        _s(k).alias("issue_id"), k.alias("key"),
        (k / 100).cast("long").alias("page_no"), (k % 100).alias("pos"),
        record.alias("record"), created.alias("created_day"))


def issues_table(orders: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Warehouse ``issues`` table: issue_id, data VARIANT, updated_at."""
    f = issue_frame(orders)
    if stamp is None:
        stamp = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    return f.select("issue_id", F.parse_json("record").alias("data"), stamp.alias("updated_at"),
                    "key", "page_no", "pos")


def flat_issues(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """External flattened issue table (display-form state; latest message
    time from the issue's lines; NULL when it has none)."""
    last = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    display = {"F": "Closed", "O": "Waiting on Customer", "P": "On Hold"}
    st = F.element_at(F.create_map(*[F.lit(x) for kv in display.items() for x in kv]), F.col("o_orderstatus"))
    return (orders.join(last, orders.o_orderkey == last.l_orderkey, "left")
            .select(_s("o_orderkey").alias("id"),
                    F.col("o_orderdate").cast("timestamp").alias("created_at"),
                    F.col("last_ship").cast("timestamp").alias("latest_message_time"),
                    st.alias("state")))


# ---------------------------------------------------------------- messages
def lineitem_messages(lineitem: DataFrame) -> DataFrame:
    """Messages from lines: issue = order, message = line number; staff
    author on odd lines, customer contact on even lines. ``updated_at`` is the
    ship date; ``seen`` is the total landing order of FIXTURES.md §3."""
    staff = F.col("l_linenumber") % 2 == 1
    author = F.struct(
        F.when(staff, F.struct(staff_email(F.col("l_suppkey")).alias("email"))).alias("user"),
        F.struct(customer_email("c", F.col("l_partkey")).alias("email")).alias("contact"))
    record = _json(
        _s("l_linenumber").alias("id"),
        to_text_ts("l_shipdate").alias("timestamp"),
        F.concat(F.lit("<p>Part "), _s("l_partkey"), F.lit(" &amp; qty "), _s("l_quantity"),
                 F.lit("</p>")).alias("message_html"),
        author.alias("author"))
    return lineitem.select(
        _s("l_orderkey").alias("issue_id"), _s("l_linenumber").alias("message_id"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus").alias("seen"),
        "l_partkey", "l_suppkey", F.parse_json(record).alias("data"))


def event_messages(events: DataFrame) -> DataFrame:
    """Long threads: issue = user, message = event; 'error' events have no
    author, 'purchase' events come from staff, the rest from the customer."""
    et = F.col("event_type")
    author = (F.when(et == "error", F.lit(None).cast("struct<user:struct<email:string>,contact:struct<email:string>>"))
               .when(et == "purchase", F.struct(F.struct(staff_email(F.col("event_id") % 13).alias("email")).alias("user"),
                                                F.lit(None).cast("struct<email:string>").alias("contact")))
               .otherwise(F.struct(F.lit(None).cast("struct<email:string>").alias("user"),
                                   F.struct(customer_email("user", F.col("user_id")).alias("email")).alias("contact"))))
    record = _json(
        _s("event_id").alias("id"),
        to_text_ts("ts", micros=True).alias("timestamp"),
        F.concat(F.lit("<div><p>"), et, F.lit(" &amp;&nbsp;</p>\n<b>"), F.col("props"),
                 F.lit("</b></div>")).alias("message_html"),
        author.alias("author"))
    return events.select(_s("user_id").alias("issue_id"), _s("event_id").alias("message_id"),
                         F.parse_json(record).alias("data"))


def chat_messages(conversations: DataFrame) -> DataFrame:
    """Chat threads: issue = conversation, message = turn; user -> customer
    contact, assistant -> staff user, system -> no author."""
    role = F.col("role")
    author = (F.when(role == "user", F.struct(F.lit(None).cast("struct<email:string>").alias("user"),
                                              F.struct(customer_email("user", F.col("conv_id")).alias("email")).alias("contact")))
               .when(role == "assistant", F.struct(F.struct(staff_email(F.col("conv_id") % 13).alias("email")).alias("user"),
                                                   F.lit(None).cast("struct<email:string>").alias("contact"))))
    ts = F.to_timestamp(F.lit("2024-03-01 00:00:00")) + F.make_interval(
        hours=(F.col("conv_id") % 1000).cast("int"), mins=F.col("turn").cast("int"))
    record = _json(_s("turn").alias("id"), to_text_ts(ts).alias("timestamp"),
                   F.col("text").alias("message_html"), author.alias("author"))
    return conversations.select(_s("conv_id").alias("issue_id"), _s("turn").alias("message_id"),
                                F.parse_json(record).alias("data"))


# ---------------------------------------------------------------- directory
def teams_frame(nation: DataFrame, region: DataFrame, supplier: DataFrame) -> DataFrame:
    """Teams = nations and regions; members = suppliers of the nation/region.
    Every staff member is in two teams; e-mail is NULL when key % 10 = 9."""
    member = F.struct(F.concat(F.lit("s"), _s("s_suppkey")).alias("id"),
                      F.when(F.col("s_suppkey") % 10 != 9, staff_email(F.col("s_suppkey"))).alias("email"))
    sup = supplier.select("s_suppkey", "s_nationkey")
    by_nation = (sup.groupBy("s_nationkey").agg(F.sort_array(F.collect_list(F.struct("s_suppkey", member.alias("m")))).alias("ms"))
                 .select("s_nationkey", F.transform("ms", lambda x: x["m"]).alias("users")))
    nations = (nation.join(by_nation, nation.n_nationkey == by_nation.s_nationkey, "left")
               .select(F.concat(F.lit("n"), _s("n_nationkey")).alias("team_id"),
                       F.col("n_name").alias("name"), "users"))
    sup_region = sup.join(nation.select("n_nationkey", "n_regionkey"), sup.s_nationkey == nation.n_nationkey)
    by_region = (sup_region.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("s_suppkey", member.alias("m")))).alias("ms"))
                 .select("n_regionkey", F.transform("ms", lambda x: x["m"]).alias("users")))
    regions = (region.join(by_region, region.r_regionkey == by_region.n_regionkey, "left")
               .select(F.concat(F.lit("r"), _s("r_regionkey")).alias("team_id"),
                       F.col("r_name").alias("name"), "users"))
    return nations.unionByName(regions)


def teams_table(nation: DataFrame, region: DataFrame, supplier: DataFrame) -> DataFrame:
    t = teams_frame(nation, region, supplier)
    rec = _json(F.col("team_id").alias("id"), "name", "users")
    return t.select("team_id", F.parse_json(rec).alias("data"))


# ---------------------------------------------------------------- small objects
def account_records(customer: DataFrame) -> DataFrame:
    rec = _json(_s("c_custkey").alias("id"), F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("segment"), _s("c_nationkey").alias("nation"))
    return customer.select(F.col("c_custkey").alias("key"), rec.alias("record"))


def contact_records(customer: DataFrame) -> DataFrame:
    """Contacts: account_id = nation key, absent when key % 10 = 0."""
    acct = F.when(F.col("c_custkey") % 10 != 0, _s("c_nationkey"))
    rec = _json(F.concat(F.lit("ct"), _s("c_custkey")).alias("id"), F.col("c_name").alias("name"),
                acct.alias("account_id"))
    return customer.select(F.col("c_custkey").alias("key"), rec.alias("record"))


def user_records(supplier: DataFrame) -> DataFrame:
    rec = _json(F.concat(F.lit("s"), _s("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
                F.when(F.col("s_suppkey") % 10 != 9, staff_email(F.col("s_suppkey"))).alias("email"))
    return supplier.select(F.col("s_suppkey").alias("key"), rec.alias("record"))


# ---------------------------------------------------------------- landed pages
def page_envelopes(records: DataFrame, run: Column, page: Column, pos: Column,
                   record: str = "record", pagination: Column | None = None) -> DataFrame:
    """Group JSON records into landed page bodies (test/bench landing helper).
    Each page holds a bounded number of records; order inside is ``pos``."""
    g = (records.select(run.alias("run_id"), page.alias("page_no"), pos.alias("pos"), F.col(record).alias("r"))
         .groupBy("run_id", "page_no")
         .agg(F.array_sort(F.collect_list(F.struct("pos", "r"))).alias("rs")))
    data = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda x: x["r"]), ","), F.lit("]"))
    pag = pagination if pagination is not None else F.struct(F.lit(True).alias("has_next_page"))
    return g.select("run_id", "page_no",
                    F.concat(F.lit('{"data":'), data, F.lit(',"pagination":'), F.to_json(pag), F.lit("}"))
                    .alias("body"))


#: Teams of one kind are landed in pages of so many team numbers.
TEAMS_A_PAGE = 5
#: Messages of an issue are landed in pages of so many message numbers.
PAGE_MESSAGES = 1000


def response_pages(records: DataFrame, group: str, order: str, number: Column, record: str = "record") -> DataFrame:
    """``(group, page_no, data)``: each group's records as JSON array texts in
    ``order``, a page for every PAGE_MESSAGES message numbers (a rule on the
    message alone, whatever the group's size). A page is bounded, so no group
    is collected whole. Records are dealt to pages before they are collected:
    collecting on the map side would sort and spill them without shrinking them."""
    g = (records.select(group, F.floor(number / F.lit(PAGE_MESSAGES)).cast("long").alias("page_no"),
                        F.struct(F.col(order).alias("o"), F.col(record).alias("r")).alias("e"))
         .repartition(group, "page_no").groupBy(group, "page_no").agg(F.array_sort(F.collect_list("e")).alias("rs")))
    data = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda x: x["r"]), ","), F.lit("]"))
    return g.select(group, "page_no", data.alias("data"))


def items_before(pages: DataFrame, run: str = "run_id", page: str = "page_no",
                 n: str = "n_items", block: int = 1024) -> DataFrame:
    """Adds ``items_before``: items on the earlier pages of the same run (the
    offset a page should start at). A two-level prefix sum, so no window
    spans a whole run: per-block totals (``block`` pages) get a running sum
    over the blocks of a run (a few rows), pages a running sum inside their
    block, and the block prefix is joined back on (run, block)."""
    from pyspark.sql import Window
    b = (F.col(page) / F.lit(block)).cast("long")
    with_block = pages.withColumn("_blk", b)
    totals = with_block.groupBy(run, "_blk").agg(F.sum(n).alias("_t"))
    before_blk = Window.partitionBy(run).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(run, "_blk", F.coalesce(F.sum("_t").over(before_blk), F.lit(0)).alias("_bp"))
    in_blk = Window.partitionBy(run, "_blk").orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    inner = with_block.withColumn("_ip", F.coalesce(F.sum(n).over(in_blk), F.lit(0)))
    return (inner.join(prefix, [run, "_blk"])
            .withColumn("items_before", (F.col("_bp") + F.col("_ip")).cast("long"))
            .drop("_blk", "_bp", "_ip"))


def bad_id_records(records: DataFrame) -> DataFrame:
    """Issue records with planted falsy ids: absent (key % 97 = 0), '' (key %
    89 = 0) and number 0 (key % 83 = 0)."""
    k, rec = F.col("key"), F.col("record")
    rid = F.concat(F.lit('"id":"'), k.cast("string"), F.lit('",'))
    bad = (F.when(k % 97 == 0, F.replace(rec, rid, F.lit("")))
            .when(k % 89 == 0, F.replace(rec, rid, F.lit('"id":"",')))
            .when(k % 83 == 0, F.replace(rec, rid, F.lit('"id":0,')))
            .otherwise(rec))
    return records.select("key", "issue_id", "page_no", "pos", bad.alias("record"))


def landed_pages(spark: SparkSession, d: str, object_type: str) -> DataFrame:
    """API responses as landed pages per object type: 100 records per page in
    key order with a cursor chain (teams: pages of TEAMS_A_PAGE numbers; messages: one
    unpaginated response per parent issue and PAGE_MESSAGES message numbers)."""
    t = lambda n: table(spark, d, n)
    k = F.col("key")
    pag = F.struct(F.lit(True).alias("has_next_page"),
                   F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")).alias("cursor"))
    if object_type == "messages":
        m = warehouse(spark, d, "li_messages").select("issue_id", "message_id", "seen",
                                                      F.to_json("data").alias("record"))
        g = response_pages(m, "issue_id", "seen", F.col("message_id").cast("long"))
        return g.select("issue_id", F.lit("r0").alias("run_id"), "page_no",
                        F.concat(F.lit('{"data":'), F.col("data"), F.lit("}")).alias("body"))
    if object_type == "teams":
        tf = teams_frame(t("nation"), t("region"), t("supplier"))
        recs = tf.select("team_id", F.xxhash64("team_id").alias("key"),
                         F.to_json(F.struct(F.col("team_id").alias("id"), "name", "users")).alias("record"))
        number = F.regexp_extract("team_id", "[0-9]+", 0).cast("long")
        page = F.floor(number / F.lit(TEAMS_A_PAGE)).cast("long") + F.when(F.col("team_id").startswith("r"), 1000).otherwise(0)
        return page_envelopes(recs, F.lit("r0"), page, k, "record")
    recs = {"accounts": lambda: account_records(t("customer")),
            "contacts": lambda: contact_records(t("customer")),
            "users": lambda: user_records(t("supplier")),
            "issues": lambda: bad_id_records(warehouse(spark, d, "issue_records"))}[object_type]()
    return page_envelopes(recs, F.lit("r0"), (k / 100).cast("long"), k, "record", pag)


def chat_issues(conversations: DataFrame) -> DataFrame:
    """One closed issue without labels for each conversation."""
    c = conversations.select("conv_id").distinct()
    rec = _json(_s("conv_id").alias("id"), F.lit("closed").alias("state"), F.lit("2024-03-01T00:00:00Z").alias("created_at"),
                F.array(F.lit("chat")).alias("tags"))
    return c.select(_s("conv_id").alias("issue_id"), F.parse_json(rec).alias("data"))


def keyword_messages(conversations: DataFrame) -> DataFrame:
    """Chat messages that end with label words, chosen by the text's length."""
    v = F.length("text") % 5
    said = (F.when(v == 0, " billing refunds, Billing!").when(v == 1, " bug fix" * 8).when(v == 2, " spam").otherwise(""))
    return chat_messages(conversations.withColumn("text", F.concat("text", said)))


#: Issues in chunks of time: first and last instant, days of a chunk.
CHUNK_START, CHUNK_END, CHUNK_DAYS = dt.datetime(1996, 1, 1), dt.datetime(1999, 6, 15), 240


def issue_chunk_pages(records: DataFrame) -> DataFrame:
    """Issue pages (100 keys each) landed chunk by chunk of ``modified_at``:
    (chunk_no, run_id, page_no, body)."""
    own = records.withColumn("chunk_no", chunk_index(json_ts(F.parse_json("record"), "$.modified_at"), CHUNK_START, CHUNK_END, CHUNK_DAYS))
    run = F.concat(F.lit("chunk"), _s("chunk_no"))
    pag = F.struct(F.lit(True).alias("has_next_page"), F.lit("c").alias("cursor"))
    pages = page_envelopes(own.where("chunk_no IS NOT NULL"), run, F.floor(F.col("key") / 100).cast("long"), F.col("key"), "record", pag)
    return pages.withColumn("chunk_no", F.substring("run_id", 6, 10).cast("long"))


def replicate_pages(spark: SparkSession, d: str) -> DataFrame:
    """Account pages with everything that replication must survive, planted by
    key (k, page k div 100): in run r0 the first key of a page comes again on
    the next page, key % 100 = 7 twice on its page, ids are empty where
    key % 50 = 49, and pages with page % 6 = 1 are cut in the middle; run r1
    lands every fifth key again, in pages of 500 keys."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    k = F.col("k")
    page = F.floor(k / 100).cast("long")
    own = c.select("k", F.lit("r0").alias("run"), page.alias("page"), (k % 100).alias("pos"), F.lit("a").alias("mark"))
    later = c.where(k % 100 == 0).select("k", F.lit("r0"), page + 1, F.lit(100).cast("long"), F.lit("b"))
    twice = c.where(k % 100 == 7).select("k", F.lit("r0"), page, F.lit(200).cast("long"), F.lit("c"))
    again = c.where(k % 5 == 0).select("k", F.lit("r1"), F.floor(k / 500).cast("long"), k % 500, F.lit("d"))
    every = own.union(later).union(twice).union(again)
    rec = _json(F.when((k % 50 == 49) & (F.col("mark") == "a"), F.lit("")).otherwise(_s("k")).alias("id"),
                F.concat("run", F.lit("-"), _s("page"), "mark").alias("name"))
    recs = every.select("run", "page", "pos", rec.alias("record"))
    pag = F.struct(F.lit(True).alias("has_next_page"), F.lit("c").alias("cursor"))
    pages = page_envelopes(recs, F.col("run"), F.col("page"), F.col("pos"), "record", pag)
    cut = (F.col("run_id") == "r0") & (F.col("page_no") % 6 == 1)
    return pages.withColumn("body", F.when(cut, F.substr("body", F.lit(1), F.length("body") - 30)).otherwise(F.col("body")))


# ---------------------------------------------------------------- warehouse tables
# The warehouse tables of the reference are stored tables with a parsed
# payload. The fixtures are built once per session and data folder, written
# to the shared checkpoint folder (durable: survives executor loss and cuts
# the JSON-building lineage), and read back by every query.
def _build(spark: SparkSession, d: str, name: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    if name == "issues":
        return issues_table(t("orders"))
    if name == "issue_records":
        return issue_frame(t("orders"))
    if name == "li_messages":
        return lineitem_messages(t("lineitem"))
    if name == "ev_messages":
        return event_messages(t("events"))
    if name == "chat_messages":
        return chat_messages(t("conversations"))
    if name == "teams":
        return teams_table(t("nation"), t("region"), t("supplier"))
    if name == "flat_issues":
        return flat_issues(t("orders"), t("lineitem"))
    if name == "chat_issues":
        return chat_issues(t("conversations"))
    if name == "keyword_messages":
        return keyword_messages(t("conversations"))
    if name == "pages_issue_chunks":
        return issue_chunk_pages(bad_id_records(warehouse(spark, d, "issue_records")))
    if name == "replicate_pages":
        return replicate_pages(spark, d)
    if name.startswith("pages_"):
        return landed_pages(spark, d, name[len("pages_"):])
    raise ValueError(name)


_WAREHOUSE: dict = {}


def warehouse(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Reference-shaped table ``name`` derived from the tables in ``d``."""
    import os

    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, os.path.realpath(d), name)
    if key not in _WAREHOUSE:
        path = scratch_path(spark, f"warehouse-{name}")
        _build(spark, d, name).write.mode("overwrite").parquet(path)
        _WAREHOUSE[key] = path
    return spark.read.parquet(_WAREHOUSE[key])


def prepare_warehouse(spark: SparkSession, d: str) -> None:
    for n in ("issues", "issue_records", "li_messages", "ev_messages", "chat_messages", "teams", "flat_issues", "replicate_pages"):
        warehouse(spark, d, n)
    from ..schema import REPLICATION_ORDER
    for t in REPLICATION_ORDER:
        warehouse(spark, d, f"pages_{t}")
