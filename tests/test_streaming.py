import json

import pytest
from pyspark.sql import functions as F

from ticketlake.operators.merge import KeyedTable
from ticketlake.plans.replicate import items_from_pages, replicate_rows
from ticketlake.session import scratch_path
from ticketlake.sources.pages import write_landed
from ticketlake.streaming.incremental import incremental_cut
from ticketlake.streaming.pages_stream import stream_upsert


def test_stream_equals_batch_and_restarts(spark):
    pages = []
    for p in range(6):
        recs = [{"id": f"a{(p * 3 + i) % 10}", "v": p} for i in range(3)]
        pages.append(("r0", p, json.dumps({"data": recs, "pagination": {"has_next_page": p < 5, "cursor": f"c{p + 1}"}})))
    df = spark.createDataFrame(pages, "run_id string, page_no long, body string")
    root = scratch_path(spark, "land")
    write_landed(df, root)
    table = KeyedTable(spark, scratch_path(spark, "acc"), "accounts", landing=True)
    ck = scratch_path(spark, "ck")
    stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=1).awaitTermination()
    streamed = {r.account_id: r.v for r in table.read().select(
        "account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
    # batch-at-a-time reference: later pages win
    expected = {}
    for _, _, b in pages:
        for rec in json.loads(b)["data"]:
            expected[rec["id"]] = rec["v"]
    assert streamed == expected
    stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=1).awaitTermination()  # restart: no-op
    assert table.read().count() == len(expected)
    one_shot, _ = replicate_rows(items_from_pages(df, "accounts"), "accounts")
    assert {r.account_id: r.v for r in one_shot.select(
        "account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()} == expected     # batch = stream


def _chain(spark, order, triggers=1):
    """Pages 0-5 of run r0, page 2 ends the chain, and of r1, which goes on; landed and streamed in ``order``."""
    def body(run, p):
        return json.dumps({"data": [{"id": f"{run}-{p}-{i}"} for i in range(2)] + [{"id": "both", "v": f"{run}{p}"}],
                           "pagination": {"has_next_page": not (run == "r0" and p == 2), "cursor": "c"}})
    pages = [(run, p, body(run, p)) for run in ("r0", "r1") for p in range(6) if (run, p) != ("r1", 5)]
    df = spark.createDataFrame(pages, "run_id string, page_no long, body string")
    root, ck = scratch_path(spark, "land"), scratch_path(spark, "ck")
    table = KeyedTable(spark, scratch_path(spark, "chain"), "accounts", landing=True)
    for n, part in enumerate(order):
        write_landed(df.where(F.concat("run_id", F.col("page_no").cast("string")).isin(part)), f"{root}/{n}")
        stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=triggers).awaitTermination()
    rows = lambda d: {r.account_id: r.v for r in d.select("account_id", F.try_variant_get("data", "$.v", "string").alias("v")).collect()}
    batch, _ = replicate_rows(items_from_pages(df, "accounts"), "accounts")
    return rows(table.read()), rows(batch), table


@pytest.mark.parametrize("order", [
    [["r00", "r01", "r03", "r04", "r05", "r10", "r11", "r12"], ["r02"], ["r13", "r14"]],           # the stop lands last
    [["r02", "r14"], ["r05", "r04"], ["r13", "r12", "r11", "r10"], ["r03", "r01", "r00"]],         # and first
])
def test_stop_page_in_any_trigger(spark, order):
    streamed, batch, table = _chain(spark, order, triggers=3)
    assert streamed == batch and not any(k.startswith(("r0-3", "r0-4", "r0-5")) for k in streamed)
    table.compact(max_deltas=0)                                # cuts outlive the versions they came with
    assert {r.account_id for r in table.read().collect()} == set(batch)
    assert table.lookup("r0-4-1").count() == 0 and table.lookup("r0-2-1").count() == 1


def test_incremental_conversations_equal_a_full_run(spark):
    import random
    from ticketlake.operators.threads import triage_conversations
    from ticketlake.plans.incremental import conversation_table, mark_of, refresh_conversations
    r = random.Random(3)
    teams = spark.createDataFrame([("t", '{"name": "A", "users": [{"id": "u", "email": "a@x"}]}')], "team_id string, j string") \
                 .select("team_id", F.parse_json("j").alias("data"))
    messages = KeyedTable(spark, scratch_path(spark, "m"), "messages")
    target = conversation_table(spark, scratch_path(spark, "c"))

    def write(step, issues):
        data = [(f"i{i}", f"m{r.randrange(14)}", json.dumps({"timestamp": f"2024-01-{r.randrange(1, 28):02d}", "message_html": f"s{step}-{n}",
                                                             "author": {"user": {"email": "a@x"}}}), 0, n) for n, i in enumerate(issues)]
        df = spark.createDataFrame(data, "issue_id string, message_id string, j string, page_no long, pos long")
        messages.upsert(df.select("issue_id", "message_id", F.parse_json("j").alias("data"), F.current_timestamp().alias("updated_at"), "page_no", "pos"))

    write(0, [i % 20 for i in range(120)])
    assert refresh_conversations(messages, teams, target).count() == 20
    for step in (1, 2):
        touched = r.sample(range(25), 4)
        write(step, touched * 2)
        stamps = {x.issue_id: x.updated_at for x in target.read().collect()}
        assert {x.issue_id for x in refresh_conversations(messages, teams, target).collect()} == {f"i{i}" for i in touched}
        after = {x.issue_id: x.updated_at for x in target.read().collect()}
        assert all((after[k] == t) == (int(k[1:]) not in touched) for k, t in stamps.items())
        full = {(x.issue_id, x.n_lines, x.conversation) for x in triage_conversations(messages.read(), teams).collect()}
        assert {(x.issue_id, x.n_lines, x.conversation) for x in target.read().collect()} == full
    assert refresh_conversations(messages, teams, target).count() == 0 and mark_of(target, "messages") == 2


def test_incremental_cut(spark):
    target = spark.createDataFrame([("2024-01-05 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("updated_at"))
    src = spark.createDataFrame([(1, "2024-01-04 00:00:00"), (2, "2024-01-06 00:00:00")], "id int, t string") \
               .withColumn("t", F.col("t").cast("timestamp"))
    assert [r.id for r in incremental_cut(src, F.col("t"), target).collect()] == [2]
    empty = target.where("false")
    assert incremental_cut(src, F.col("t"), empty).count() == 2


def test_trigger_has_tasks_by_its_files_not_by_the_session(spark):
    """A trigger of few files keeps state and writes buckets in few partitions, whatever the session's setting."""
    pages = [("r0", p, json.dumps({"data": [{"id": f"a{p}-{i}"} for i in range(20)],
                                   "pagination": {"has_next_page": True, "cursor": "c"}})) for p in range(4)]
    root, ck = scratch_path(spark, "land"), scratch_path(spark, "ck")
    write_landed(spark.createDataFrame(pages, "run_id string, page_no long, body string"), root)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        table = KeyedTable(spark, scratch_path(spark, "acc"), "accounts", landing=True)
        q = stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=2)
        q.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]][:1] == [1]
    assert [v.buckets for v in table.versions()] == [1, 1]
    assert table.read().count() == 80


def test_many_tasks_land_pages_and_a_trigger_without_an_ended_run_commits_no_cuts(spark):
    """A page is a file, which takes its time however small it is."""
    pages = [("r0", p, json.dumps({"data": [{"id": f"a{p}"}], "pagination": {"has_next_page": True, "cursor": "c"}})) for p in range(40)]
    root, ck = scratch_path(spark, "land"), scratch_path(spark, "ck")
    write_landed(spark.createDataFrame(pages, "run_id string, page_no long, body string").coalesce(1), root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_extract("path", "part-([0-9]+)", 1).alias("task"))
    assert files.count() == 40 and files.distinct().count() == spark.sparkContext.defaultParallelism
    table = KeyedTable(spark, scratch_path(spark, "acc"), "accounts", landing=True)
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(listing)
    q = stream_upsert(spark, root, "accounts", table, ck, max_files_per_trigger=40)
    q.awaitTermination()
    assert spark.conf.get(listing) == before
    assert [v.cuts for v in table.versions()] == [None]
    assert table.read().count() == 40
