"""E1-E3 with the write, A8/A9 counters and the run log."""

import json

from pyspark.sql import functions as F

from ticketlake.operators.merge import KeyedTable
from ticketlake.operators.runlog import append_run_log
from ticketlake.plans.replicate import items_from_pages, replicate_all, replicate_object, replicate_rows
from ticketlake.session import scratch_path


def _pages(spark, recs_per_page, run="r0"):
    rows = []
    for p, recs in enumerate(recs_per_page):
        last = p == len(recs_per_page) - 1
        rows.append((run, p, json.dumps({"data": recs, "pagination": {"has_next_page": not last,
                                                                       "cursor": None if last else f"c{p + 1}"}})))
    return spark.createDataFrame(rows, "run_id string, page_no long, body string")


def _counters(df):
    return {r["object_type"]: (r["total_processed"], r["total_errors"], r["total_batches"], r["rows_kept"])
            for r in df.collect()}


def test_replicate_object_matches_one_shot(spark):
    # a0 repeats across pages (the later page wins), one record has a falsy id
    pages = _pages(spark, [[{"id": "a0", "v": 0}, {"id": "a1", "v": 0}],
                           [{"id": "a0", "v": 1}, {"id": "", "v": 1}, {"id": "a2", "v": 1}],
                           [{"id": "a3", "v": 2}]])
    table = KeyedTable(spark, scratch_path(spark, "acc"), "accounts")
    got = replicate_object(spark, pages, "accounts", table).first()
    kept, counters = replicate_rows(items_from_pages(pages, "accounts"), "accounts")
    c = counters.first()
    assert (got["total_processed"], got["total_errors"], got["total_batches"], got["rows_kept"]) == \
           (c["total_processed"], c["total_errors"], c["total_batches"], c["rows_kept"]) == (5, 1, 3, 4)
    written = {r.account_id: r.v for r in table.read().select(
        "account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
    assert written == {r.account_id: r.v for r in kept.select(
        "account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
    assert written["a0"] == 1


def test_replicate_all_isolates_failures_and_rolls_up(spark):
    acc = _pages(spark, [[{"id": "a0"}, {"id": "a1"}]])
    users = _pages(spark, [[{"id": "u0"}], [{"id": "u1"}]])
    bad = spark.createDataFrame([("r0", 0, "not json")], "run_id string, page_no long, body string")
    tables = {t: KeyedTable(spark, scratch_path(spark, t), t) for t in ("accounts", "users", "teams")}
    # teams fails: its table path holds a NUL character, so the write cannot succeed
    tables["teams"].path = scratch_path(spark, "teams") + "/\0bad"
    res = _counters(replicate_all(spark, {"accounts": acc, "users": users, "teams": bad}, tables))
    assert res["accounts"] == (2, 0, 1, 2)
    assert res["users"] == (2, 0, 2, 2)
    assert res["teams"][1] == 1
    assert res["all"][0] == 4 and res["all"][1] == 1


def test_run_log_appends(spark):
    path = scratch_path(spark, "runlog")
    c = spark.createDataFrame([("accounts", "accounts", 2, 0, 1, 2)],
                              "object_type string, table_name string, total_processed bigint, "
                              "total_errors bigint, total_batches bigint, rows_kept bigint")
    append_run_log(c, path, "replicate accounts")
    append_run_log(c, path, "replicate accounts")
    log = spark.read.parquet(path)
    assert log.count() == 2
    assert {"command", "run_at", "total_processed"} <= set(log.columns)


def test_unknown_object_type_is_an_error(spark):
    import pytest
    pages = _pages(spark, [[{"id": "x"}]])
    with pytest.raises(ValueError, match="Unknown object type"):
        replicate_object(spark, pages, "widgets", None)
    with pytest.raises(ValueError, match="Unknown object type"):
        replicate_rows(items_from_pages(pages, "widgets"), "widgets")


def test_messages_replicate_with_parent_from_landing(spark):
    # The parent id comes from the landing partition, not the record
    rows = [("r0", "i1", 0, json.dumps({"data": [{"id": "m1"}, {"id": "m2"}, {"id": "m1"}]})),
            ("r0", "i2", 0, json.dumps({"data": None}))]
    pages = spark.createDataFrame(rows, "run_id string, issue_id string, page_no long, body string")
    kept, counters = replicate_rows(items_from_pages(pages, "messages"), "messages")
    assert sorted((r.issue_id, r.message_id) for r in kept.collect()) == [("i1", "m1"), ("i1", "m2")]
    c = counters.first()
    assert (c.total_processed, c.total_errors, c.total_batches, c.rows_kept) == (3, 0, 1, 2)


def test_bad_page_loses_nothing_else_and_later_run_wins(spark):
    pages = _pages(spark, [[{"id": f"p{p}"}, {"id": "all", "v": p}] for p in range(6)]).where("page_no <> 2").union(
        spark.createDataFrame([("r0", 2, '{"data":[{"id":"lost"},')], "run_id string, page_no long, body string")).union(
        _pages(spark, [[{"id": "p1", "v": 7, "v": 8}, {"id": ""}]], run="r1"))
    paths = {k: scratch_path(spark, k) for k in ("rejects", "bad")}
    batch = KeyedTable(spark, scratch_path(spark, "acc"), "accounts")
    stream = KeyedTable(spark, scratch_path(spark, "acc-landed"), "accounts", landing=True)
    for table in (batch, stream):
        got = replicate_object(spark, pages, "accounts", table, rejects_path=paths["rejects"], bad_pages_path=paths["bad"]).first()
        assert (got.total_processed, got.total_errors) == (11, 2)
        v = {r.account_id: r.v for r in table.read().select("account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
        assert v == {"p0": None, "p1": 8, "p3": None, "p4": None, "p5": None, "all": 5}
    assert [(r.run_id, r.page_no, r.object_type) for r in spark.read.parquet(paths["bad"]).collect()] == [("r0", 2, "accounts")] * 2
    assert [(r.run_id, r.reject_reason) for r in spark.read.parquet(paths["rejects"]).collect()] == [("r1", "missing_id")] * 2


def test_filters_and_selection(spark):
    issues = _pages(spark, [[{"id": f"i{k}", "state": s, "modified_at": f"2024-01-0{k}T00:00:00Z"} for k, s in
                             ((1, "new"), (2, "closed"), (3, "closed"))]])
    import datetime as dt
    t = KeyedTable(spark, scratch_path(spark, "iss"), "issues")
    replicate_object(spark, issues, "issues", t, issue_filter={"states": ["closed"], "modified_start": dt.datetime(2024, 1, 2)})
    assert [r.issue_id for r in t.read().collect()] == ["i3"]
    rows = [("r0", i, 0, json.dumps({"data": [{"id": "m1"}, {"id": "m2"}]})) for i in ("i1", "i2")]
    pages = spark.createDataFrame(rows, "run_id string, issue_id string, page_no long, body string")
    t = KeyedTable(spark, scratch_path(spark, "msg"), "messages")
    replicate_object(spark, pages, "messages", t, issue_ids=spark.createDataFrame([("i2",)], "issue_id string"))
    assert sorted((r.issue_id, r.message_id) for r in t.read().collect()) == [("i2", "m1"), ("i2", "m2")]
    contacts = _pages(spark, [[{"id": "c1", "account_id": "a"}, {"id": "c2", "account_id": "b"}]])
    t = KeyedTable(spark, scratch_path(spark, "con"), "contacts")
    replicate_object(spark, contacts, "contacts", t, account_id="b")
    assert [r.contact_id for r in t.read().collect()] == ["c2"]


def test_replicate_all_logs_failures(spark):
    log = scratch_path(spark, "log")
    tables = {t: KeyedTable(spark, scratch_path(spark, t), t) for t in ("accounts", "users")}
    tables["users"].path += "/\0bad"
    pages = _pages(spark, [[{"id": "x"}]])
    replicate_all(spark, {"accounts": pages, "users": pages}, tables, log_path=log)
    got = {r.object_type: r for r in spark.read.parquet(log).collect()}
    assert got["accounts"].error is None and got["users"].error and got["users"].total_errors == 1


def test_sinks_exist_when_nothing_is_rejected(spark):
    paths = {k: scratch_path(spark, k) for k in ("rejects", "bad")}
    t = KeyedTable(spark, scratch_path(spark, "clean"), "accounts")
    replicate_object(spark, _pages(spark, [[{"id": "x"}]]), "accounts", t, rejects_path=paths["rejects"], bad_pages_path=paths["bad"])
    assert all(spark.read.parquet(p).count() == 0 for p in paths.values())


def test_a_page_is_parsed_once(spark):
    from ticketlake.sources.pages import parse_pages
    pages = _pages(spark, [[{"id": "x"}], [{"id": "y"}]])
    parsed = parse_pages(pages).persist()
    from ticketlake.plans.replicate import chained, items_of
    plan = items_of(chained(parsed, "accounts"), "accounts")._jdf.queryExecution().executedPlan().toString()
    outside = [line for line in plan.split("\n") if "from_json" in line]
    assert "InMemoryTableScan" in plan and len(outside) <= plan.count("InMemoryRelation") * 2
    parsed.unpersist()


def test_rows_come_from_splits_of_a_scratch_table(spark):
    from ticketlake.operators.commits import Files
    from ticketlake.session import checkpoint_dir

    class Seen(KeyedTable):
        def upsert(self, rows, **kw):
            self.plan = rows._jdf.queryExecution().executedPlan().toString()
            return super().upsert(rows, **kw)

    table = Seen(spark, scratch_path(spark, "seen"), "accounts")
    bad = spark.createDataFrame([("r0", 5, "not json")], "run_id string, page_no long, body string")
    pages = _pages(spark, [[{"id": "x"}, {"id": ""}], [{"id": "y"}], [{"id": "x"}]]).unionByName(bad).withColumn("more", F.lit(None))
    got = _counters(replicate_object(spark, pages, "accounts", table))
    assert got["accounts"] == (3, 2, 3, 2)
    assert "InMemoryTableScan" not in table.plan and "from_json" not in table.plan
    assert not [n for n in Files(spark).names(f"{checkpoint_dir(spark)}/ticketlake") if n.startswith("parsed-")]


def test_objects_at_once_equal_one_by_one(spark):
    def run(at_once):
        tables = {t: KeyedTable(spark, scratch_path(spark, t), t) for t in ("accounts", "issues", "messages", "users")}
        tables["users"].path += "/\0bad"
        pages = {t: _pages(spark, [[{"id": f"{t}{p}{i}"} for i in range(3)] for p in range(3)]) for t in ("accounts", "issues", "users")}
        pages["messages"] = spark.createDataFrame([("r0", "issues00", 0, json.dumps({"data": [{"id": "m"}]}))],
                                                  "run_id string, issue_id string, page_no long, body string")
        # the messages command reads what the issues command wrote
        ids = tables["issues"].create().read().select("issue_id") if at_once == 1 else None
        res = replicate_all(spark, pages, tables, at_once=at_once)
        return {r.object_type: (r.total_processed, r.total_errors, r.rows_kept, r.error is None) for r in res.collect()}, ids
    one, _ = run(1)
    many, _ = run(3)
    assert one == many and one["users"] == (0, 1, 0, False) and one["messages"] == (1, 0, 1, True)


def test_failing_chunk_leaves_the_others_and_is_done_alone(spark):
    import datetime as dt
    from ticketlake.plans.replicate import replicate_chunked
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1)
    days = {f"i{k}": start + dt.timedelta(days=k) for k in range(0, 92, 7)}
    days["edge"], days["last"], days["out"] = start + dt.timedelta(days=30), end, end + dt.timedelta(seconds=1)
    recs = [{"id": k, "modified_at": t.strftime("%Y-%m-%dT%H:%M:%SZ")} for k, t in days.items()]
    table, log = KeyedTable(spark, scratch_path(spark, "chunked"), "issues"), scratch_path(spark, "chunks")
    asked, broken = [], {2}

    def fetch(n):
        asked.append(n)
        if n in broken:
            raise ConnectionError("no answer")
        return _pages(spark, [recs])

    first = {r.chunk_no: r.status for r in replicate_chunked(spark, fetch, table, start, end, log, "job").collect()}
    assert first == {0: "done", 1: "done", 2: "failed", 3: "done"} and asked == [0, 1, 2, 3]
    assert "i63" not in {r.issue_id for r in table.read().collect()}
    broken.clear()
    again = [(r.chunk_no, r.status, r.error) for r in replicate_chunked(spark, fetch, table, start, end, log, "job").collect()]
    assert asked == [0, 1, 2, 3, 2] and (2, "done", None) in again and (2, "failed", "no answer") in again
    assert {r.issue_id for r in table.read().collect()} == set(days) - {"out"}
    replicate_chunked(spark, fetch, table, start, end, log, "other job").collect()
    assert asked[5:] == [0, 1, 2, 3]


def test_flushes_against_a_loop(spark):
    """The reference loop: records in order into batches of n, each merged (first of a batch wins, later batch wins)."""
    import random
    r = random.Random(2)
    pages = [[{"id": f"a{r.randrange(12)}" if r.random() > 0.1 else "", "v": 10 * p + i} for i in range(r.randrange(1, 6))] for p in range(9)]
    for size in (1, 3, 4, 100):
        t = KeyedTable(spark, scratch_path(spark, "flush"), "accounts")
        got = replicate_object(spark, _pages(spark, pages), "accounts", t, flush=size).first()
        good = [x for page in pages for x in page if x["id"]]
        want = {}
        for i in range(0, len(good), size):
            batch = {}
            for x in good[i:i + size]:
                batch.setdefault(x["id"], x["v"])
            want.update(batch)
        assert {x.account_id: x.v for x in t.read().select("account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()} == want
        assert (got.total_processed, got.total_batches) == (len(good), -(-len(good) // size))


def test_flush_sizes():
    from ticketlake.plans.replicate import flush_size
    assert [flush_size(), flush_size(40), flush_size(9999), flush_size(save_each_page=True), flush_size(5, True)] == [500, 40, 500, 100, 100]


def test_failed_commands_are_logged(spark):
    import pytest
    from ticketlake.plans.truncate import truncate
    log = scratch_path(spark, "log")
    with pytest.raises(FileNotFoundError):
        truncate(KeyedTable(spark, scratch_path(spark, "none"), "users"), log_path=log)
    row = spark.read.parquet(log).first()
    assert row.command == "truncate" and row.success is False and "table not found" in row.error
