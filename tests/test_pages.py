import json
import random

from pyspark.sql import functions as F

from ticketlake.sources.objects import split_rejects, to_rows
from ticketlake.sources.pages import (bad_pages, cursor_chain, explode_items, offset_chain, offset_gaps, parse_pages,
                                      read_landed, write_landed)


def body(data, has_next=True, cursor="c", offset=None):
    pag = {"has_next_page": has_next}
    if cursor is not None:
        pag["cursor"] = cursor
    if offset is not None:
        pag["offset"] = offset
    d = {"pagination": pag}
    if data is not ...:
        d["data"] = data
    return json.dumps(d)


def pages_df(spark, rows):
    return spark.createDataFrame(rows, "run_id string, page_no long, body string")


def ids(df):
    return sorted((r["run_id"], r["page_no"], r["pos"]) for r in explode_items(df).collect())


def cursor_loop(pages):
    """The reference loop: stop after a page with no data, no next page or no cursor."""
    out = []
    for p, (data, has_next, cursor) in enumerate(pages):
        if not data:
            break
        out += [(p, i) for i in range(len(data))]
        if not has_next or not cursor:
            break
    return out


def test_cursor_chain_edges(spark):
    rows = [("a", 0, body([{"id": 1}, {"id": 2}])), ("a", 1, body([{"id": 3}], has_next=True, cursor=None)),
            ("a", 2, body([{"id": 4}])),                                  # after terminal page: ignored
            ("b", 0, body([])), ("b", 1, body([{"id": 5}])),              # empty first page: nothing
            ("c", 0, body(None)), ("d", 0, body(..., has_next=False))]    # null / missing data
    got = ids(cursor_chain(parse_pages(pages_df(spark, rows))))
    assert got == [("a", 0, 0), ("a", 0, 1), ("a", 1, 0)]


def test_cursor_chain_matches_loop(spark):
    rnd = random.Random(7)
    rows, expected = [], []
    for run in range(60):
        pages = []
        for p in range(rnd.randint(1, 6)):
            data = [{"id": f"{run}-{p}-{i}"} for i in range(rnd.choice([0, 1, 2, 3]))]
            pages.append((data, rnd.random() > 0.2, rnd.choice(["c", "c", "c", None, ""])))
        for p, (data, hn, cur) in enumerate(pages):
            rows.append((str(run), p, body(data, hn, cur)))
        expected += [(str(run), p, i) for p, i in cursor_loop(pages)]
    got = ids(cursor_chain(parse_pages(pages_df(spark, rows))))
    assert got == sorted(expected)


def test_offset_chain_and_gaps(spark):
    rows = [("a", 0, body([{"id": 1}, {"id": 2}], offset=0)), ("a", 1, body([{"id": 3}], offset=3)),
            ("a", 2, body([{"id": 4}], has_next=False, offset=4)), ("a", 3, body([{"id": 5}], offset=5))]
    p = parse_pages(pages_df(spark, rows))
    assert ids(offset_chain(p)) == [("a", 0, 0), ("a", 0, 1), ("a", 1, 0), ("a", 2, 0)]
    gaps = sorted((r["page_no"], r["offset"], r["expected_offset"]) for r in offset_gaps(p).collect())
    assert gaps == [(1, 3, 2)]


def test_to_rows_keys_and_rejects(spark):
    items = spark.createDataFrame(
        [('{"id": "a1"}',), ('{"id": ""}',), ('{"name": "x"}',), ('{"id": null}',), ('{"id": 0}',),
         ('{"id": false}',), ('{"id": 5}',)], "j string").select(F.parse_json("j").alias("item"))
    rows = to_rows(items, "accounts")
    valid, rej = split_rejects(rows)
    assert sorted(r["account_id"] for r in valid.collect()) == ["5", "a1"]
    assert rej.count() == 5


def test_to_rows_messages_and_contacts(spark):
    items = spark.createDataFrame([("i1", '{"id": "m1"}'), (None, '{"id": "m2"}'), ("", '{"id": "m3"}')],
                                  "issue_id string, j string").select("issue_id", F.parse_json("j").alias("item"))
    rows = to_rows(items, "messages")
    got = {r["message_id"]: (r["issue_id"], r["reject_reason"]) for r in rows.collect()}
    assert got == {"m1": ("i1", None), "m2": (None, "missing_issue_id"), "m3": ("", "missing_issue_id")}
    c = spark.createDataFrame([('{"id": "c1", "account_id": "a"}',), ('{"id": "c2"}',)], "j string") \
             .select(F.parse_json("j").alias("item"))
    got = sorted((r["contact_id"], r["account_id"]) for r in to_rows(c, "contacts").collect())
    assert got == [("c1", "a"), ("c2", None)]


def test_strict_mode_raises(spark):
    items = spark.createDataFrame([('{"name": "x"}',)], "j string").select(F.parse_json("j").alias("item"))
    try:
        to_rows(items, "users", strict=True).collect()
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "missing_id" in str(e)


def test_landing_round_trip(spark, tmp_path):
    rows = [("r1", 0, body([{"id": 1}])), ("r1", 1, body([{"id": 2}], has_next=False))]
    write_landed(pages_df(spark, rows), str(tmp_path / "land"))
    back = read_landed(spark, str(tmp_path / "land"))
    assert sorted((r["run_id"], r["page_no"]) for r in back.collect()) == [("r1", 0), ("r1", 1)]
    assert len(ids(cursor_chain(parse_pages(back)))) == 2


def test_response_pages_by_message_number(spark):
    from ticketlake.sources.fixtures import response_pages
    rows = [("hot", k % 2500, k, f'"{k}"') for k in range(3000)] + [("cold", k, k, f'"c{k}"') for k in range(3)]
    df = spark.createDataFrame(rows, "issue_id string, number long, seen long, record string")
    pages = {(p.issue_id, p.page_no): json.loads(p.data) for p in response_pages(df, "issue_id", "seen", F.col("number")).collect()}
    assert set(pages) == {("hot", 0), ("hot", 1), ("hot", 2), ("cold", 0)} and pages["cold", 0] == ["c0", "c1", "c2"]
    assert sorted(int(x) for p in range(3) for x in pages["hot", p]) == list(range(3000))      # every record once
    assert all([int(x) for x in pages["hot", p]] == sorted(int(x) for x in pages["hot", p]) for p in range(3))


def test_records_are_dealt_to_pages_before_they_are_collected(spark):
    from ticketlake.sources.fixtures import response_pages
    df = spark.createDataFrame([("a", 1, "{}"), ("a", 2, "{}")], "issue_id string, number long, record string")
    plan = response_pages(df, "issue_id", "number", F.col("number"))._jdf.queryExecution().executedPlan().toString()
    # printed from the top: the only exchange lies below the first collecting step, which would spill on the map side
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.rindex("Exchange hashpartitioning") > plan.rindex("partial_collect_list")


def test_bad_pages_do_not_end_a_run(spark):
    rows = [("a", 0, body([{"id": 1}])), ("a", 1, "not json"), ("a", 2, '{"data":[{"id":2}'), ("a", 3, body([{"id": 3, "x": 1}])),
            ("a", 4, '{"data":[{"id":4,"id":5}],"pagination":{"has_next_page":true,"cursor":"c"}}'), ("a", 5, ""), ("a", 6, body([{"id": 6}])),
            ("b", 0, '{"data":{"id":1}}'), ("b", 1, None), ("b", 2, body([{"id": 7}]))]
    df = pages_df(spark, rows)
    assert ids(cursor_chain(parse_pages(df))) == [("a", p, 0) for p in (0, 3, 4, 6)]     # b stops at its empty page 1
    assert sorted((r.run_id, r.page_no) for r in bad_pages(parse_pages(df)).collect()) == [("a", 1), ("a", 2), ("a", 5), ("b", 0)]


def test_one_parse_and_no_exchange_of_payloads_on_the_run(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cursor_chain(parse_pages(pages_df(spark, [("a", 0, body([{"id": 1}]))])))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("from_json") == 3                      # payload, and the narrow flags on both sides of the stop join
    for line in plan.splitlines():
        if "Exchange hashpartitioning(run_id" in line and "page_no" not in line.split(")")[0]:
            assert "data" not in line


def test_items_before_two_level_prefix(spark):
    from ticketlake.sources.fixtures import items_before
    import random as _r
    rnd = _r.Random(3)
    rows = [(f"r{r}", p, rnd.randint(0, 5)) for r in range(3) for p in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "run_id string, page_no long, n_items int")
    got = {(x.run_id, x.page_no): x.items_before for x in items_before(df, block=4).collect()}
    exp, acc = {}, {}
    for r, p, n in sorted(rows):
        exp[(r, p)] = acc.get(r, 0)
        acc[r] = acc.get(r, 0) + n
    assert got == exp
