import datetime as dt
import json

from pyspark.sql import functions as F

from ticketlake.operators import closing, triage
from ticketlake.operators.scorer import keyword_hits, keyword_table, score_with


def _snapshot(spark, rows):
    return spark.createDataFrame(rows, "issue_id string, j string").select("issue_id", F.parse_json("j").alias("data"))


def test_classification_truth_table(spark):
    reqs = spark.createDataFrame(
        [("a", ""), ("b", "conv"), ("c", "conv"), ("d", "conv"), ("e", "conv"), ("f", "conv"), ("g", "conv")],
        "issue_id string, conversation string")
    resp = spark.createDataFrame(
        [("a", '{"resolution": "no_action", "confidence": 0.9}'), ("b", None), ("c", "{bad"),
         ("d", '{"resolution": "no_action", "confidence": 0.5}'),
         ("e", '{"resolution": "bug_fix", "confidence": 0.95}'),
         ("f", '{"resolution": "no_action", "confidence": "high"}'),
         ("g", '{"category": "x"}')], "issue_id string, response string")
    snap = _snapshot(spark, [("e", '{"tags": ["t"]}'), ("g", '{"tags": null}')])
    dec = triage.decisions(reqs, resp, snap)
    got = {r.issue_id: (r.outcome, r.payload) for r in dec.collect()}
    assert got["a"][0] == "no_conversation" and got["b"][0] == "skipped" and got["c"][0] == "skipped"
    assert got["d"][0] == "skipped" and got["f"][0] == "exception"
    assert got["e"][0] == "updated" and json.loads(got["e"][1]) == {
        "custom_fields": [{"slug": "resolution", "value": "big_fix"}], "tags": ["t", "auto-classified"]}
    assert got["g"] == ("updated", None)                          # nothing to write still succeeds
    c = triage.counters(dec).first()
    assert (c.total_processed, c.total_classified, c.total_updated, c.total_errors, c.success) == (7, 2, 2, 2, False)


def _stored_classify(spark, log_path=None):
    """A classify run over stored records: 2 and 3 have messages, 2 comes twice, 4 is labelled."""
    from ticketlake.plans.classify import classify
    from ticketlake.session import scratch_path
    iss = [(i, json.dumps({"id": i, "state": "closed", "created_at": "2024-01-02T00:00:00Z", "tags": ["t"], "custom_fields": f}))
           for i, f in (("1", {}), ("2", {}), ("2", {}), ("3", {}), ("4", {"resolution": {"value": "x"}, "category": {"value": "y"}}))]
    said = [(i, json.dumps({"id": "m", "timestamp": "2024-01-01T00:00:00Z", "message_html": "hi", "author": {"user": {"email": "a@x"}}})) for i in "234"]
    teams = [("t", '{"name": "A", "users": [{"id": "u", "email": "a@x"}]}')]
    stored = []
    for rows, key in ((iss, "issue_id"), (said, "issue_id"), (teams, "team_id")):
        path = scratch_path(spark, "stored")
        spark.createDataFrame(rows, f"{key} string, j string").select(key, F.parse_json("j").alias("data")).write.parquet(path)
        stored.append(spark.read.parquet(path))
    answer = F.when(F.col("issue_id") == "2", '{"resolution": "no_action", "confidence": 0.9}')
    return classify(*stored, responder=lambda r: r.select("issue_id", answer.alias("response")).distinct(), log_path=log_path)


def test_no_issue_of_a_classify_run_is_broadcast(spark):
    """Targets, responses and tags meet by shuffles: sizes estimated beside records are no reason to send them through the driver."""
    import re

    from ticketlake.plans import release
    run = _stored_classify(spark)
    plan = run["decisions"]._jdf.queryExecution().withCachedData().toString()
    assert not re.search(r"BroadcastHashJoin \[issue_id", plan), plan
    assert sorted((r.issue_id, r.outcome) for r in run["decisions"].collect()) == [("1", "no_conversation")] + [("2", "updated")] * 4 + [("3", "skipped")]
    release(run)


def test_the_outbox_of_a_classify_run_has_no_broadcast_of_issues(spark):
    import re

    from ticketlake.plans import release
    run = _stored_classify(spark)
    assert not re.search(r"BroadcastHashJoin \[issue_id", run["outbox"]._jdf.queryExecution().withCachedData().toString())
    assert [(r.issue_id, json.loads(r.payload)["tags"]) for r in run["outbox"].collect()] == [("2", ["t", "auto-classified"])] * 4
    release(run)


def test_the_log_of_a_classify_run_is_computed_without_a_broadcast_of_issues(spark):
    import re

    from ticketlake.plans import release
    from ticketlake.session import scratch_path
    log = scratch_path(spark, "log")
    run = _stored_classify(spark, log)
    assert not re.search(r"BroadcastHashJoin \[issue_id", run["counters"]._jdf.queryExecution().withCachedData().toString())
    assert [(r.command, r.total_processed, r.total_classified, r.total_errors) for r in spark.read.parquet(log).collect()] == [("classify", 6, 4, 1)]
    release(run)


def test_unclassified_selection(spark):
    iss = _snapshot(spark, [
        ("1", '{"id": "1", "state": "closed", "created_at": "2024-01-02T00:00:00Z", "custom_fields": {}}'),
        ("2", '{"id": "2", "state": "closed", "created_at": "2024-01-03T00:00:00Z", '
              '"custom_fields": {"resolution": {"value": "x"}, "category": {"value": ""}}}'),
        ("3", '{"id": "3", "state": "new", "created_at": "2024-01-04T00:00:00Z", "custom_fields": {}}')])
    assert [r.issue_id for r in triage.unclassified(iss).collect()] == ["1"]     # '' is not NULL (Q13)
    assert triage.unclassified(iss, fields=[]).count() == 0
    assert triage.unclassified(iss, created_start="2024-01-03T00:00:00Z").count() == 0


def test_stale_candidates_and_missing(spark):
    iss = _snapshot(spark, [
        ("1", '{"state": "waiting_on_customer", "source": "slack"}'),
        ("2", '{"state": "waiting_on_customer", "source": "email"}'),
        ("3", '{"state": "waiting_on_customer", "source": "slack"}'),
        ("4", '{"state": "waiting_on_customer", "source": "slack"}')])
    msgs = spark.createDataFrame([("1", '{"timestamp": "2024-01-01T00:00:00Z"}'),
                                  ("1", '{"timestamp": "2024-01-02T00:00:00Z"}'),
                                  ("2", '{"timestamp": "2024-01-01T00:00:00Z"}'),
                                  ("3", '{"timestamp": "2024-01-08T00:00:00Z"}')], "issue_id string, j string") \
             .select("issue_id", F.parse_json("j").alias("data"))
    got = [r.issue_id for r in closing.stale_candidates(iss, msgs, dt.datetime(2024, 1, 15)).collect()]
    assert got == ["1"]       # 3 is exactly one week old (not strictly older); 4 has no messages
    d = _snapshot(spark, [("x", '{"custom_fields": {"resolution": {"value": ""}, "category": {"value": "c"}}}')])
    assert d.select(closing.missing_fields(F.col("data")).alias("m")).first().m == ["resolution"]


def test_closing_truth_table(spark):
    cand = spark.createDataFrame([(k,) for k in "abcdefg"], "issue_id string")
    full = '"custom_fields": {"resolution": {"value": "r"}, "category": {"value": "c"}}'
    snap = _snapshot(spark, [("a", '{"state": "closed"}'), ("b", '{"state": "waiting_on_customer"}'),
                             ("c", f'{{"state": "w", {full}}}'), ("d", f'{{"state": "w", {full}}}'),
                             ("e", f'{{"state": "w", {full}}}'), ("f", f'{{"state": "w", {full}, "tags": ["z"]}}'),
                             ("g", f'{{"state": "w", {full}}}')])
    convs = spark.createDataFrame([(k, "conv") for k in "bdefg"], "issue_id string, conversation string")
    q = spark.createDataFrame([("d", None), ("e", '{"questions": [], "all_resolved": "true"}'),
                               ("f", '{"questions": [{"id": 1, "question": "q", "resolved": true}], "all_resolved": true}'),
                               ("g", '{"all_resolved": false}')], "issue_id string, response string")
    dec = closing.closing_decisions(cand, snap, convs, q)
    got = {r.issue_id: r.outcome for r in dec.collect()}
    assert got == {"a": "already_closed", "b": "still_unclassified", "c": "no_conversation", "d": "analysis_failed",
                   "e": "not_resolved", "f": "closed", "g": "not_resolved"}
    f = dec.where("issue_id = 'f'").first()
    assert json.loads(f.payload) == {"state": "closed", "tags": ["z", "auto-closed"]} and f.n_questions == 1
    c = closing.close_counters(dec).first()
    assert (c.total_processed, c.total_analyzed, c.total_closed, c.total_errors) == (7, 3, 1, 3)


def test_keyword_scorer_and_pandas_scorer(spark):
    docs = spark.createDataFrame([(1, "Billing: refunds and BILLING."), (2, "nothing here")], "doc_id long, text string")
    hits = {(r.id, r.label): r.hits for r in keyword_hits(docs, "doc_id", "text", keyword_table(spark)).collect()}
    assert hits[(1, "admin_billing_refunds")] == 3
    reqs = spark.createDataFrame([("a", "s", "u"), ("b", "s", "u")], "issue_id string, system string, user string")
    ok = score_with(reqs, lambda b: b["issue_id"] + "!")
    assert sorted((r.issue_id, r.response) for r in ok.collect()) == [("a", "a!"), ("b", "b!")]

    def boom(b):
        raise RuntimeError("scorer down")
    assert [(r.response, r.error) for r in score_with(reqs, boom).collect()] == [(None, "RuntimeError: scorer down")] * 2

    def one_fails(b):
        if (b["issue_id"] == "b").any():
            raise ValueError("bad request")
        return b["issue_id"] + "!"
    many = spark.createDataFrame([(c, "s", "u") for c in "abcde"], reqs.schema).coalesce(1)
    got = {r.issue_id: (r.response, r.error) for r in score_with(many, one_fails).collect()}
    assert got == {**{c: (c + "!", None) for c in "acde"}, "b": (None, "ValueError: bad request")}


def test_release_unpersists_command_intermediates(spark, sf):
    from ticketlake import queries as q
    from ticketlake.plans import release
    run = q._close_run(spark, sf)
    run["counters"].collect()
    assert run["persisted"] and all(df.is_cached for df in run["persisted"])
    release(run)
    assert not any(df.is_cached for df in run["persisted"])


def test_snapshot_is_asked_for_the_candidates_alone(spark, sf):
    """JN7: the snapshot of the ids asked for, whatever else the service holds."""
    from ticketlake import queries
    asked = spark.createDataFrame([("1",), ("7",), ("nobody",)], "issue_id string")
    rows = queries._current_snapshot(spark, sf, asked).collect()
    assert sorted(r.issue_id for r in rows) == ["1", "7"]
