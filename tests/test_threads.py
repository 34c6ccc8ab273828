from pyspark.sql import functions as F

from ticketlake.operators.threads import CLOSING_WINDOW, conversations, staff_directory


def thread_rows(spark, n, issue="i", author="c@x", body="<p>b</p>"):
    return spark.createDataFrame([(issue, f"m{k:03d}", author, f"2024-01-01T00:{k // 60:02d}:{k % 60:02d}Z", body)
                                  for k in range(n)],
                                 "issue_id string, message_id string, author string, ts string, body string")


def lines(df):
    r = df.first()
    return r["conversation"].split("\n"), r["n_lines"]


def test_window_sizes(spark):
    for n, keep in [(1, 1), (9, 9), (10, 9), (20, 9), (21, 9)]:
        ls, k = lines(conversations(thread_rows(spark, n)))
        assert k == keep and len(ls) == keep
        if n > 9:
            ids = [int(x.split(":")[2][:2]) for x in ls]    # seconds field = message number
            assert ids == [0, 1, 2] + list(range(n - 6, n))
    for n, keep in [(20, 20), (21, 20)]:
        _, k = lines(conversations(thread_rows(spark, n), None, CLOSING_WINDOW))
        assert k == keep


def test_null_author_body(spark):
    df = spark.createDataFrame([("i", "m1", None, None, None)],
                               "issue_id string, message_id string, author string, ts string, body string")
    ls, _ = lines(conversations(df))
    assert ls == ["[None] None: "]


def _teams(spark):
    t = [('{"name": "Alpha", "users": [{"id": "u1", "email": "s@x"}, {"id": "u2", "email": null}]}',),
         ('{"name": "Beta", "users": [{"id": "u1", "email": "s@x"}]}',),
         ('{"name": "Empty", "users": []}',), ('{"name": "NoUsers"}',)]
    return spark.createDataFrame(t, "j string").select(F.parse_json("j").alias("data"))


def test_directory_and_team_labels(spark):
    d = staff_directory(_teams(spark))
    assert sorted(((r.email or ""), r.user_id, r.team_name) for r in d.collect()) == \
        sorted([("s@x", "u1", "Alpha"), ("", "u2", "Alpha"), ("s@x", "u1", "Beta")])
    rows = spark.createDataFrame([("i", "m1", "s@x", "t1", "hi"), ("i", "m2", "c@y", "t2", "yo")],
                                 "issue_id string, message_id string, author string, ts string, body string")
    ls, _ = lines(conversations(rows, d))
    assert ls == ["[t1] s@x(Alpha): hi", "[t2] c@y: yo"]
    ls, k = lines(conversations(rows, d, fan_out=True))        # parity: one line per team
    assert ls == ["[t1] s@x(Alpha): hi", "[t1] s@x(Beta): hi", "[t2] c@y: yo"] and k == 3


def test_hot_issue_is_group_limited(spark):
    hot = thread_rows(spark, 3000, issue="hot")
    df = hot.unionByName(thread_rows(spark, 4, issue="cold")).repartition(8)
    got = {r.issue_id: r.n_lines for r in conversations(df).collect()}
    assert got == {"hot": 9, "cold": 4}
    plan = conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _brute_truncate(rows, head, tail):
    """Reference rule per thread: all rows when n <= head+tail, else the first
    head and last tail by (ts, message_id), NULLs first."""
    out = []
    for issue in sorted({r[0] for r in rows}):
        t = sorted([r for r in rows if r[0] == issue],
                   key=lambda r: ((r[2] is not None, r[2] or ""), (r[1] is not None, r[1] or "")))
        out += t if len(t) <= head + tail else t[:head] + t[-tail:]
    return sorted(out, key=str)


def test_truncate_matches_brute_force(spark):
    import random
    from ticketlake.operators.threads import truncate_thread
    rnd = random.Random(7)
    rows = []
    for i in range(12):
        n = rnd.choice([0, 1, 3, 8, 9, 10, 19, 20, 21, 40])
        for k in range(n):
            ts = None if rnd.random() < 0.1 else f"2024-01-01T00:00:{rnd.randint(0, 9):02d}Z"   # ties and NULLs
            rows.append((f"i{i}", f"m{k:02d}", ts))
    df = spark.createDataFrame(rows, "issue_id string, message_id string, ts string").repartition(5)
    for head, tail in [(3, 6), (5, 15), (1, 1)]:
        got = sorted({tuple(r) for r in truncate_thread(df, head, tail).select("issue_id", "message_id", "ts").collect()},
                     key=str)
        assert got == _brute_truncate(rows, head, tail), (head, tail)
