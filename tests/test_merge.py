import pytest
from pyspark.sql import functions as F

from ticketlake.operators.dedup import dedup_batches, dedup_counts, dedup_first, dedup_latest
from ticketlake.operators.merge import KeyedTable, merge
from ticketlake.session import scratch_path


def rows(spark, data):
    return spark.createDataFrame(data, "k1 string, k2 string, v string, ts string, batch_no int, page_no long, pos long") \
                .withColumn("updated_at", F.col("ts").cast("timestamp"))


def test_dedup_modes(spark):
    df = rows(spark, [("a", "x", "first", "2024-01-01", 1, 0, 0), ("a", "x", "later-seen-newer", "2024-01-02", 1, 0, 1),
                      ("a", None, "null part", "2024-01-01", 1, 0, 2), (None, "x", "null key", "2024-01-01", 1, 0, 3),
                      ("b", "y", "b1", "2024-01-01", 1, 1, 0), ("b", "y", "b2-same-ts", "2024-01-01", 1, 1, 1)])
    keys = ["k1", "k2"]
    first = {(r.k1, r.k2): r.v for r in dedup_first(df, keys).collect()}
    assert first == {("a", "x"): "first", ("b", "y"): "b1"}
    latest = {(r.k1, r.k2): r.v for r in dedup_latest(df, keys).collect()}
    assert latest == {("a", "x"): "later-seen-newer", ("b", "y"): "b1"}
    c = dedup_counts(df, keys).first()
    assert (c.original, c.null_keys, c.kept, c.removed) == (6, 2, 2, 2)


def test_dedup_batches_equals_sequential(spark):
    data = [(k, "m", f"v{b}{p}", "2024-01-01", b, 0, p) for b in (1, 2, 3) for k in "abcde" for p in (0, 1)
            if (ord(k) + b) % 2 == 0]
    df = rows(spark, data)
    one_shot = {r.k1: r.v for r in dedup_batches(df, ["k1", "k2"]).collect()}
    seq = {}
    for b in (1, 2, 3):
        batch = {}
        for k, _, v, _, bb, _, p in sorted(data, key=lambda x: x[6]):
            if bb == b and k not in batch:
                batch[k] = v
        seq.update(batch)
    assert one_shot == seq


def test_merge_semantics_and_idempotence(spark):
    t = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    s = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    m = merge(t, s, ["k"])
    assert sorted(m.collect()) == sorted(spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "k string, v int").collect())
    assert sorted(merge(m, s, ["k"]).collect()) == sorted(m.collect())


def _issue_rows(spark, data):
    return spark.createDataFrame(data, "issue_id string, j string, page_no long, pos long") \
                .select("issue_id", F.parse_json("j").alias("data"), F.current_timestamp().alias("updated_at"),
                        "page_no", "pos")


def test_keyed_table_upsert_truncate(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-issues") + "/issues", "issues")
    assert not t.exists()
    t.create()
    assert t.exists() and t.read().count() == 0
    t.create()   # existing table unchanged
    s1 = t.upsert(_issue_rows(spark, [("1", '{"v": 1}', 0, 0), ("2", '{"v": 1}', 0, 1), ("2", '{"v": 9}', 0, 2)]))
    assert s1 == {"rows_in": 3, "rows_kept": 2}
    t.upsert(_issue_rows(spark, [("2", '{"v": 2}', 0, 0), ("3", '{"v": 2}', 0, 1)]))
    got = {r.issue_id: r.v for r in t.read().select("issue_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
    assert got == {"1": 1, "2": 2, "3": 2}
    assert t.read().groupBy("issue_id").count().where("count > 1").count() == 0   # keys stay unique
    t.upsert(_issue_rows(spark, [("2", '{"v": 2}', 0, 0), ("3", '{"v": 2}', 0, 1)]))  # replay: idempotent
    assert t.read().count() == 3
    assert t.high_water_mark().first()[0] is not None
    audit = t.truncate("issues").first()
    assert (audit.table_name, audit.rows_before, audit.rows_after) == ("issues", 3, 0)


def test_truncate_missing_table(spark):
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, scratch_path(spark, "nope") + "/absent", "teams").truncate()


def test_upsert_landed_is_order_free_and_idempotent(spark):
    import json as _json
    from pyspark.sql import functions as _F
    from ticketlake.operators.merge import KeyedTable as _KT
    from ticketlake.session import scratch_path as _sp
    # three pages of one run; a1 appears on pages 0 and 2, a2 twice on page 1 (first item wins)
    pages = {0: [("a0", 0), ("a1", 0)], 1: [("a2", 1), ("a2", 99), ("a3", 1)], 2: [("a1", 2)]}

    def batch(p):
        rows = [("r0", p, pos, k, _json.dumps({"id": k, "v": v})) for pos, (k, v) in enumerate(pages[p])]
        df = spark.createDataFrame(rows, "run_id string, page_no long, pos long, account_id string, j string")
        return df.select("account_id", _F.parse_json("j").alias("data"),
                         _F.current_timestamp().alias("updated_at"), "run_id", "page_no", "pos")

    expected = {"a0": 0, "a1": 2, "a2": 1, "a3": 1}
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0, 2, 1)):
        t = _KT(spark, _sp(spark, "landed"), "accounts", landing=True)
        for p in order:
            t.upsert_landed(batch(p))
        got = {r.account_id: r.v for r in t.read().select(
            "account_id", _F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
        assert got == expected, order


def _v(table):
    return {r.issue_id: r.v for r in table.read().select("issue_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}


def _versioned(spark, ids, v):
    return _issue_rows(spark, [(f"i{k}", f'{{"v": {v}}}', 0, k) for k in ids])


def test_small_upsert_leaves_all_files_alone(spark):
    import os
    path = scratch_path(spark, "append")
    t = KeyedTable(spark, path, "issues")
    t.upsert(_versioned(spark, range(200), 1))
    files = lambda: {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}
    before = files()
    t.upsert(_versioned(spark, range(195, 205), 2))
    assert before.items() <= files().items()
    assert _v(t) == {f"i{k}": 1 if k < 195 else 2 for k in range(205)}


def test_open_with_other_keys_is_an_error(spark):
    path = scratch_path(spark, "keys")
    KeyedTable(spark, path, "issues").create()
    with pytest.raises(ValueError, match="was created with"):
        KeyedTable(spark, path, "accounts").create()


def test_compaction_and_vacuum_keep_the_rows(spark):
    t = KeyedTable(spark, scratch_path(spark, "compact"), "issues")
    for v in range(12):
        t.upsert(_versioned(spark, range(v, v + 5), v))
    expected = {f"i{k}": min(k, 11) for k in range(16)}
    assert len(t.versions()) < 12 and _v(t) == expected
    assert t.vacuum() > 0 and _v(t) == expected and t.vacuum() == 0
    t.compact(max_deltas=0)
    assert _v(t) == expected


def test_failed_write_is_not_read(spark):
    path = scratch_path(spark, "failed")
    t = KeyedTable(spark, path, "issues")
    t.upsert(_versioned(spark, range(3), 1))
    t._store(t.prepare(_versioned(spark, range(9), 7)), 4)           # a writer that died before its commit
    assert _v(t) == {"i0": 1, "i1": 1, "i2": 1}
    (open(f"{path}/_log/0000000001.json", "w")).close()             # and one that died inside it
    assert _v(t) == {"i0": 1, "i1": 1, "i2": 1}
    t.upsert(_versioned(spark, range(2, 4), 2))
    assert _v(t) == {"i0": 1, "i1": 1, "i2": 2, "i3": 2}


def test_interleaved_writers_lose_no_row(spark, monkeypatch):
    """Both writers know the same newest version; the second takes the next number."""
    from ticketlake.operators.commits import CommitLog
    path = scratch_path(spark, "two")
    a, b = KeyedTable(spark, path, "issues"), KeyedTable(spark, path, "issues")
    a.upsert(_versioned(spark, range(4), 1))
    known = a.log.numbers()
    add = CommitLog.add
    monkeypatch.setattr(CommitLog, "add", lambda self, *args, **kw: add(self, *args, **{**kw, "numbers": known}))
    a.upsert(_versioned(spark, range(2, 6), 2))
    b.upsert(_versioned(spark, range(5, 8), 3))
    assert [v.n for v in a.versions()] == [0, 1, 2]
    assert _v(b) == {"i0": 1, "i1": 1, "i2": 2, "i3": 2, "i4": 2, "i5": 3, "i6": 3, "i7": 3}


def test_writers_at_once_lose_no_row(spark):
    from concurrent.futures import ThreadPoolExecutor
    path = scratch_path(spark, "many")
    KeyedTable(spark, path, "issues").create()
    with ThreadPoolExecutor(4) as threads:
        list(threads.map(lambda k: KeyedTable(spark, path, "issues").upsert(_versioned(spark, range(10 * k, 10 * k + 10), k)), range(4)))
    assert _v(KeyedTable(spark, path, "issues")) == {f"i{k}": k // 10 for k in range(40)}


def test_upsert_during_compaction_stays_above_it(spark):
    t = KeyedTable(spark, scratch_path(spark, "during"), "issues")
    for v in range(3):
        t.upsert(_versioned(spark, range(5), v))
    folded = t.versions()
    late = KeyedTable(spark, t.path, "issues")
    store = t._store

    def slow(rows, buckets):
        folder = store(rows, buckets)
        late.upsert(_versioned(spark, range(2), 9))                  # commits while the fold is being written
        return folder
    t._store = slow
    assert t.compact(max_deltas=0)
    t._store = store
    assert _v(t) == {"i0": 9, "i1": 9, "i2": 2, "i3": 2, "i4": 2} and len(t.versions()) == 2 < len(folded)
    late.truncate()
    assert t.read().count() == 0 and late.log.active()[0].folder is None
    late.upsert(_versioned(spark, range(1), 4))
    assert _v(t) == {"i0": 4}


def _final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan


def test_read_moves_no_payload_of_the_base(spark):
    t = KeyedTable(spark, scratch_path(spark, "plan"), "issues")
    t.upsert(_versioned(spark, range(300), 1))
    for v in (2, 3):
        t.upsert(_versioned(spark, range(290, 310), v))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, x in off.items():
            spark.conf.set(k, x)
        df = t.read()
        df.collect()
        root = df._jdf.queryExecution().executedPlan()
        plan = root.toString()
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)
    import re
    plan = plan.split("Initial Plan")[0]
    moved = [line for line in plan.split("\n") if re.search(r"\bExchange (hash|range|Single)", line)]
    for line in moved:                       # what is below an exchange: keys, no payload
        at = plan.index(line)
        below = plan[at:].split("\n", 2)[1]
        assert "data#" not in below, below
    assert "Bucketed: true" in plan and _v(t) == {f"i{k}": 3 if k >= 290 else 1 for k in range(310)}


def test_lookup_opens_one_bucket(spark):
    t = KeyedTable(spark, scratch_path(spark, "lookup"), "issues", buckets=16)
    t.upsert(_versioned(spark, range(400), 1))
    t.upsert(_versioned(spark, range(100, 120), 2))
    for key, want in (("i5", 1), ("i110", 2), ("nothing", None)):
        df = t.lookup(key)
        files = df.inputFiles()
        assert len(files) <= 2 and len({f.rsplit("_", 1)[1].split(".")[0] for f in files}) <= 1
        got = [r.v for r in df.select(F.try_variant_get("data", "$.v", "int").alias("v")).collect()]
        assert got == ([] if want is None else [want])
    two = KeyedTable(spark, scratch_path(spark, "lookup2"), keys=["k1", "k2"], buckets=8,
                     schema=spark.createDataFrame([], "k1 string, k2 string, v string, updated_at timestamp").schema)
    two.upsert(rows(spark, [(f"a{i}", f"b{j}", f"{i}-{j}", "2024-01-01", 1, 0, i * 10 + j) for i in range(5) for j in range(5)]))
    assert [r.v for r in two.lookup("a3", "b4").collect()] == ["3-4"]


def test_typed_columns_skip_row_groups(spark):
    """A filter on a typed column is pushed to the files and reads fewer rows than the table holds."""
    from ticketlake.functions.jsonx import text_of, time_of
    states = ["closed", "new", "on_hold"]
    data = [(str(k), f'{{"id": "{k}", "state": "{states[k % 3]}", "modified_at": "2024-01-{k % 28 + 1:02d}T00:00:00Z"}}', 0, k) for k in range(3000)]
    data.append(("odd", '{"id": "odd", "state": {"a": 1}, "modified_at": "no time"}', 0, 3000))
    t = KeyedTable(spark, scratch_path(spark, "typed"), "issues", buckets=1)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "8192")
    try:
        t.upsert(_issue_rows(spark, data))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    issues = t.read(typed=True)
    df = issues.where((text_of(issues, "state") == "new") & (time_of(issues, "modified_at") < F.lit("2024-01-03").cast("timestamp"))).select("issue_id")
    assert {r.issue_id for r in df.collect()} == {str(k) for k in range(3000) if k % 3 == 1 and k % 28 < 2}
    plan = df._jdf.queryExecution().executedPlan()
    assert "EqualTo(_t_state,new)" in plan.toString() and "LessThan(_t_modified_at" in plan.toString()

    def scans(node):
        kids = node.children()
        if "AdaptiveSparkPlan" in node.nodeName():
            return scans(node.executedPlan())
        return [node] * node.nodeName().startswith("Scan parquet") + [x for i in range(kids.size()) for x in scans(kids.apply(i))]
    read = sum(s.metrics().apply("numOutputRows").value() for s in scans(plan))
    assert read < 1500
    assert t.read().columns == ["issue_id", "data", "updated_at"] and t.read().count() == 3001


def test_random_histories_equal_a_dict(spark):
    import random
    r = random.Random(5)
    for landing in (False, True):
        t = KeyedTable(spark, scratch_path(spark, "history"), "accounts", landing=landing)
        model, seen = {}, {}
        for step in range(7):
            ids = r.sample(range(30), 12)
            page = r.randrange(20) if landing else step
            rows_ = [(f"r{page % 2}", page, i, f"a{k}", f'{{"v": {step * 100 + i}}}') for i, k in enumerate(ids)]
            df = spark.createDataFrame(rows_, "run_id string, page_no long, pos long, account_id string, j string").select(
                "account_id", F.parse_json("j").alias("data"), F.current_timestamp().alias("updated_at"), "run_id", "page_no", "pos")
            t.upsert_landed(df) if landing else t.upsert(df)
            for i, k in enumerate(ids):
                place = (f"r{page % 2}", page, -i, step) if landing else (step,)
                if place > seen.get(k, ()):
                    seen[k], model[f"a{k}"] = place, step * 100 + i
            if step == 4:
                t.compact(max_deltas=1)
        got = {x.account_id: x.v for x in t.read().select("account_id", F.try_variant_get("data", "$.v", "int").alias("v")).collect()}
        assert got == model


def test_a_long_log_is_listed_once(spark, monkeypatch):
    """A commit costs the same however many came before; another writer's commits are seen."""
    from ticketlake.operators.commits import CommitLog, Files
    path = scratch_path(spark, "log")
    own, other = CommitLog(Files(spark), path), CommitLog(Files(spark), path)
    own.add(None, None, "a", 1)
    lists, texts = [], []
    names, text = Files.names, Files.text
    monkeypatch.setattr(Files, "names", lambda self, p: lists.append(p) or names(self, p))
    monkeypatch.setattr(Files, "text", lambda self, p: texts.append(p) or text(self, p))
    assert own.add(None, None, "b", 1).n == 1
    del lists[:]
    assert [other.add(None, None, f, 1).n for f in "cd"] == [2, 3]
    assert own.add(None, None, "e", 1).n == 4
    assert [c.folder for c in own.active()] == [c.folder for c in own.active()] == list("abcde")
    own.add(0, 4, "base", 1)
    assert [c.folder for c in own.active()] == [c.folder for c in other.active()] == ["base"]
    assert lists == [path] and len(texts) == len(set(texts)) + 1     # the base is read by both logs


def test_restrict_to_has_no_count_and_no_single_partition(spark):
    from ticketlake.operators.keysets import restrict_to
    msgs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "issue_id string, n int")
    ids = spark.createDataFrame([("a",), ("c",), ("z",)], "issue_id string")
    out = restrict_to(msgs, ids)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n for r in out.collect()) == [1, 2, 4]


def test_restrict_to_sifts_rows_before_they_are_shuffled(spark):
    """The semi join lies behind the fixed-size bitmap; rows are those of the plain semi join (NULL keys never,
    repeated rows and ids as they are, ids of another type by their value)."""
    from ticketlake.operators.keysets import restrict_to
    msgs = spark.createDataFrame([("a", 1), ("a", 1), ("b", 3), (None, 4), ("7", 5)], "issue_id string, n int")
    ids = spark.createDataFrame([("a",), ("a",), (None,), ("7",), ("z",)], "issue_id string")
    out = restrict_to(msgs, ids)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("getbit")                # the root is printed first
    assert out.columns == msgs.columns
    assert sorted(r.n for r in out.collect()) == [1, 1, 5]
    assert restrict_to(msgs, ids.limit(0)).count() == 0
    assert [r.n for r in restrict_to(msgs.where("n = 5"), spark.createDataFrame([(7,)], "issue_id int")).collect()] == [5]


def test_ids_read_from_records_are_never_broadcast(spark):
    """Beside a record (2 KB a row, as Spark takes it) any id set looks tiny; only the fixed-size bitmap is broadcast."""
    import re

    from ticketlake.operators.keysets import restrict_to
    msgs = spark.createDataFrame([("a", 1), ("b", 3)], "issue_id string, n int")
    path = scratch_path(spark, "records")
    spark.createDataFrame([("a", '{"id": "a"}')], "issue_id string, j string").select("issue_id", F.parse_json("j").alias("data")).write.parquet(path)
    ids = spark.read.parquet(path).select(F.try_variant_get("data", "$.id", "string").alias("issue_id"))
    for other in (ids, ids.select(F.xxhash64("issue_id").alias("issue_id"))):
        plan = restrict_to(msgs, other)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastHashJoin .*LeftSemi", plan), plan
    assert [r.n for r in restrict_to(msgs, ids).collect()] == [1]


def test_shuffles_begin_with_many_partitions(spark):
    """Whatever the session's shuffle partitions, a task's share does not grow with the input; a user's number holds."""
    from ticketlake.session import configure, initial_partitions
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert [initial_partitions(n) for n in (4, 24, 200, 2000)] == [1024, 1032, 1200, 2000]
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        configure(spark)
        plan = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(" in plan and ", 1024)" in plan
        spark.conf.set(name, "16")
        configure(spark)
        assert spark.conf.get(name) == "16"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
