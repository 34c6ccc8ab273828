import random

from ticketlake.llm import langid

from .frames import empty

SYLLABLES = {"aa": "ka lo mi ru te", "bb": "sch ung ein cht ver", "cc": "eau oux ent ré ça"}


def text(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    s = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_edges_and_accuracy(spark):
    rows = [(i, text(v, 5 + i % 90, i), v) for i in range(90) for v in SYLLABLES]
    rows = [(k, t, v) for k, (_, t, v) in enumerate(rows)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = [(1000 + i, text(v, 30, 1000 + i), v) for i in range(30) for v in SYLLABLES]
    odd = [(1, None), (2, ""), (3, "123 ?!"), (4, "x"), (5, text("bb", 6000, 1)), (5, text("bb", 6000, 1)), (None, text("cc", 9, 2))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in more] + odd, "doc_id long, text string")
    learn_from = train.unionByName(spark.createDataFrame([(9000, "zz", None), (None, None, "aa")], train.schema))
    got = langid.identify(docs, learn_from).collect()
    assert len(got) == len(more) + len(odd)
    by = {r.doc_id: r for r in got}
    assert sum(by[1000 + i].lang_pred is not None for i in range(30)) == 30
    want = {}
    for i, t, v in more:
        want.setdefault(t, v)
    right = sum(r.lang_pred == v for r, v in zip(got[:len(more)], [v for _, _, v in more], strict=True))
    assert right >= 0.98 * len(more)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (1, 2, 3))
    assert by[4].lang_pred in SYLLABLES and by[5].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(empty(spark), learn_from).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    got = langid.identify(docs, spark.createDataFrame([], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_training_rows_are_bounded_when_a_document_repeats(spark):
    rows = [(i, text(v, 30, i), v) for i in range(40) for v in SYLLABLES]
    rows += [(i, text("aa", 5 + k % 50, k), "aa") for i in range(40) for k in range(30)] + [(7, None, "aa"), (7, "1 2", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = langid.train_rows(docs, 10).collect()
    assert {v: sum(r["lang"] == v for r in got) for v in SYLLABLES} == dict.fromkeys(SYLLABLES, 10)
    assert len({(r["doc_id"], r["lang"]) for r in got}) == len(got)
    again = langid.train_rows(docs.repartition(2), 10).collect()
    assert {(r["doc_id"], r["lang"]): bytes(r["bag"]) for r in got} == {(r["doc_id"], r["lang"]): bytes(r["bag"]) for r in again}
    long_ = langid.train_rows(spark.createDataFrame([(1, text("bb", 200_000, 1), "bb")], docs.schema)).first()
    assert "text" not in long_ and len(long_["bag"]) <= 8 << langid.BITS


def test_rejection_bound():
    m = langid.train([text(v, 40, i) for i in range(60) for v in SYLLABLES], [v for _ in range(60) for v in SYLLABLES])
    assert 0 < m.reject_under <= 1 and m.predict(text("aa", 40, 999))[0] == "aa"
