import re

import corpus_pipeline
from ticketlake.llm.common import stored, table
from ticketlake.llm.queries import QUERIES

from .frames import words
from .test_decontam import brute as contaminated
from .test_rules import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    bench = [(i, words(30, 700 + i, 3000)) for i in range(3)]
    clean = [(i, words(80 + i, i, 3000)) for i in range(60)]
    junk = [(100 + i, " ".join(x + "$$$" for x in words(90, i).split())) for i in range(6)]
    short = [(200, "too short"), (201, None), (202, "")]
    copies = [(300, clean[3][1]), (301, clean[4][1].replace("w1", "W1")), (302, clean[5][1] + " more")]
    leaks = [(400, words(60, 90, 3000) + " " + bench[1][1])]
    private = [(500, words(60, 91, 3000) + " me.12@mail1.example.com")]
    every = clean + junk + short + copies + leaks + private
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in every],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in clean[:40]] + [(i, 0, 0) for i, _ in junk[:3]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    kept = {i: t for i, t in clean + leaks + private}
    assert all(plain(t)[0] >= 50 for t in kept.values())
    docs = table(spark, d, "documents")
    want = [{*kept, 300, 301, 302}, {*kept}, {i for i, t in kept.items() if not contaminated(t, bench)[4]}]
    want.append(want[-1])
    for (name, stage), ids in zip(corpus_pipeline.STAGES, want, strict=False):
        docs = stored(stage(spark, docs, d), name)
        assert docs.columns == COLUMNS
        assert sorted(r.doc_id for r in docs.collect()) == sorted(ids), name
    last = {r.doc_id: r for r in docs.collect()}
    assert "me.12@" not in last[500].text and re.search(r"[a-z]{2}\.\d\d@mail1\.example\.com$", last[500].text)
    assert all(r.n_chars == len(r.text) for r in last.values())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert sorted(r.doc_id for r in out.collect()) == sorted(want[-1])


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row_id string, id string, `group` string"


def tables(spark, d, docs, bench=((0, "one two"),), labels=()):
    spark.createDataFrame(docs, CLASHING).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return table(spark, d, "documents")


def row(i, t):
    return (i, t, "en", "s", len(t or ""), "r", "i", "g")


def test_verdicts_hold_for_rows(spark, tmp_path):
    """Rows without a doc_id, rows that share one, and equal rows, each judged by its own text."""
    item, a, b, c = words(30, 700, 3000), words(90, 1, 3000), words(90, 2, 3000), words(90, 3, 3000)
    leak = words(60, 9, 3000) + " " + item
    every = [row(None, a), row(None, a + " more"), row(5, b), row(5, c), row(5, c), row(4, b + " end"), row(None, leak), row(6, leak),
             row(7, words(80, 8, 3000)), row(7, words(70, 10, 3000) + " " + item), row(8, None), row(9, ""), row(9, "")]
    docs = tables(spark, str(tmp_path), every, [(0, item)])
    stages = dict(corpus_pipeline.STAGES)
    told = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.collect())
    unique = stages["ngram_jaccard_join"](spark, docs, str(tmp_path))
    assert unique.columns == docs.columns
    got = told(unique)
    # of a and its copy one stays (either: both ids are NULL); of b and its copy that of the smaller id; of equal rows one
    assert ("None", a) in got or ("None", a + " more") in got
    assert [x for x in got if x[1] not in (a, a + " more")] == sorted([
        ("5", c), ("4", b + " end"), ("6", leak), ("7", every[8][1]), ("7", every[9][1]), ("8", ""), ("9", "")])
    clean = stages["decontamination"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert told(clean) == sorted((str(r[0]), r[1] or "") for r in every if item not in (r[1] or ""))


def test_empty_tables_in_every_stage(spark, tmp_path):
    docs = tables(spark, str(tmp_path), [row(1, "x")], [(0, None)]).where("doc_id = 2")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_registered():
    assert sorted({int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES}) == list(range(1, 14))
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
