import math

import numpy as np

from ticketlake.llm import rules

from .frames import documents, edge_texts, empty, words


def plain(t):
    w = (t or "").encode().split()
    lines, dup, seen = (t or "").split("\n"), 0, set()
    for x in lines:
        if x.split():
            dup += x in seen
            seen.add(x)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, x in enumerate(tri) if tri.count(x) > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit))


def test_statistics_by_hand(spark):
    texts = edge_texts()[:3] + [(20, "a b c a b c\na b\n\na b\nx# <y>"), (21, words(60, 3) + "\n" + words(60, 3)), (22, None)]
    for i, t in texts:
        assert rules.text_statistics((t or "").encode())[:5] == plain(t), i
    got = {r.doc_id: r for r in rules.judge_documents(documents(spark, texts)).collect()}
    for i, t in texts:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)                  # no labels: only the base rules


def test_forest_finds_odd_rows(spark):
    good = [(i, words(100 + i, i)) for i in range(120)]
    bad = [(1000 + i, " ".join(x + "***" for x in words(90, i).split())) for i in range(8)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:60]] + [(i, 0) for i, _ in bad[:4]], "doc_id long, quality int")
    verdict = {r.doc_id: r.kept for r in rules.judge_documents(docs, labels).collect()}
    assert all(verdict[i] for i, _ in good) and not any(verdict[i] for i, _ in bad)
    kept = rules.keep_documents(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [i for i, _ in good]


def test_empty(spark):
    assert rules.judge_documents(empty(spark)).count() == 0
    assert rules.keep_documents(empty(spark), None).count() == 0


def test_expected_path_and_tree():
    assert rules._expected(1) == 0 and rules._expected(2) == 1
    assert math.isclose(rules._expected(256), 10.24, abs_tol=0.01)
    points = np.concatenate([np.zeros((255, 2)), [[9.0, 9.0]]])
    rng = np.random.default_rng(0)
    trees = [rules.grow_tree(points[rng.choice(256, 256, replace=False)], rng) for _ in range(20)]
    s = rules.forest_scores(trees, points, 256)
    assert s[-1] > 0.9 and (s[:-1] < 0.5).all()
