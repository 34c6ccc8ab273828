import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from ticketlake.llm import collocations as c

from .frames import SCHEMA, edge_texts, empty, words


def brute(docs, least=30, top=2000):
    """docs: (text, lang). Python integers are exact."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, g in f.items():
        cand = {p: a for p, a in g.items() if len(p) >= 2 and a >= least}
        gone = {q[i:i + k] for q, b in cand.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= 80 * g[q[i:i + k]]}
        rows = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2000000 * a // (g[p[:k]] + g[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), g[p[:k]], g[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return Counter(out)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, (t, lang) in enumerate(docs)], SCHEMA)


def corpus(seed=1):
    r = random.Random(seed)
    docs = [(t, "en") for _, t in edge_texts()]
    phrases = ["new york city hall", "New York, city", "machine learning", "a b", "b a b a", "Ünï çode", "ß\x1cß x", "ha ha ha ha ha"]
    for i in range(400):
        w = [r.choice(phrases) if r.random() < 0.4 else f"w{int(r.paretovariate(0.9))}" for _ in range(r.randrange(1, 60))]
        docs.append(((r.choice([" ", "\t", "  ", ". ", "! ", "\n", "\x0b"])).join(w), r.choice(["en", "en", "de", None, "und", ""])))
    docs += [("one shared passage of words here", "fr")] * 35 + [("tie one. tie two. tie three", "es")] * 30
    docs += [("under thirty", "fr")] * 29
    return docs


@pytest.mark.parametrize("held, top", [(c.HELD, 2000), (500, 7)])
def test_against_brute_force(spark, held, top):
    docs = corpus()
    got = c.collocations(frame(spark, docs), top=top, held=held).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, top=top)


def test_bits_are_only_a_superset(spark):
    """With few bits most rare words pass as frequent; the result is the same."""
    docs = corpus(2)
    assert Counter(tuple(r) for r in c.collocations(frame(spark, docs), bitmap=7).collect()) == brute(docs)


def test_sql(spark):
    docs = corpus(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    cur = con.execute(c.OP12_SQL)
    assert [d[0] for d in cur.description] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(cur.fetchall()) == brute(docs)


def test_products_beyond_64_bits(spark):
    big = 9 * 10**12
    cells = spark.createDataFrame([("en", 1, "x", "y", big), ("en", 0, "", "x", big + 1), ("en", 0, "", "y", big + 2)],
                                  "lang string, k int, prefix string, next string, f long")
    r = c.scored(cells).first()
    assert (r.a, r.l, r.r, r.score) == (big, big + 1, big + 2, 2000000 * big // (2 * big + 3))


def test_edges(spark):
    assert c.collocations(empty(spark)).count() == 0
    assert c.collocations(frame(spark, [(None, None), ("", "en"), ("one two", None)])).count() == 0
    long_ = " ".join(["alpha beta"] * 30000) + " " + words(50000, 3)
    docs = [(long_, "en"), ("gamma delta", "en")]
    assert Counter(tuple(r) for r in c.collocations(frame(spark, docs)).collect()) == brute(docs)


def test_stripes_are_merged_where_they_arrive(spark):
    """One exchange, of stripes: cells are summed in the task that reads them."""
    rows = c.stripes(frame(spark, corpus()), c._Chunk.words_stripes)
    plan = c.merged(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
