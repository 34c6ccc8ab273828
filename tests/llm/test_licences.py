import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ticketlake.llm import licences
from ticketlake.llm.licences import OP11_SQL, PHRASES, TEMPLATES, scan

from .frames import documents, edge_texts, empty, words

NAMES = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, templates=TEMPLATES, containment=90):
    half = max((len(n.split()) for _, n in templates), default=1)
    out = []
    for doc_id, text in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        base = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        hits = []
        for s in range(0, max(len(w) - half - 1, 0) + 1, half):
            block = set(w[s:s + 2 * half])
            for label, n in templates:
                t = set(n.split())
                if 100 * len(t & block) >= containment * len(t):
                    hits.append((label, len(t & block) / len(t), s, min(s + 2 * half, len(w))))
        at = [i for i, _ in base]
        out.append((doc_id, len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})),
                    ",".join(sorted({x for _, x in base} | {x[0] for x in hits})),
                    1.0 if base else max([x[1] for x in hits], default=0.0), tuple(sorted(set(hits)))))
    return out


def found(df):
    return [(*(r[c] for c in NAMES), tuple((b["label"], b["containment"], b["start"], b["end"]) for b in r["blocks"])) for r in df.collect()]


def texts():
    filler = words(200, 3)
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    own = [
        "Released under the MIT License.", "UNDER THE MIT-LICENSE under the mit license", "under the mit\nlicense",
        "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "apache license version 20",
        "This work is licensed under the GNU General Public License, version 3.", filler + " " + bsd + " " + filler,
        "redistribution and use in binary forms with or without modification are permitted provided",   # two words short: 13 of 15
        "license the mit under released", "Creative Commons Attribution-ShareAlike license", "the the the under under", "mit", "cc by",
        filler + " Permission is hereby granted, free of charge, to any person obtaining a copy of this work " + filler,
        "Éunder the mit license", "under the mit licenseé", "K under the mit license",
    ]
    # a notice across every place of a block's edge
    own += [" ".join(["x"] * k) + " permission is hereby granted free of charge to any person obtaining a copy of this software" for k in range(0, 60, 7)]
    return own


@pytest.mark.parametrize("containment", [90, 60, 100])
def test_against_brute_force(spark, containment):
    docs = edge_texts() + [(100 + i, t) for i, t in enumerate(texts())] * 2
    got = Counter(found(scan(documents(spark, docs), containment=containment)))
    assert got == Counter(brute(docs, containment=containment))


def test_sql(spark):
    docs = [(i, t) for i, t in enumerate(texts())] + [(1000, None), (1001, ""), (1002, words(900, 1))]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    want = Counter(tuple(r) for r in con.execute(f"SELECT {', '.join(NAMES)} FROM ({OP11_SQL})").fetchall())
    got = Counter(tuple(r) for r in scan(documents(spark, docs)).select(*NAMES).collect())
    assert got == want


def test_edges(spark):
    assert scan(empty(spark)).count() == 0
    docs = edge_texts() + [(5, "under the mit license")]
    got = Counter(found(scan(documents(spark, docs), templates=())))
    assert got == Counter(brute(docs, templates=()))


def test_one_shuffle_without_text(spark, sf):
    plan = scan(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    exchange = plan[plan.index("Exchange hashpartitioning"):].split("\n")[1]
    assert "words" not in exchange.replace("n_words", "")


def test_filters_lose_nothing(spark):
    """Prefix, length and positional filters against plain counting, on many random sets."""
    templates = tuple((f"t{i}", words(4 + 3 * (i % 5), 50 + i, 12)) for i in range(12))
    docs = [(i, words(3 + i % 40, i, 12)) for i in range(120)]
    got = Counter(found(scan(documents(spark, docs), templates=templates, containment=70)))
    assert got == Counter(brute(docs, templates, 70))


def test_word_order_counts_documents(spark):
    docs = documents(spark, [(i, "mit mit" if i < 5 else "the mit") for i in range(9)])
    templates = (("a", "the mit zzz"),)
    rows = licences._read(docs, (), licences.in_order(templates, ["mit", "the", "zzz"], 60))
    assert licences.word_order(rows, templates) == ["zzz", "the", "mit"]
    assert rows.where(F.col("text").isNotNull()).count() == 4      # two of three words: the others' texts are not kept
