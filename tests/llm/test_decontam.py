import hashlib
import re

import pytest

from ticketlake.llm import decontam

from .frames import documents, edge_texts, empty, words


def plain_words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found = plain_words(text), set(), set()
    for i, t in items:
        b = plain_words(t)
        for win in {tuple(b[s:s + 10]) for s in range(max(len(b) - 9, 1))} if b else ():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found.add("" if i is None else str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(10, words(30, 77)), (9, "Short item, Two words"), (11, None), (12, ""), (None, words(12, 78)), (10, "other text of ten " + words(9, 79))]


@pytest.mark.parametrize("block", [1, decontam.BLOCK_BYTES])
def test_against_brute_force(spark, monkeypatch, block):
    passage = words(30, 77).split()
    texts = edge_texts() + [
        (30, words(40, 1) + " " + " ".join(passage[3:17]).upper() + " " + words(9, 2)), (31, "x short--item TWO (words) y"),
        (32, " ".join(passage[:9])), (33, " ".join(passage) + " " + " ".join(passage)), (34, words(12, 78)),
        (35, " ".join(passage[:5])), (36, " ".join(passage[5:10]))]          # a window must not run over documents
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (block,))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                 for r in decontam.contamination(documents(spark, texts), bench).collect())
    assert got == sorted((str(i), *brute(t, ITEMS)) for i, t in texts)


def test_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contamination(empty(spark), bench).count() == 0
    got = decontam.contamination(documents(spark, edge_texts()), bench.where("false")).collect()
    assert len(got) == len(edge_texts()) and not any(r.contaminated for r in got)


def test_proximity(spark):
    docs = documents(spark, [(1, "red a b green c d"), (2, "green x x x x x red"), (3, "red"), (4, "green"), (5, None)])
    index = decontam.build_index(docs, shard_tokens=4)
    near = lambda slop: sorted({r.doc_id for r in decontam.near_matches(index, {"q": ["Green", "red"]}, slop).collect()})
    assert near(3) == [1] and near(6) == [1, 2] and near(2) == []
