import random
from collections import Counter

import pytest

from ticketlake.llm import ngram_join

from .frames import documents, edge_texts, empty, words


def brute(docs):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    at = list(range(len(docs)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * len(a | sets[j]):
                at[root(i)] = root(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for own in groups.values():
        ids = [docs[i][0] for i in own if docs[i][0] is not None]
        out += [(str(docs[i][0]), len(sets[i]), min(ids) if ids else None) for i in own]
    return Counter(out)


def near_copies(seed, base_words, copies, most):
    r = random.Random(seed)
    base = words(base_words, seed, 5000).split()
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(r.randrange(most)):
            w[r.randrange(len(w))] = f"new{r.randrange(9999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 4])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join.block_pairs, "__defaults__", (block,))
    shared = words(25, 999, 5000)
    texts = [t for s in range(4) for t in near_copies(s, 60 + 40 * s, 14, 9)]
    texts += [words(40, 100 + i, 5000) + " " + shared for i in range(12)]          # one passage, unlike documents
    texts += ["a b c", "A  B c", "a b", "a b c d e", "a b c d e f"]
    random.Random(1).shuffle(texts)
    docs = edge_texts() + [(100 + i, t) for i, t in enumerate(texts)]
    got = ngram_join.linked_documents(documents(spark, docs)).collect()
    assert Counter((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == brute(docs)


def test_empty(spark):
    assert ngram_join.linked_documents(empty(spark)).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(60, 50), (60, 55), (7, 7)], "a long, b long")
    got = {r.cid: r.label for r in ngram_join.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 55: 50, 60: 50}
