import random
from collections import Counter

import numpy as np
import pytest

from ticketlake.llm import suffix

from .frames import documents, edge_texts, empty, words


def brute(docs, length=50):
    split = [(t or "").lower().split() for _, t in docs]
    where = {}
    for r, w in enumerate(split):
        for s in range(len(w) - length + 1):
            where.setdefault(tuple(w[s:s + length]), set()).add(r)
    out = []
    for (i, _), w, r in zip(docs, split, range(len(docs)), strict=True):
        hit = set()
        for s in range(len(w) - length + 1):
            if len(where[tuple(w[s:s + length])]) > 1:
                hit.update(range(s, s + length))
        out.append((str(i), len(w), len(hit)))
    return Counter(out)


@pytest.mark.parametrize("range_size", [suffix.RANGE, 5, 0])
def test_against_brute_force(spark, range_size):
    r = random.Random(4)
    passage = [words(n, 500 + n) for n in (49, 50, 51, 80, 200)]
    docs = edge_texts()
    for i in range(40):
        docs.append((100 + i, f"{words(r.randrange(60), i)} {passage[i % 5].upper()} {words(r.randrange(60), 50 + i)}"))
    docs += [(200, "same " * 300), (201, "same " * 120), (202, words(60, 71) + " " + words(60, 71))]
    # the same right half after different left halves, and the reverse
    half = words(40, 800)
    docs += [(300 + i, f"{words(40, 810 + i // 2)} {half}") for i in range(6)] + [(400 + i, f"{half} {words(40, 820 + i // 2)}") for i in range(6)]
    got = suffix.repeated_passages(documents(spark, docs), range_size=range_size).collect()
    assert Counter((str(x.doc_id), x.n_words, x.n_repeat_words) for x in got) == brute(docs)
    for x in got:
        assert sum(s["end"] - s["start"] for s in x.spans) == x.n_repeat_words
        assert bool(x.n_repeat_words) == bool(x.spans)


def test_a_frequent_gram_and_a_very_long_text(spark):
    """One sentence in every text, with other words around it: its k-grams have more entries than meet in a task."""
    hot = words(12, 900)
    docs = [(i, f"{words(45, i)} {hot} {words(45, 1000 + i % 20)}") for i in range(60)]
    docs += [(100, words(30_000, 7) + f" {hot} " + words(45, 1003)), (101, words(45, 1003))]
    got = suffix.repeated_passages(documents(spark, docs), range_size=8).collect()
    assert Counter((str(x.doc_id), x.n_words, x.n_repeat_words) for x in got) == brute(docs)


def test_empty(spark):
    assert suffix.repeated_passages(empty(spark)).count() == 0


def test_every_window_has_a_minimiser():
    g = np.random.default_rng(0).integers(0, 1 << 20, 500).astype(np.uint64)
    at = suffix.minimisers(g)
    for s in range(500 - 43 + 1):
        own = g[s:s + 43]
        assert any(s <= p < s + 43 and g[p] == own.min() for p in at)
    assert set(at) == {s + int(i) for s in range(500 - 43 + 1) for i in np.flatnonzero(g[s:s + 43] == g[s:s + 43].min())}


def test_the_driver_gets_the_bitmap_in_words_of_64_bits(spark, monkeypatch):
    """As many rows as the bitmap has words at most, however many k-grams are shared; the same bits."""
    monkeypatch.setattr(suffix, "BITMAP", 10)
    frame, got = type(spark.range(0)), []
    for name, size in (("toPandas", len), ("collect", len), ("toArrow", lambda t: t.num_rows)):
        def told(self, *a, _f=getattr(frame, name), _size=size, **k):
            out = _f(self, *a, **k)
            got.append(_size(out))
            return out
        monkeypatch.setattr(frame, name, told)
    texts = [words(4000, 1), words(4000, 1), words(3000, 2)]
    bits = suffix.shared_grams(documents(spark, list(enumerate(texts))), suffix.LENGTH)
    g = suffix.grams(suffix.word_hashes(texts[0].encode()))
    want = np.zeros(1 << 10, np.uint8)
    want[suffix._place(np.unique(g[suffix.minimisers(g)])).astype(np.int64)] = 1
    assert (np.unpackbits(bits, bitorder="little") == want).all() and want.sum() > 100
    assert 0 < sum(got) <= 1 << (10 - 6)
