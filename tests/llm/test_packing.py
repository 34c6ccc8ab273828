import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ticketlake.llm import packing

from .frames import documents, edge_texts, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_edges_against_the_tokenizer(spark):
    docs = edge_texts() + [(50, "it's don't <|endoftext|> a b　c é İ ß Σς x" * 3)]
    rows = packing.pack_documents(documents(spark, docs)).collect()
    t = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            own = ids[s:s + 4096]
            want[(i, k, s, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    check_places(rows, 4096)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_a_batch_does_not_walk_through_the_remembered_words():
    class Remembered(dict):
        def __iter__(self):
            raise AssertionError("walked through")

    tokenizer, generations, _ = packing.word_ids(PATH)
    kept = generations[:]
    texts = [b"Some new words, and some w\xc3\xb6rds known", b"", b"words once known"]
    want = [np.array([*tokenizer.encode(x.decode(), add_special_tokens=False).ids, 1], dtype="<u4").tobytes() for x in texts]
    try:
        ids = lambda w: np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        generations[:] = Remembered({w: ids(w) for w in (b"known", b"some")}), Remembered({w: ids(w) for w in (b"once", b"words")})
        assert packing.encode(texts, PATH) == want
        assert dict.keys(generations[0]) >= {b"once", b"words", b"new"}
    finally:
        generations[:] = kept


def test_few_sequences(spark):
    r = random.Random(2)
    lengths = [min(4096, int(r.lognormvariate(6.2, 1.0)) + 1) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, 0, 0, n, n) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    rows = packing.pack_pieces(pieces).collect()
    assert len(rows) == 3000
    assert check_places(rows, 4096) <= 1.01 * math.ceil(sum(lengths) / 4096)


def test_only_large_and_only_small(spark):
    for lengths in ([3000] * 7 + [1500] * 7, [10] * 900, [4096] * 5, [2048, 2049, 2047]):
        pieces = spark.createDataFrame([(i, 0, 0, n, n) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
        rows = packing.pack_pieces(pieces).collect()
        assert len(rows) == len(lengths)
        check_places(rows, 4096)


def test_configurations_cover_and_fit():
    counts = {2000: 7, 1500: 9, 1000: 11, 700: 30, 4096: 2}
    got = packing.configurations(counts, 4096)
    assert all(sum(s * k for s, k in c.items()) <= 4096 for c, _ in got)
    for s, n in counts.items():
        assert sum(c.get(s, 0) * t for c, t in got) >= n
    assert sum(t for _, t in got) <= math.ceil(sum(s * n for s, n in counts.items()) / 4096) + 2


def test_groups_round_up():
    grouped = packing.group_lengths({n: 1 + n % 3 for n in range(500, 900)}, 10)
    assert len(grouped) <= 11
    assert all(n <= top for top, own in grouped.items() for n in own)
