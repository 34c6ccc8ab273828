"""Benchmark decontamination over a positional inverted index.

``build_index`` cuts the corpus into index shards (some 130,000 tokens each)
and stores, shard by shard, every term with the sorted list of its positions.
The index is partitioned by document, so building it moves no token across
the network, and a phrase never crosses a shard.

A phrase query is answered inside a shard. The lists of its terms are taken
from the rarest on: the first gives candidate starts (position minus the
term's offset in the phrase), each further list is intersected with them.
All phrases of a block of test items are intersected together with array
operations. ``near_matches`` asks the same index for terms close together.

Test items are broadcast in blocks of bounded size, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, stored, table, works_for

#: Words of a window, tokens of an index shard, bytes of test text in a block.
WINDOW, SHARD_TOKENS, BLOCK_BYTES = 10, 1 << 17, 8 << 20

INDEX_SCHEMA = ("shard long, doc_ids array<long>, n_words array<int>, terms binary, counts binary, "
                "postings binary")

# Lower-cases A-Z and turns every byte that is no word byte into a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def index_words(b: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return b.translate(_WORD_BYTES).split()


def _shard_row(shard: int, docs: list, sizes: list[int], words: list[bytes]) -> dict:
    terms = sorted(set(words))
    place = dict(zip(terms, range(len(terms)), strict=True))
    ids = np.fromiter(map(place.__getitem__, words), dtype=np.int32, count=len(words))
    # one unused position after each document: no phrase runs into the next
    positions = np.arange(len(words), dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.argsort(ids, kind="stable")
    return {"shard": shard, "doc_ids": docs, "n_words": sizes, "terms": b"\n".join(terms),
            "counts": np.bincount(ids, minlength=len(terms)).astype(np.int32).tobytes(),
            "postings": positions[order].tobytes()}


def build_index(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Index rows (INDEX_SCHEMA), one for each shard. Every document is in
    exactly one, also those without words."""
    schema = pa.schema([("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
                        ("terms", pa.binary()), ("counts", pa.binary()), ("postings", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("decontam")
        shard = TaskContext.get().partitionId() << 32
        ids, sizes, words = [], [], []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard_row(shard, ids, sizes, words)], schema=schema)

        for batch in batches:
            for doc_id, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = index_words(b.as_py())
                ids.append(doc_id), sizes.append(len(own))
                words += own
                if len(words) + len(ids) >= shard_tokens:
                    yield flush()
                    shard += 1
                    ids, sizes, words = [], [], []
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(
        run, INDEX_SCHEMA)


class ShardIndex:
    """One index row, opened for searching."""

    def __init__(self, doc_ids, n_words, terms: bytes, counts: bytes, postings: bytes):
        self.doc_ids = doc_ids
        self.sizes = np.asarray(n_words, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes + 1)])        # a document's first position
        self.span = int(self.first[-1]) + 1
        names = terms.split(b"\n") if terms else []
        self.term = dict(zip(names, range(len(names)), strict=True))
        self.counts = np.frombuffer(counts, dtype=np.int32).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self.postings = np.frombuffer(postings, dtype=np.int32).astype(np.int64)
        # (term, position) as one ascending number: membership is a binary search
        self.keys = np.repeat(np.arange(len(names)), self.counts) * self.span + self.postings

    def local(self, terms: list[bytes]) -> np.ndarray:
        return np.array([self.term.get(t, -1) for t in terms], dtype=np.int64)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * self.span + position
        i = np.searchsorted(self.keys, key)
        found = np.zeros(len(key), dtype=bool)
        inside = (i < len(self.keys)) & (position >= 0) & (position < self.span)
        found[inside] = self.keys[i[inside]] == key[inside]
        return found

    def rarest_first(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``phrases`` (local terms, -2 past the end) whose terms all
        occur, and for these the columns from the rarest term on."""
        alive = np.flatnonzero((phrases != -1).all(axis=1))
        p = phrases[alive]
        n = np.where(p >= 0, self.counts[np.maximum(p, 0)], np.iinfo(np.int64).max)
        return alive, np.argsort(n, axis=1, kind="stable")

    def starts(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All exact occurrences: (phrase row, first position)."""
        if not len(phrases) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        alive, order = self.rarest_first(phrases)
        if not len(alive):
            return alive, alive
        first = phrases[alive, order[:, 0]]
        n = self.counts[first]
        which = np.repeat(np.arange(len(alive)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.postings[self.at[first][which] + nth] - order[which, 0]
        for k in range(1, phrases.shape[1]):
            col = order[which, k]
            term = phrases[alive[which], col]
            ok = (term < 0) | self.has(np.maximum(term, 0), start + col)
            which, start = which[ok], start[ok]
        return alive[which], start

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the rarest term that have every other term within
        ``slop`` positions, in the same document."""
        if not len(terms) or (terms < 0).any():
            return np.zeros(0, np.int64)
        terms = terms[np.argsort(self.counts[terms], kind="stable")]
        at = self.postings[self.at[terms[0]]:self.at[terms[0] + 1]]
        doc = np.searchsorted(self.first, at, side="right") - 1
        low, high = np.maximum(at - slop, self.first[doc]), np.minimum(at + slop, self.first[doc + 1] - 2)
        for t in terms[1:]:
            i = np.searchsorted(self.keys, t * self.span + low)
            ok = i < len(self.keys)
            ok[ok] = self.keys[i[ok]] <= t * self.span + high[ok]
            at, low, high = at[ok], low[ok], high[ok]
        return at


def item_windows(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Windows of consecutive words; a shorter item, if not empty, is one."""
    if len(words) < window:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]


def query_block(items: list[tuple[str, bytes]], window: int = WINDOW) -> dict:
    """The windows of a block of items as one matrix over the block's terms."""
    of: dict[tuple[bytes, ...], set[int]] = {}
    for i, (_, b) in enumerate(items):
        for w in item_windows(index_words(b), window):
            of.setdefault(w, set()).add(i)
    terms = sorted({t for w in of for t in w})
    place = {t: i for i, t in enumerate(terms)}
    matrix = np.full((len(of), window), -2, dtype=np.int64)
    for row, w in enumerate(of):
        matrix[row, :len(w)] = [place[t] for t in w]
    return {"terms": terms, "matrix": matrix, "items": [sorted(v) for v in of.values()],
            "ids": [i for i, _ in items], "sizes": (matrix >= 0).sum(axis=1)}


def shard_hits(index: ShardIndex, block: dict) -> list[tuple[int, list[int], list[str]]]:
    """(document's place in the shard, hit word places, item ids)."""
    local = np.append(index.local(block["terms"]), -2)                # index -2 and -1: past the end
    matrix = np.where(block["matrix"] >= 0, local[np.maximum(block["matrix"], 0)], -2)
    row, start = index.starts(matrix)
    if not len(row):
        return []
    doc = np.searchsorted(index.first, start, side="right") - 1
    out = []
    for d in np.unique(doc):
        mine = doc == d
        hit = np.zeros(int(index.sizes[d]) + 1, dtype=np.int64)
        begin = start[mine] - index.first[d]
        np.add.at(hit, begin, 1)
        np.add.at(hit, begin + block["sizes"][row[mine]], -1)
        items = {block["ids"][i] for r in np.unique(row[mine]) for i in block["items"][r]}
        out.append((int(d), np.flatnonzero(np.cumsum(hit)[:-1] > 0).tolist(), sorted(items)))
    return out


def _open(batch: pa.RecordBatch) -> Iterator[tuple[int, ShardIndex]]:
    for i in range(batch.num_rows):
        r = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
        yield r["shard"], ShardIndex(r["doc_ids"], r["n_words"], r["terms"], r["counts"], r["postings"])


def phrase_hits(index: DataFrame, block: dict) -> DataFrame:
    """One row for each document with an occurrence of a window of ``block``."""
    sent = index.sparkSession.sparkContext.broadcast(block)
    schema = pa.schema([("shard", pa.int64()), ("place", pa.int32()), ("hits", pa.list_(pa.int32())),
                        ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("decontam")
        for batch in batches:
            for shard, opened in _open(batch):
                rows = [{"shard": shard, "place": d, "hits": h, "items": i}
                        for d, h, i in shard_hits(opened, sent.value)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return index.mapInArrow(run, "shard long, place int, hits array<int>, items array<string>")


def near_matches(index: DataFrame, queries: dict[str, list[str]], slop: int) -> DataFrame:
    """Proximity search: ``query, doc_id, position`` for every position of a
    query's rarest term (of the index shard) that has all its other terms
    within ``slop`` words. A term named twice counts once."""
    asked = {q: sorted({w for t in ts for w in index_words(t.encode())}) for q, ts in queries.items()}
    schema = pa.schema([("query", pa.string()), ("doc_id", pa.int64()), ("position", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("decontam")
        for batch in batches:
            for _, opened in _open(batch):
                rows = []
                for q, terms in asked.items():
                    at = opened.near(opened.local(terms), slop)
                    doc = np.searchsorted(opened.first, at, side="right") - 1
                    rows += [{"query": q, "doc_id": opened.doc_ids[d], "position": int(p - opened.first[d])}
                             for d, p in zip(doc, at, strict=True)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return index.mapInArrow(run, "query string, doc_id long, position int")


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The test items in blocks of ``block_bytes`` (one longer item: a block)."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), doc_bytes().alias("b"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        block.append((r["i"], bytes(r["b"])))
        size += len(r["b"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document with ``n_words, n_hit, n_items, items_sha256,
    contaminated`` and ``items`` (sorted ids of items with a window in it).

    NULL or empty texts have no words; an item without words has no window.
    Repeated rows (also of one doc_id) are judged one by one; items sharing an
    item_id count once; a NULL item_id is the empty id. Extra columns are not
    read. An empty benchmark hits nothing, an empty corpus gives no rows.
    """
    index = stored(build_index(docs), "positions")
    hits = None
    for items in item_blocks(benchmark):
        part = phrase_hits(index, query_block(items, window))
        hits = part if hits is None else hits.unionByName(part)
    rows = (index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d"))
            .select("shard", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words")))
    if hits is None:
        found = rows.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    else:
        hits = (hits.groupBy("shard", "place")               # one row for each block of items at most
                .agg(F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
        found = (rows.join(hits, ["shard", "place"], "left")
                 .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                               "items": F.coalesce("items", F.array().cast("array<string>"))}))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items")


def op2(spark, sf_dir):
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("items")


OP2_SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s, w FROM bw WHERE len(w) > 0),
bwin AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM win),
ks AS (SELECT DISTINCT k FROM bwin),
dpos AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS s, w FROM dw, ks WHERE len(w) >= k),
dwin AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM dpos),
m AS (SELECT d.doc_id, d.k, d.s, b.item_id FROM dwin d JOIN bwin b ON d.k = b.k AND d.g = b.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
