"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams (shingles) columns of a 0/1 matrix A; the
overlap of two documents is an entry of A times its transpose. Only entries
that can reach the similarity bound are ever accumulated:

* Rows with equal sets are one class; the product runs over classes.
* Columns are ordered from rare to frequent (frequencies of a proportional
  sample, then the hash). Two classes with a Jaccard similarity of at least
  s share a column among the first ``n - ceil(s n) + 1`` of either, so the
  product is taken over these leading columns only.
* In a column, a pair is discarded if its sizes, or the places of the column
  in both rows, leave too little room for the overlap that the sizes demand.
* For the pairs that are left the overlap of all leading columns is
  accumulated; with what the rest can add at most it must reach that overlap
  too. Pairs that do are counted exactly on the whole sets.

Groups of many near copies are not expanded into pairs. First each column only
relates its members to one pivot; classes that prove linked become one
component. The second product skips pairs inside a component. Long columns
are multiplied block by block, so no task holds a whole long column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, most_frequent, remembers, stored, table, works_for

#: Words of a shingle; similarity in hundredths.
WORDS, SIMILAR = 5, 80
#: One document in SAMPLE is counted to order columns; so many of the most
#: frequent columns are known to be frequent (any order gives whole results).
SAMPLE, FREQUENT = 32, 1 << 20
#: Members of a column multiplied at once.
BLOCK = 2048
#: Bits of the set of classes whose texts are read again (a superset).
BITMAP = 26


class WordHashes(dict):
    """word -> 64-bit hash, for a bounded number of words at a time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHashes()
remembers("ngram_join", _HASHES.clear)


def shingles(b: bytes, words: int = WORDS) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles of a text. Fewer words
    than a shingle has are one shingle, no words none."""
    w = b.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, w), dtype=np.uint64, count=len(w))
    k = min(words, len(w))
    n = len(w) - k + 1
    z = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        z = (z * np.uint64(0x9E3779B97F4A7C15)) ^ h[i:i + n]
        z *= np.uint64(0xFF51AFD7ED558CCD)
        z ^= z >> np.uint64(31)
    return np.unique(z)


def least_overlap(n: int, similar: int = SIMILAR) -> int:
    """Overlap that a set of ``n`` has with any set it is similar to."""
    return -(-similar * n // 100)


def _sets(docs: DataFrame, order: tuple[np.ndarray, np.ndarray], words: int, similar: int) -> DataFrame:
    """``doc_id, n, digest`` (of the set) and ``lead``, the leading columns."""
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("ngram_join")
        known, counts = sent.value
        for batch in batches:
            n, digest, lead = [], [], []
            for x in batch.column(1):
                s = shingles(x.as_py(), words)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s) and len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    s = s[np.argsort(np.where(known[i] == s, counts[i], 0), kind="stable")]
                lead.append(s[:len(s) - least_overlap(len(s), similar) + 1].view(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(lead, pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "lead"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(
        run, "doc_id long, n long, digest binary, lead array<long>")


def frequent_columns(docs: DataFrame, words: int, sample: int = SAMPLE, most: int = FREQUENT):
    """(ascending hashes, documents of the sample) of the columns that the
    sample holds twice or more, ``most`` at most. Only the order of columns
    depends on it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("ngram_join")
        for batch in batches:
            found = [shingles(x.as_py(), words) for x in batch.column(0)]
            flat = np.concatenate([*found, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["h"])

    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0).select("text").distinct()
    counted = stored(chosen.select(doc_bytes().alias("b")).mapInArrow(run, "h long").groupBy("h")
                     .agg(F.count(F.lit(1)).alias("c")).where("c >= 2"), "frequent-shingles")
    counted = most_frequent(counted, "c", most).toPandas()
    h = counted["h"].to_numpy(dtype=np.int64).view(np.uint64) if len(counted) else np.zeros(0, np.uint64)
    at = np.argsort(h)
    return h[at], counted["c"].to_numpy(dtype=np.int64)[at] if len(counted) else np.zeros(0, np.int64)


def _need(n_a, n_b, similar: int):
    """Overlap two sets of these sizes must have: o / (a + b - o) >= s."""
    return F.ceil((n_a + n_b) * F.lit(similar) / F.lit(100 + similar)).cast("long")


def star_pairs(members: DataFrame, similar: int) -> DataFrame:
    """(a, b, n_a, n_b): in every column the member with the fewest rarer
    columns is the pivot; the pairs with it that pass the bounds."""
    key = F.shiftleft(F.col("pos").cast("long"), 40) + F.col("cid").bitwiseAND((1 << 40) - 1)
    keyed = members.withColumn("key", key)
    pivots = keyed.groupBy("h").agg(F.min_by("cid", "key").alias("a"), F.min_by("n", "key").alias("n_a"),
                                    F.min_by("pos", "key").alias("pos_a"))
    need = _need(F.col("n_a"), F.col("n"), similar)
    pairs = (members.join(pivots, "h").where(F.col("cid") != F.col("a"))
             .where((F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * similar)
                    & (F.least(F.col("n") - F.col("pos"), F.col("n_a") - F.col("pos_a")) >= need)))
    return pairs.select("a", F.col("cid").alias("b"), "n_a", F.col("n").alias("n_b")).distinct()


def reaching(pairs: DataFrame, classes: DataFrame, similar: int) -> DataFrame:
    """Pairs whose overlap in the leading columns, and the most that the rest
    can add, reaches the overlap asked for. Of two rows one's leading part
    ends first; what it has behind that end is all that can still be shared."""
    lead = classes.select("cid", "lead")
    own = (pairs.join(lead.withColumnsRenamed({"cid": "b", "lead": "lead_b"}), "b")
           .join(lead.withColumnsRenamed({"cid": "a", "lead": "lead_a"}), "a"))
    rest = F.greatest(F.col("n_a") - F.size("lead_a"), F.col("n_b") - F.size("lead_b"))
    return own.where(F.size(F.array_intersect("lead_a", "lead_b")) + rest
                     >= _need(F.col("n_a"), F.col("n_b"), similar)).select("a", "b")


def _column_pairs(similar: int):
    """Arrow function over rows (h, ba, bb, half, cid, n, pos, comp) sorted by
    (h, ba, bb): pairs of a column block that pass the bounds."""
    names = ["a", "b", "n_a", "n_b"]

    def product(t: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        group = (t["h"][1:] != t["h"][:-1]) | (t["ba"][1:] != t["ba"][:-1]) | (t["bb"][1:] != t["bb"][:-1])
        starts = np.concatenate([[0], np.flatnonzero(group) + 1])
        ends = np.append(starts[1:], len(t["h"]))
        last = np.repeat(ends, ends - starts)
        row, step = np.arange(len(t["h"])), 1
        while len(row):                       # every row with the one ``step`` rows below it
            row = row[row + step < last[row]]
            i, j = row, row + step
            n_i, n_j = t["n"][i], t["n"][j]
            need = -(-(n_i + n_j) * similar // (100 + similar))
            ok = ((t["comp"][i] != t["comp"][j])
                  & ((t["ba"][i] == t["bb"][i]) | (t["half"][i] != t["half"][j]))
                  & (np.minimum(n_i, n_j) * 100 >= np.maximum(n_i, n_j) * similar)
                  & (np.minimum(n_i - t["pos"][i], n_j - t["pos"][j]) >= need))
            if ok.any():
                i, j = i[ok], j[ok]
                swap = t["cid"][i] > t["cid"][j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t[c][x]) for c, x in (("cid", i), ("cid", j), ("n", i), ("n", j))], names=names)
            step += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("ngram_join")
        held = None
        for batch in batches:
            t = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names}
            if held is not None:
                t = {k: np.concatenate([held[k], v]) for k, v in t.items()}
            if not len(t["h"]):
                continue
            same = (t["h"] == t["h"][-1]) & (t["ba"] == t["ba"][-1]) & (t["bb"] == t["bb"][-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = {k: v[cut:] for k, v in t.items()}          # the last block may go on: 2 x BLOCK rows at most
            if cut:
                yield from product({k: v[:cut] for k, v in t.items()})
        if held is not None and len(held["h"]):
            yield from product(held)

    return run


def block_pairs(members: DataFrame, labels: DataFrame, similar: int, block: int = BLOCK) -> DataFrame:
    """(a, b, n_a, n_b) of different components that pass the bounds in some
    column; columns in blocks of about ``block`` members."""
    m = members.join(labels, "cid", "left").withColumn("comp", F.coalesce("label", "cid")).drop("label")
    open_ = m.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
             .where("lo < hi").select("h", "size")
    m = m.join(open_, "h")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    m = m.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    m = m.select("h", F.least("own", "other").alias("ba"), F.greatest("own", "other").alias("bb"),
                 (F.col("own") > F.col("other")).cast("int").alias("half"), "cid", "n", F.col("pos").cast("long").alias("pos"), "comp")
    return (m.repartition("h", "ba", "bb").sortWithinPartitions("h", "ba", "bb")
            .mapInArrow(_column_pairs(similar), "a long, b long, n_a long, n_b long").distinct())


def _bitmap(digests: DataFrame) -> np.ndarray:
    """2^BITMAP bits, set for the first bits of every digest: at most 8 MB."""
    place = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long").bitwiseAND((1 << BITMAP) - 1)
    words = (digests.select(place.alias("p")).select(F.shiftright("p", 3).alias("w"),
             F.expr("1 << CAST(p & 7 AS INT)").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(1 << (BITMAP - 3), dtype=np.uint8)
    out[words["w"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.uint8)
    return out


def whole_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, set`` (ascending hashes as bytes) for the classes in ``wanted``
    (cid), from their texts."""
    wanted = wanted.distinct().join(classes.select("cid", "digest"), "cid")
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("ngram_join")
        bits = sent.value
        for batch in batches:
            digest, sets = [], []
            for x in batch.column(0):
                s = shingles(x.as_py(), words)
                if len(s):
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    p = int.from_bytes(d[:4], "big") & ((1 << BITMAP) - 1)
                    if bits[p >> 3] >> (p & 7) & 1:
                        digest.append(d), sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(sets, pa.binary())], names=["digest", "set"])

    found = docs.select(doc_bytes().alias("b")).mapInArrow(run, "digest binary, set binary")
    return found.groupBy("digest").agg(F.first("set").alias("set")).join(wanted, "digest").select("cid", "set")


def verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("ngram_join")
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_py(), dtype=np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_py(), dtype=np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= similar * (len(x) + len(y) - common):
                    a.append(batch.column(0)[i].as_py()), b.append(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    own = pairs.select("a", "b").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
    own = own.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a")
    return own.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``cid, label``: for every class of a link the smallest class it reaches.
    Large-star and small-star steps until nothing changes."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        near = both.join(low, "a")
        if large:
            return near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        return near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.where("a <> m").select("a", F.col("m").alias("b"))).distinct()

    edges = stored(links.select("a", "b").where("a <> b").distinct(), name)
    sign = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    before = sign(edges)
    while before[0]:
        edges = stored(star(star(edges, True), False), name)
        now = sign(edges)
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("label"))


def linked_documents(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_shingles, component_id`` (smallest
    doc_id reachable by links, itself included) and ``class_size`` (rows with
    an equal set).

    NULL and empty texts have no shingles and link with nothing; rows with
    equal sets link. Repeated rows and rows of one doc_id are rows of their
    own. A NULL doc_id is never the smallest of its component. Extra columns
    are not read; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(_sets(docs, frequent_columns(docs, words), words, similar), "shingle-sets")
    classes = (rows.where("n > 0").groupBy("digest")
               .agg(F.min("doc_id").alias("first_doc"), F.first("n").alias("n"), F.first("lead").alias("lead"),
                    F.count(F.lit(1)).alias("class_size"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = stored(classes, "shingle-classes")
    columns = classes.select("cid", "n", F.posexplode("lead").alias("pos", "h"))
    shared = columns.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    members = stored(columns.join(shared, "h"), "shared-columns")

    star = stored(reaching(star_pairs(members, similar), classes, similar), "star-pairs")
    sets = stored(whole_sets(docs, classes, star.select(F.col("a").alias("cid")).union(star.select("b")), words), "star-sets")
    links = stored(verified(star, sets, similar), "star-links")
    labels = stored(components(links), "star-labels")

    more = stored(reaching(block_pairs(members, labels, similar), classes, similar), "block-pairs")
    sets = stored(whole_sets(docs, classes, more.select(F.col("a").alias("cid")).union(more.select("b")), words), "block-sets")
    links = links.union(verified(more, sets, similar))
    labels = stored(components(links), "labels")

    named = classes.select("cid", "digest", "first_doc", "class_size").join(labels, "cid", "left") \
        .withColumn("label", F.coalesce("label", "cid"))
    smallest = named.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    of = named.join(smallest, "label").select("digest", "component_id", "class_size")
    return rows.select("doc_id", "n", "digest").join(of, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def op9(spark, sf_dir):
    return linked_documents(table(spark, sf_dir, "documents"))
