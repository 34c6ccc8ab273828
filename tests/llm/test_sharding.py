import zlib

from pyspark.sql import functions as F

from ticketlake.llm.sharding import HashTree, Shard, shard_documents, shard_of

from .frames import documents, edge_texts, empty


def test_edges(spark):
    docs = edge_texts()
    got = [r.asDict() for r in shard_documents(documents(spark, docs)).collect()]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 24) and r["law"] == "key" for r in got)
    assert shard_documents(empty(spark)).count() == 0


def test_tree_shares_and_movement(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    tree = HashTree.uniform()
    heavy = tree.reweigh(5, 3.0)
    both = keys.select(shard_of(F.col("k"), tree).alias("a"), shard_of(F.col("k"), tree.grow()).alias("g"),
                       shard_of(F.col("k"), heavy).alias("h")).toPandas()
    share = both.a.value_counts() / len(both)
    assert len(share) == 24 and share.between(0.030, 0.054).all()
    assert ((both.g == both.a) | (both.g == 24)).all() and 0.03 < (both.g == 24).mean() < 0.05
    # shard 5 (region 0, rack 1) grew: nothing moves except into its region, inside it into its rack, and there into it
    moved = both[both.h != both.a]
    assert moved.h.isin(range(12)).all()
    assert moved[moved.a.isin(range(12))].h.isin(range(4, 8)).all()
    assert (moved[moved.a.isin(range(4, 8))].h == 5).all()
    assert abs((both.h == 5).mean() - 3 / 26) < 0.01


def test_one_shard_and_zero_weight(spark):
    one = HashTree((((Shard(0),),),))
    none = HashTree((((Shard(0), Shard(1, 0.0)),),))
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    assert {r.s for r in df.select(shard_of(F.col("k"), one).alias("s")).collect()} == {0}
    assert {r.s for r in df.select(shard_of(F.col("k"), none).alias("s")).collect()} == {0}
