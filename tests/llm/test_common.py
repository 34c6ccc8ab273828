import pyarrow as pa

from ticketlake.llm import common, ngram_join, packing, rules

from .frames import documents, words


def test_a_worker_forgets_what_other_operators_remembered(spark):
    docs = documents(spark, [(i, words(60, i)) for i in range(40)]).repartition(16)

    def probe(batches):
        held = 0
        for b in batches:
            held += b.num_rows and max([len(g) for _, two, _ in packing._TOKENIZERS.values() for g in two] + [len(ngram_join._HASHES)], default=0)
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64())], names=["n"])

    most = lambda: max(r.n for r in docs.mapInArrow(probe, "n long").collect())
    packing.cut_pieces(docs, packing.public_tokenizers.path("word_bpe_49k.json")).count()
    ngram_join.frequent_columns(docs, 5, sample=1)
    rules.rule_statistics(docs).agg({"n_words": "sum"}).collect()
    assert most() == 0


def test_an_operator_keeps_its_own_words():
    try:
        ngram_join.shingles(b"one two three four five six")
        common.works_for("ngram_join")
        assert len(ngram_join._HASHES) >= 6
        common.works_for("packing")
        assert not ngram_join._HASHES
    finally:
        ngram_join._HASHES.clear()
