"""ST1: landed page files -> micro-batches -> keyed upsert.

``readStream`` over the landing folder (whole-file text, one file per page),
``foreachBatch`` merges each micro-batch into the keyed table, and the
checkpoint makes the run restartable. The file source hands files over in
modification-time order, which is not page order when pages are landed by a
parallel job, so the merge is order-aware: the table keeps each row's landing
position and the row landed last wins (a later page beats an earlier one, as
a later flush does in the batch path). A replayed micro-batch after a failure
therefore writes the same result (idempotent). Rejected records and bad pages
of a micro-batch are appended to their tables where paths are given.

A run's chain may end in one trigger and its later pages come in another, or
have come before. The stream therefore keeps a state for each run (the first
stop page and the pages seen; a streaming minimum and count in Spark's state
store, under the checkpoint). A trigger gets the state of the runs that it
touches together with its pages: pages behind a known stop are not written,
and the stops, where there are any, are committed with the rows as cuts, which
take effect on rows written before. Whatever the order of arrival, the table reads as the batch
path would have written it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import KeyedTable
from ..plans.replicate import chained, items_of, prepare, store_bad_pages, store_rejects
from ..schema import spec
from ..sources.pages import chain_stops, parse_pages

#: Landed files of a trigger for each task and shuffle partition of the stream.
FILES_A_TASK = 16
PAGE_FILE = r"page_no=(\d+)"
RUN_DIR = r"run_id=([^/]+)"
PARTITIONS = "spark.sql.shuffle.partitions"
#: Tasks at most in which Spark lists the landed folders when a stream is made (its default: one for each).
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def page_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming page bodies with ``run_id``/``page_no`` taken from the path."""
    raw = (spark.readStream.format("text").option("wholetext", True)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("recursiveFileLookup", True).load(root))
    path = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(path, RUN_DIR, 1).alias("run_id"),
                      F.regexp_extract(path, PAGE_FILE, 1).cast("long").alias("page_no"),
                      F.col("value").alias("body"))


def with_chain_state(pages: DataFrame, object_type: str) -> DataFrame:
    """Streaming pages (run_id, page_no, body, state) and, for every run that
    a trigger touches, a row with its state so far (and no body)."""
    s = spec(object_type)
    none = F.lit(None)
    state = F.struct(none.cast("long").alias("stop_page"), none.cast("long").alias("seen_pages"))
    own = pages.select("run_id", "page_no", "body", F.when(F.lit(False), state).alias("state"))
    if s.pagination == "none":
        return own
    runs = chain_stops(parse_pages(pages).drop("data", "bad_body"), s.pagination)
    return own.unionByName(runs.select("run_id", none.cast("long").alias("page_no"), none.cast("string").alias("body"),
                                       F.struct("stop_page", "seen_pages").alias("state")))


def stream_upsert(spark: SparkSession, root: str, object_type: str, table: KeyedTable,
                  checkpoint: str, max_files_per_trigger: int = 100, available_now: bool = True,
                  rejects_path: str | None = None, bad_pages_path: str | None = None):
    """Start the stream; with ``available_now`` it drains the folder and stops."""
    if not table.landing:
        raise ValueError("stream tables must be created with landing=True")
    table.create()

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                      # also keeps the state from being computed again
        stops = None
        if spec(object_type).pagination != "none":
            ended = batch.where("state.stop_page IS NOT NULL").select("run_id", "state.stop_page")
            # most triggers touch no run that has ended: then there is nothing to cut or to commit
            if ended.agg(F.count(F.lit(1)).alias("n")).first()["n"]:
                stops = ended
        parsed = parse_pages(batch.where("state IS NULL").drop("state"))
        if stops is not None or rejects_path or bad_pages_path:
            parsed = parsed.persist()                # read again by each
        try:
            items = items_of(parsed if stops is None else chained(parsed, object_type, stops), object_type)
            valid, rejects = prepare(items, object_type, stamp=F.current_timestamp())
            table.upsert_landed(valid, cuts=stops, buckets=int(batch.sparkSession.conf.get(PARTITIONS)))
            if rejects_path:
                store_rejects(rejects, object_type, rejects_path)
            if bad_pages_path:
                store_bad_pages(parsed, object_type, bad_pages_path)
        finally:
            parsed.unpersist()
            batch.unpersist()

    # the stream takes its settings at its start; a restart keeps its checkpoint's partitions
    own = {PARTITIONS: -(-max_files_per_trigger // FILES_A_TASK), LISTING: spark.sparkContext.defaultParallelism}
    session = {k: spark.conf.get(k) for k in own}
    for k, most in own.items():
        spark.conf.set(k, str(min(int(session[k]), most)))
    try:
        pages = with_chain_state(page_stream(spark, root, max_files_per_trigger), object_type)
        w = pages.writeStream.outputMode("update").foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()
    finally:
        for k, v in session.items():
            spark.conf.set(k, v)
