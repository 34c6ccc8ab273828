"""``replicate <type>`` and ``replicate all``.

landed pages -> chain cut -> items -> transform + key check -> record cap ->
dedup -> merge into the keyed table -> counters. Messages use the parent id
from the landing partition and the issue-id selection (P4-P7, U1, JN6).
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import json_str, json_ts
from ..operators.commits import Files
from ..operators.dedup import dedup_landed
from ..operators.filters import CHUNK_DAYS, chunk_index, chunks, issue_predicate, json_field
from ..operators.merge import KeyedTable
from ..operators.keysets import restrict_to
from ..operators.runlog import append_run_log, counters_from_rows, with_overall
from ..operators.running import flush_numbers, flushes
from ..schema import REPLICATION_ORDER, spec
from ..session import scratch_path
from ..sources.objects import split_rejects, to_rows
from ..sources.pages import bad_pages, cap_records, cursor_chain, explode_items, offset_chain, parse_pages


def chained(parsed: DataFrame, object_type: str, stops: DataFrame | None = None) -> DataFrame:
    """Parsed pages without those behind the end of their run's chain."""
    chain = {"cursor": cursor_chain, "offset": offset_chain}.get(spec(object_type).pagination)
    return chain(parsed, stops=stops) if chain else parsed


def items_of(parsed: DataFrame, object_type: str) -> DataFrame:
    """Items of parsed pages in landing order."""
    keep = ("issue_id", "run_id", "page_no") if object_type == "messages" else ("run_id", "page_no")
    return explode_items(parsed, keep=[c for c in keep if c in parsed.columns])


def items_from_pages(pages: DataFrame, object_type: str) -> DataFrame:
    """Landed pages of one object type -> items in landing order."""
    spec(object_type)
    return items_of(chained(parse_pages(pages), object_type), object_type)


def selected_messages(items: DataFrame, issue_ids: DataFrame) -> DataFrame:
    """JN6: only messages whose parent issue was selected."""
    return restrict_to(items, issue_ids)


def select_items(items: DataFrame, object_type: str, issue_filter: dict | None = None,
                 issue_ids: DataFrame | None = None, account_id: str | None = None) -> DataFrame:
    """What the user asked for, before the transform: issues by P1-P2
    (``issue_filter``: arguments of ``issue_predicate``), messages by their
    parent issue, contacts by account (S6)."""
    if issue_filter and object_type == "issues":
        items = items.where(issue_predicate(json_field("item"), **issue_filter))
    if issue_ids is not None and object_type == "messages":
        items = selected_messages(items, issue_ids)
    if account_id and object_type == "contacts":
        items = items.where(json_str("item", "$.account_id") == F.lit(account_id))
    return items


def prepare_rows(items: DataFrame, object_type: str, max_records: int | None = None,
                 stamp: Column | None = None, strict: bool = False) -> DataFrame:
    """Items -> registry rows with ``reject_reason`` (NULL when valid). The
    record cap is applied in landing order before the transform (messages:
    issue order across issues)."""
    order = ("run_id", "issue_id", "page_no", "pos") if object_type == "messages" else ("run_id", "page_no", "pos")
    capped = cap_records(items, max_records, order=[c for c in order if c in items.columns])
    rows = to_rows(capped, object_type, stamp=stamp, strict=strict,
                   keep=("run_id", "page_no", "pos"))
    if object_type == "messages" and "page_no" not in rows.columns:
        rows = rows.withColumn("page_no", F.lit(0).cast("long"))
    return rows


def prepare(items: DataFrame, object_type: str, max_records: int | None = None,
            stamp: Column | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Items -> (valid rows, rejects)."""
    return split_rejects(prepare_rows(items, object_type, max_records, stamp, strict))


def replicate_rows(items: DataFrame, object_type: str, max_records: int | None = None,
                   stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(deduplicated rows, counters) without writing - the relation a merge
    into an empty table would produce."""
    s = spec(object_type)
    rows = prepare_rows(items, object_type, max_records, stamp)
    valid, _ = split_rejects(rows)
    kept = dedup_landed(valid, s.keys)
    return kept, counters_from_rows(object_type, s.table, rows, s.keys, batch_columns(object_type, rows))


def batch_columns(object_type: str, rows: DataFrame) -> list:
    """A batch is a landed page; message pages are per parent issue."""
    cols = ("issue_id", "run_id", "page_no") if object_type == "messages" else ("run_id", "page_no")
    return [c for c in cols if c in rows.columns]


COUNTERS = ("object_type string, table_name string, total_processed bigint, total_errors bigint, "
            "total_batches bigint, rows_kept bigint")


def _place(df: DataFrame, types: dict[str, str]) -> list[Column]:
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]


def store_rejects(rejects: DataFrame, object_type: str, path: str) -> None:
    """Rejected records with their reason and place, appended. The table
    exists after every run, also when nothing was rejected."""
    place = _place(rejects, {"run_id": "string", "page_no": "long", "pos": "long"})
    rejects.select(F.lit(object_type).alias("object_type"), *place, "reject_reason", F.to_json("data").alias("record")) \
           .write.mode("append").parquet(path)


def store_bad_pages(parsed: DataFrame, object_type: str, path: str) -> None:
    """Pages that do not parse, as landed, appended (none: an empty table)."""
    bad = bad_pages(parsed)
    bad.select(F.lit(object_type).alias("object_type"), *_place(bad, {"run_id": "string", "page_no": "long"}), "body") \
       .write.mode("append").parquet(path)


#: Records of an API page, of a batch, and of a write to the warehouse.
API_BATCH, BATCH, WAREHOUSE_BATCH = 100, 1000, 500


def flush_size(batch_size: int = BATCH, save_each_page: bool = False, api_batch: int = API_BATCH,
               warehouse_batch: int = WAREHOUSE_BATCH) -> int:
    """Records of a flush. A smaller ``batch_size`` holds, a larger one
    does not; ``save_each_page`` flushes as many as an API page holds."""
    return api_batch if save_each_page else min(batch_size, warehouse_batch)


def flushed(valid: DataFrame, object_type: str, size: int) -> DataFrame:
    """Valid rows with their ``flush_no``."""
    run = "run_id" if "run_id" in valid.columns else "page_no"
    return flush_numbers(valid, size, run, [c for c in ("issue_id", "page_no") if c in batch_columns(object_type, valid)])


def stored_pages(pages: DataFrame, path: str) -> DataFrame:
    """Parsed pages, written to ``path`` and read back: their place and what the
    envelope holds."""
    place = [c for c in ("issue_id", "run_id", "page_no") if c in pages.columns]
    parsed = parse_pages(pages.select(*place, "body"))
    parsed.write.parquet(path, compression="zstd")
    return pages.sparkSession.read.schema(parsed.schema).parquet(path)


def replicate_object(spark: SparkSession, pages: DataFrame, object_type: str, table: KeyedTable,
                     max_records: int | None = None, strict: bool = False, issue_filter: dict | None = None,
                     issue_ids: DataFrame | None = None, account_id: str | None = None,
                     rejects_path: str | None = None, bad_pages_path: str | None = None,
                     flush: int | None = None, item_filter: Column | None = None) -> DataFrame:
    """E1/E2 with the write: merge into ``table`` and return counters.

    A batch is a landed page: per key the later run wins, then the later page,
    then the first item of the page, as in the stream. With ``flush`` a batch
    is so many records (I5, see ``flush_size``), whatever page they lie on:
    the later flush wins, inside it the first record. Stream tables settle by
    page on read and take no ``flush``.

    Rejected records and bad pages are counted as errors and stored where a
    path is given; nothing else of their run is lost. Pages are parsed once,
    into a scratch table: a task reads a split of it, whose size is fixed, while
    a cached partition would hold the items of all pages of one input split.
    """
    s = spec(object_type)
    if flush and table.landing:
        raise ValueError("a stream table has landed pages as batches")
    scratch = scratch_path(spark, f"parsed-{object_type}")
    try:
        parsed = stored_pages(pages, scratch)
        items = select_items(items_of(chained(parsed, object_type), object_type), object_type, issue_filter, issue_ids, account_id)
        if item_filter is not None:
            items = items.where(item_filter)
        rows = prepare_rows(items, object_type, max_records, F.current_timestamp(), strict)
        valid, rejects = split_rejects(rows)
        if flush:
            stats = table.upsert(flushed(valid, object_type, flush), keep="flushed")
        else:
            stats = (table.upsert_landed if table.landing else partial(table.upsert, keep="landed"))(valid)
        # a row for each page, then one: what was rejected, and the batches
        each = rows.groupBy(*batch_columns(object_type, rows)).agg(
            F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("ok"), F.count("reject_reason").alias("rejected"))
        n = each.agg(F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), F.count(F.when(F.col("ok") > 0, 1)).alias("pages")).first()
        n_batches = n["pages"]
        if flush:
            n_batches = flushes(valid, flush, "run_id" if "run_id" in valid.columns else "page_no").first()["flushes"]
        n_bad = parsed.where("bad").count()
        if rejects_path:
            store_rejects(rejects, object_type, rejects_path)
        if bad_pages_path:
            store_bad_pages(parsed, object_type, bad_pages_path)
    finally:
        Files(spark).delete(scratch)
    return spark.createDataFrame(
        [(object_type, s.table, int(stats["rows_in"]), int(n["rejected"] + n_bad), int(n_batches), int(stats["rows_kept"]))], COUNTERS)


def replicate_all(spark: SparkSession, pages_by_type: dict, tables: dict, log_path: str | None = None,
                  at_once: int = 1, **options) -> DataFrame:
    """Every type in registry order; one failure does not stop the rest
    (it counts one error, and its text is in ``error``). The counters go to
    the run log where ``log_path`` is given (I10).

    ``at_once``: so many objects are written at a time, each from a thread and
    in a scheduler pool of its own, so that the tail of one object's stages
    does not keep the cluster idle. Messages wait for issues, whose table
    selects them; other objects do not depend on each other."""
    wanted = [t for t in REPLICATION_ORDER if t in pages_by_type]
    issues_done = threading.Event()
    if "issues" not in wanted:
        issues_done.set()

    def one(t: str) -> tuple[DataFrame, str | None]:
        if at_once > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"replicate-{t}")
        try:
            if t == "messages":
                issues_done.wait()
            return replicate_object(spark, pages_by_type[t], t, tables[t], **options), None
        except Exception as e:  # noqa: BLE001 - one object's failure is its own
            text = str(e).splitlines()[0][:500] if str(e) else type(e).__name__
            return spark.createDataFrame([(t, spec(t).table, 0, 1, 0, 0)], COUNTERS), text
        finally:
            if t == "issues":
                issues_done.set()
            if at_once > 1:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, at_once)) as threads:               # in order: issues begin before messages
        done = list(threads.map(inheritable_thread_target(spark)(one), wanted)) if at_once > 1 else [one(t) for t in wanted]
    res = with_overall(reduce(DataFrame.unionByName, [c for c, _ in done]))
    text = F.lit(None).cast("string")
    for t, (_, e) in zip(wanted, done, strict=True):
        if e is not None:
            text = F.when(F.col("object_type") == t, F.lit(e)).otherwise(text)
    res = res.withColumn("error", text)
    if log_path:
        append_run_log(res, log_path, "replicate all")
    return res


CHUNK_LOG = ("job string, chunk_no long, chunk_start timestamp, chunk_end timestamp, status string, total_processed bigint, "
             "total_errors bigint, error string, run_at timestamp")


def finished_chunks(spark: SparkSession, log_path: str, job: str) -> set[int]:
    """The chunks that some run of ``job`` has finished (a row for each chunk)."""
    if not Files(spark).exists(log_path):
        return set()
    log = spark.read.schema(CHUNK_LOG).parquet(log_path)
    return {r["chunk_no"] for r in log.where((F.col("job") == job) & (F.col("status") == "done")).select("chunk_no").distinct().collect()}


def replicate_chunked(spark: SparkSession, fetch: Callable[[int], DataFrame], table: KeyedTable, start: dt.datetime, end: dt.datetime,
                      log_path: str, job: str, days: int = CHUNK_DAYS, **options) -> DataFrame:
    """P3 + E1 + I10: issues of ``[start, end]`` by ``modified_at``, chunk by
    chunk. ``fetch(chunk_no)`` gives the landed pages of a chunk (its own
    landing folder, so a chunk reads nothing else).

    The run log is the work list: a chunk that is logged as done is skipped, a
    failed one is logged with its error and does not stop the others. Running
    the command again does what is left. Returns the log of the job."""
    work = chunks(spark, start, end, days).orderBy("chunk_no").collect()      # one row for each chunk of time
    done = finished_chunks(spark, log_path, job)
    for c in work:
        if c["chunk_no"] in done:
            continue
        try:
            # half-open, so a record at a border belongs to one chunk
            own = chunk_index(json_ts(F.col("item"), "$.modified_at"), start, end, days) == F.lit(c["chunk_no"])
            got = replicate_object(spark, fetch(c["chunk_no"]), "issues", table, item_filter=own, **options).first()
            row = ("done", got["total_processed"], got["total_errors"], None)
        except Exception as e:  # noqa: BLE001 - one chunk's failure is its own
            row = ("failed", 0, 1, str(e).splitlines()[0][:500] if str(e) else type(e).__name__)
        logged = [(job, c["chunk_no"], c["chunk_start"], c["chunk_end"], *row)]
        spark.createDataFrame(logged, CHUNK_LOG.rpartition(", run_at")[0]).withColumn("run_at", F.current_timestamp()) \
             .write.mode("append").parquet(log_path)
    return spark.read.schema(CHUNK_LOG).parquet(log_path).where(F.col("job") == job)
