"""Landed API pages.

An API response is landed as one JSON file per page under
``<root>/run_id=<run>/page_no=<n>/`` (for messages ``issue_id=<id>/``), so
Spark's partition discovery yields ``run_id``/``page_no`` without parsing file
names. Pages are parsed with ``from_json`` into ``array<variant>`` items.

The chain cuts do not sort a run's pages: the first stopping page of each run
is a ``min`` aggregate over narrow rows, and the pages behind it are
anti-joined by (run, page). A run holding a third of all pages therefore never
lands in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import unwrap
from ..operators.running import running_total
from ..schema import PAGE_SCHEMA


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Every landed page file as one row ``(body, <partition columns>)``."""
    df = spark.read.format("text").option("wholetext", True).load(root)
    return df.withColumnRenamed("value", "body")


#: Column that catches a body that does not parse.
_CORRUPT = "_corrupt"


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Envelope -> data (array<variant>), has_next_page, cursor, offset,
    n_items, bad, bad_body. Missing or NULL ``data`` gives no items; ``bad``
    marks a body that is no page (malformed, cut, or of another shape), which
    is then kept as landed in ``bad_body``. The body is parsed once: a
    one-element explode keeps the parsed struct from being inlined into every
    field."""
    keep = [c for c in pages.columns if c != body]
    parsed = F.from_json(F.col(body), f"{PAGE_SCHEMA}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    one = pages.select(*keep, F.explode(F.array(F.struct(parsed.alias("p"), F.col(body).alias("body")))).alias("e"))
    p = F.col("e.p")
    bad = F.col("e.body").isNotNull() & (p.isNull() | p[_CORRUPT].isNotNull())
    data = F.when(~bad, p["data"])
    return one.select(
        *keep, data.alias("data"),
        p["pagination"]["has_next_page"].alias("has_next_page"),
        p["pagination"]["cursor"].alias("cursor"),
        p["pagination"]["offset"].alias("offset"),
        F.coalesce(F.size(data), F.lit(0)).cast("long").alias("n_items"), bad.alias("bad"),
        F.when(bad, F.col("e.body")).alias("bad_body"))


def bad_pages(parsed: DataFrame) -> DataFrame:
    """Parsed pages whose body is no page, as landed (for the bad-page table)."""
    return parsed.where("bad").select(*[c for c in ("issue_id", "run_id", "page_no") if c in parsed.columns], F.col("bad_body").alias("body"))


def _continues(pagination: str) -> Column:
    """Whether a page continues its chain. S2 (cursor): it has data,
    ``has_next_page`` is true and it carries a non-empty cursor; S3 (offset):
    it has data and ``has_next_page``. A bad page never ends a run: what
    follows it is kept."""
    cont = (F.col("n_items") > 0) & F.coalesce(F.col("has_next_page"), F.lit(False))
    if pagination == "cursor":
        cont = cont & (F.coalesce(F.col("cursor"), F.lit("")) != "")
    return cont | F.col("bad")


def chain_stops(pages: DataFrame, pagination: str, run: str = "run_id", page: str = "page_no") -> DataFrame:
    """(run, stop_page, seen_pages) of parsed pages: the first page that ends
    the run's chain, NULL while none has, and the pages seen. Minimum and count:
    the same query on a stream keeps them per run in Spark's state store."""
    stop = F.when(~_continues(pagination), F.col(page))
    return pages.groupBy(run).agg(F.min(stop).alias("stop_page"), F.count(F.lit(1)).alias("seen_pages"))


def _cut(pages: DataFrame, pagination: str, run: str, page: str, stops: DataFrame | None = None) -> DataFrame:
    """Pages up to the first non-continuing page of each run (that page's
    own rows still count when it has any); later pages are ignored.

    Stops are a min aggregate over narrow rows, or are given; the pages behind
    a stop are listed as (run, page) and anti-joined. Payloads are therefore
    never exchanged on the run: the list is usually empty or small and gets
    broadcast, and a shuffled anti join spreads a hot run over its pages."""
    if stops is None:
        stops = chain_stops(pages.select(run, page, "n_items", "has_next_page", "cursor", "bad"), pagination, run, page)
    stops = stops.where(F.col("stop_page").isNotNull()).select(run, "stop_page")
    flags = pages.select(run, page, (F.col("n_items") > 0).alias("_has"))
    behind = (flags.join(stops, run)
              .where((F.col(page) > F.col("stop_page")) | ((F.col(page) == F.col("stop_page")) & ~F.col("_has")))
              .select(run, page))
    return pages.join(behind, [run, page], "left_anti")


def cursor_chain(pages: DataFrame, run: str = "run_id", page: str = "page_no", stops: DataFrame | None = None) -> DataFrame:
    """The pages of each run's cursor chain. ``stops``: known chain ends
    (run, stop_page), instead of those that ``pages`` show."""
    return _cut(pages, "cursor", run, page, stops)


def offset_chain(pages: DataFrame, run: str = "run_id", page: str = "page_no", stops: DataFrame | None = None) -> DataFrame:
    """S3: the pages of each run's offset chain."""
    return _cut(pages, "offset", run, page, stops)


def offset_gaps(pages: DataFrame, run: str = "run_id", page: str = "page_no") -> DataFrame:
    """S3 gap report: page ``p`` must start at offset(p-1) + n_items(p-1), and
    page 0 at 0. Checked pairwise by a join on (run, page) - no run-wide sort."""
    prev = pages.select(F.col(run), (F.col(page) + 1).alias(page),
                        (F.col("offset") + F.col("n_items")).alias("expected_offset"))
    cur = pages.select(run, page, "offset")
    j = cur.join(prev, [run, page], "left")
    exp = F.when(F.col(page) == 0, F.lit(0)).otherwise(F.col("expected_offset"))
    return (j.select(run, page, F.col("offset"), exp.cast("long").alias("expected_offset"))
            .where(~F.col("offset").eqNullSafe(F.col("expected_offset"))))


def explode_items(pages: DataFrame, keep=("run_id", "page_no")) -> DataFrame:
    """One row per element of ``data`` in page order ``(…, page_no, pos)``."""
    return pages.select(*keep, F.posexplode("data").alias("pos", "item")) \
                .withColumn("pos", F.col("pos").cast("long"))


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Point lookup by key (pushed down to the scan)."""
    return df.where(F.col(key) == F.lit(value))


def unwrap_body(body: Column) -> Column:
    """The ``data`` member of a single-record response, else the body."""
    return unwrap(body, "data")


def cap_records(items: DataFrame, n: int | None, order=("run_id", "page_no", "pos")) -> DataFrame:
    """First ``n`` records in landing order (0/None = unlimited). The cap
    is a place: the page on which the n-th record lies (from a running total
    of the pages' counts) and its position there. What is kept is a filter on
    the landing position; no record is sorted or moved. Records that landed at
    one position are kept or left out together."""
    if not n:
        return items
    *pages, pos = order
    counted = items.groupBy(*pages).agg(F.count(F.lit(1)).alias("_n"))
    edge = running_total(counted, [], pages, "_n").where((F.col("before") < n) & (F.col("before") + F.col("_n") >= n)).first()
    if edge is None:
        return items
    here = reduce(and_, [F.col(c).eqNullSafe(F.lit(edge[c])) for c in pages])
    last = (items.where(here).select(pos).orderBy(pos).limit(n - edge["before"]).agg(F.max(pos).alias("p")).first())["p"]
    place, cut = F.struct(*pages), F.struct(*[F.lit(edge[c]).cast(items.schema[c].dataType).alias(c) for c in pages])
    return items.where((place < cut) | (here & (F.col(pos) <= last)))


def read_ndjson(spark: SparkSession, path: str, schema) -> DataFrame:
    """Typed NDJSON load, explicit schema, no inference, fail on bad rows."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_ndjson(lines: DataFrame, col: str, schema) -> DataFrame:
    """S12 for lines already in a column: ``from_json`` with FAILFAST."""
    return lines.select(F.from_json(F.col(col), schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_landed(pages: DataFrame, root: str, run: str = "run_id") -> None:
    """Land page bodies as ``<root>/<run>=…/page_no=…/`` text files. A file
    takes its time however small it is, so the tasks follow the cores and not
    the bytes, of which adaptive execution would make one task."""
    tasks = pages.sparkSession.sparkContext.defaultParallelism
    pages.select(run, "page_no", "body").repartition(tasks).write.mode("overwrite").partitionBy(run, "page_no").text(root)
