"""Keyed tables: create, upsert (MERGE), sequential batches, truncate, counts
(I1-I4, I6, I7, A2, A3, JN5).

A table is a log of versions (see ``commits``). An upsert writes its
deduplicated rows as one new version and touches nothing else, so its cost
follows the batch, not the table. Several writers may upsert at a time.

The rows of a version lie in buckets by key (Spark's own bucketing). Some members
of the record are kept as plain columns beside it (state, times), by which the
files of issues are sorted: a filter on them skips row groups. A read of base and deltas therefore never shuffles the base: the deltas
(a bounded share of the base, see below) are reduced to their newest row per
key, and the base keeps the rows whose key they do not have. That join needs
the deltas' keys in the base's buckets and reads the base where it lies. A
``lookup`` opens the files of one bucket of each version.

``compact`` folds versions: with more than MAX_DELTAS, the deltas become one
delta, or, once they hold more than FOLD of the base's bytes, a new base. The
buckets of a new base follow its bytes, BUCKET_BYTES each.

Stream tables (``landing=True``) also store each row's landing position
``(landed_run, landed_page, landed_pos)``; on read the row landed last wins
(later run, then later page, inside a page the first item), whatever order the
versions were written in, so replaying a micro-batch changes nothing. Run ids
must sort in run order (the lander names runs by start time). They also keep
cuts: the page at which a run's chain ends. Rows of later pages are not read,
also when the cut came after them.

The keys are stored beside the data; opening a table with other keys fails.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonx import typed_copy, typed_name
from ..schema import spec, table_schema
from .commits import Commit, CommitLog, Files
from .dedup import LANDED_COLS, dedup, dedup_batches, dedup_first, dedup_flushed, dedup_landed, dedup_latest

#: Versions above the base before compaction; share of the base's bytes at
#: which the deltas are folded into it; bytes of a base's bucket.
MAX_DELTAS, FOLD, BUCKET_BYTES = 8, 0.25, 256 << 20
LANDED = (("landed_run", "run_id", T.StringType()), ("landed_page", "page_no", T.LongType()),
          ("landed_pos", "pos", T.LongType()))
CUTS = "run_id string, stop_page long"


def merge(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """MERGE semantics as a relation: matched target rows are replaced by the
    source row, the rest of the target is kept, new keys are inserted."""
    keys = list(keys)
    cols = source.columns
    kept = target.select(*cols).join(source.select(*keys), keys, "left_anti")
    return source.unionByName(kept)


class KeyedTable:
    """A registry table stored under ``path`` (any Hadoop file system).
    ``buckets``: of the first versions (default: the shuffle partitions)."""

    def __init__(self, spark: SparkSession, path: str, object_type: str | None = None,
                 keys=None, schema: T.StructType | None = None, landing: bool = False, buckets: int | None = None):
        self.spark, self.path, self.landing = spark, path.rstrip("/"), landing
        if object_type:
            s = spec(object_type)
            self.keys, self.schema, self.typed, cluster = list(s.keys), table_schema(object_type), list(s.typed), list(s.cluster)
        else:
            self.keys, self.schema, self.typed, cluster = list(keys), schema, [], []
        if landing:
            self.schema = T.StructType(self.schema.fields + [T.StructField(c, t, True) for c, _, t in LANDED])
        self.columns = [f.name for f in self.schema.fields]
        self.physical = T.StructType(self.schema.fields + [T.StructField(typed_name(m), T._parse_datatype_string(t), True) for m, t in self.typed])
        self.sorted_by = [typed_name(m) for m in cluster] + self.keys
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.files = Files(spark)
        self.log = CommitLog(self.files, f"{self.path}/_log")

    # layout ----------------------------------------------------------------
    def _meta(self) -> dict | None:
        path = f"{self.path}/_table.json"
        return json.loads(self.files.text(path)) if self.files.exists(path) else None

    def versions(self) -> list[Commit]:
        """The commits that make up the table, oldest first."""
        return self.log.active()

    def _stored_buckets(self) -> int:
        versions = self.versions()
        return versions[0].buckets if versions else self.buckets

    def _name(self, folder: str) -> str:
        return f"ticketlake_{folder.replace('-', '_')}"

    def _store(self, rows: DataFrame, buckets: int) -> str:
        """``rows`` in a new folder, in buckets. Nothing refers to it yet."""
        folder = f"rows-{uuid.uuid4().hex}"
        rows = rows.select(*self.columns, *[typed_copy("data", m, t).alias(typed_name(m)) for m, t in self.typed])
        (rows.write.format("parquet").bucketBy(buckets, *self.keys).sortBy(*self.sorted_by)
         .option("path", f"{self.path}/{folder}").saveAsTable(self._name(folder)))
        return folder

    def _scan(self, v: Commit) -> DataFrame:
        """A version's rows, known to Spark by their buckets. The session's
        catalog holds the folder's description only, never the data."""
        if v.folder is None:
            return self.spark.createDataFrame([], self.physical)
        name = self._name(v.folder)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.physical.fields)
            place = f"{self.path}/{v.folder}".replace("\\", "\\\\").replace("'", "\\'")
            keys, order = (", ".join(f"`{c}`" for c in cs) for cs in (self.keys, self.sorted_by))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({order}) "
                           f"INTO {v.buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(name).select(*self.physical.names)

    # I2 ------------------------------------------------------------------
    def exists(self) -> bool:
        return self._meta() is not None

    def create(self) -> "KeyedTable":
        """Create the table with the registry schema if absent; an existing
        table is left unchanged. Other keys than the stored ones are an error."""
        if getattr(self, "_created", False):
            return self
        own = {"keys": self.keys, "landing": self.landing}
        if not self.exists():
            self.files.put_if_absent(f"{self.path}/_table.json", json.dumps(own))
        if (meta := self._meta()) != own:
            raise ValueError(f"{self.path} was created with {meta}, opened with keys {self.keys}, landing {self.landing}")
        self._created = True
        return self

    def _newest(self, versions: list[Commit]) -> DataFrame:
        """One row per key of these versions, without the rows behind cuts."""
        if not versions:
            return self.spark.createDataFrame([], self.physical)
        base, deltas = self._scan(versions[0]), versions[1:]
        if deltas:
            rows = reduce(DataFrame.unionByName, [self._scan(v).withColumn("_v", F.lit(v.hi).cast("long")) for v in deltas])
            if len(deltas) > 1:
                rows = dedup(rows, self.keys, [*(self.landed_order() if self.landing else []), F.col("_v").desc()])
            rows = rows.drop("_v")
            if self.landing:
                # a replayed or late micro-batch may hold rows that landed before the base's
                place = F.struct("landed_run", "landed_page", (-F.col("landed_pos")).alias("at"))
                delta, mine = rows.select(*self.keys, place.alias("_d")), base.select(*self.keys, place.alias("_b"))
                kept = base.withColumn("_b", place).join(delta, self.keys, "left").where("_d IS NULL OR _b > _d").drop("_b", "_d")
                rows = rows.withColumn("_d", place).join(mine, self.keys, "left").where("_b IS NULL OR _b <= _d").drop("_b", "_d")
            else:
                kept = base.join(rows.select(*self.keys), self.keys, "left_anti")
            base = kept.select(*self.physical.names).unionByName(rows.select(*self.physical.names))
        cuts = self._cuts(versions)
        if cuts is not None:
            behind = (F.col("landed_run") == F.col("run_id")) & (F.col("landed_page") > F.col("stop_page"))
            base = base.join(cuts, behind, "left_anti")
        return base

    def _cuts(self, versions: list[Commit]) -> DataFrame | None:
        """The first stop page of each run that has one."""
        paths = [f"{self.path}/{v.cuts}" for v in versions if v.cuts]
        return self.spark.read.schema(CUTS).parquet(*paths).groupBy("run_id").agg(F.min("stop_page").alias("stop_page")) if paths else None

    def read(self, typed: bool = False) -> DataFrame:
        """The table with its registry schema; ``typed``: with the plain
        copies of some members too (``jsonx.text_of``, ``time_of``)."""
        if not self.exists():
            raise FileNotFoundError(f"table not found: {self.path}")
        rows = self._newest(self.versions())
        return rows if typed else rows.select(*self.columns)

    def bucket_files(self, v: Commit, bucket: int) -> list[str]:
        """The files of one bucket of a version (Spark writes the bucket's
        number into their names)."""
        folder = f"{self.path}/{v.folder}"
        return [f"{folder}/{x}" for x in self.files.names(folder) if x.startswith("part-") and x.split(".")[0].endswith(f"_{bucket:05d}")]

    def lookup(self, *key: str) -> DataFrame:
        """The row of one key. Of each version only the files of the
        key's bucket are opened, with the key as a pushed filter."""
        types = {f.name: f.dataType for f in self.schema.fields}
        own = [F.lit(x).cast(types[k]) for k, x in zip(self.keys, key, strict=True)]
        versions = self.versions()
        numbers = sorted({v.buckets for v in versions})
        place = self.spark.range(1).select(*[F.pmod(F.hash(*own), F.lit(b)).alias(str(b)) for b in numbers]).first() if numbers else None
        parts = []
        for v in versions:
            files = self.bucket_files(v, place[str(v.buckets)]) if v.folder else []
            if files:
                rows = self.spark.read.schema(self.schema).parquet(*files)
                for k, x in zip(self.keys, own, strict=True):
                    rows = rows.where(F.col(k) == x)
                parts.append(rows.withColumn("_v", F.lit(v.hi).cast("long")))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        found = dedup(reduce(DataFrame.unionByName, parts), self.keys, [*(self.landed_order() if self.landing else []), F.col("_v").desc()])
        cuts = self._cuts(versions)
        if cuts is not None:
            found = found.join(cuts, (F.col("landed_run") == F.col("run_id")) & (F.col("landed_page") > F.col("stop_page")), "left_anti")
        return found.select(*self.columns)

    def changes(self, after: int = -1) -> tuple[DataFrame, int]:
        """(rows of the versions above ``after``, the newest version). The rows
        are those written, one per key and version; a base that holds newer
        versions is read whole, so ``after`` is best kept close."""
        versions = self.versions()
        newer = [self._scan(v) for v in versions if v.hi > after]
        rows = reduce(DataFrame.unionByName, newer) if newer else self.spark.createDataFrame([], self.physical)
        return rows, versions[-1].hi if versions else -1

    # I3/I4 ---------------------------------------------------------------
    def prepare(self, rows: DataFrame, keep: str = "first") -> DataFrame:
        """Dedup a source batch: ``first`` (landing order, parity), ``latest``
        (greatest updated_at), ``batches`` (later batch_no wins), ``flushed``
        (later run, later flush, first record of the flush) or ``landed``
        (later run, later page, first item of the page)."""
        if keep == "landed":
            return dedup_landed(rows, self.keys, self.landed_names() if self.landing else LANDED_COLS)
        modes = {"first": dedup_first, "latest": dedup_latest, "batches": dedup_batches, "flushed": dedup_flushed}
        if keep not in modes:
            raise ValueError(keep)
        return modes[keep](rows, self.keys)

    @staticmethod
    def landed_names() -> list[str]:
        return [c for c, _, _ in LANDED]

    @staticmethod
    def landed_order() -> list:
        """Later run, then later page wins; inside a page the first item."""
        return [F.col("landed_run").desc_nulls_last(), F.col("landed_page").desc_nulls_last(),
                F.col("landed_pos").asc_nulls_last()]

    def upsert_landed(self, rows: DataFrame, batch_ts: Column | None = None, cuts: DataFrame | None = None,
                      buckets: int | None = None) -> dict:
        """Upsert of a stream table: the batch's rows with their landing
        positions become a version; which row wins is settled on read.
        ``cuts`` (run_id, stop_page) are committed with the rows. ``buckets``:
        of this version, where a small batch needs fewer than the table has."""
        if not self.landing:
            raise ValueError("upsert_landed needs a table created with landing=True")
        for c, src_col, t in LANDED:
            rows = rows.withColumn(c, F.col(src_col).cast(t))
        return self.upsert(rows, keep="landed", batch_ts=batch_ts, cuts=cuts, buckets=buckets)

    def upsert(self, rows: DataFrame, keep: str = "first", batch_ts: Column | None = None, cuts: DataFrame | None = None,
               buckets: int | None = None) -> dict:
        """Stamp, dedup, append as a new version. Returns ``{"rows_in",
        "rows_kept"}`` from Observations. The target is not read."""
        self.create()
        if batch_ts is not None:
            rows = rows.withColumn("updated_at", batch_ts)
        obs_in, obs_out = Observation("rows_in"), Observation("rows_kept")
        src = self.prepare(rows.observe(obs_in, F.count(F.lit(1)).alias("n")), keep)
        buckets = min(self._stored_buckets(), buckets or self._stored_buckets())
        folder = self._store(src.select(*self.columns).observe(obs_out, F.count(F.lit(1)).alias("n")), buckets)
        self.log.add(None, None, folder, buckets, self._store_cuts(cuts))
        self.compact()
        return {"rows_in": obs_in.get.get("n", 0), "rows_kept": obs_out.get.get("n", 0)}

    def _store_cuts(self, cuts: DataFrame | None) -> str | None:
        if cuts is None:
            return None
        folder = f"cuts-{uuid.uuid4().hex}"
        cuts.select("run_id", F.col("stop_page").cast("long")).write.parquet(f"{self.path}/{folder}")
        return folder

    def _bytes(self, v: Commit) -> int:
        return self.files.size(f"{self.path}/{v.folder}") if v.folder else 0

    def compact(self, max_deltas: int = MAX_DELTAS, fold: float = FOLD) -> bool:
        """Fold versions when there are more than ``max_deltas`` above the
        base. Superseded folders stay until ``vacuum``. A version committed
        meanwhile stays above what was folded."""
        versions = self.versions()
        base, deltas = versions[:1], versions[1:]
        if len(deltas) <= max_deltas:
            return False
        below, above = self._bytes(base[0]), sum(self._bytes(v) for v in deltas)
        whole = above > fold * below
        folded = versions if whole else deltas
        buckets = base[0].buckets
        if whole:
            while (below + above) / buckets > BUCKET_BYTES:
                buckets *= 2
        self.log.add(folded[0].lo, folded[-1].hi, self._store(self._newest(folded), buckets), buckets, self._store_cuts(self._cuts(folded)))
        return True

    def vacuum(self) -> int:
        """Delete the folders that no read uses (no reader may be under way),
        but not those that no commit names: they may be a writer's."""
        log, active = self.log, {f for v in self.versions() for f in (v.folder, v.cuts)}
        named = {f for n in log.numbers() if (c := log.get(n)) for f in (c.folder, c.cuts) if f}
        gone = sorted((named - active) & set(self.files.names(self.path)))
        for folder in gone:
            if self.spark.catalog.tableExists(self._name(folder)):
                self.spark.sql(f"DROP TABLE {self._name(folder)}")
            self.files.delete(f"{self.path}/{folder}")
        return len(gone)

    # I7 / A2 / A3 ----------------------------------------------------------
    def row_count(self) -> DataFrame:
        return self.read().agg(F.count(F.lit(1)).cast("long").alias("row_count"))

    def high_water_mark(self, col: str = "updated_at") -> DataFrame:
        return self.read().agg(F.max(col).alias("high_water_mark"))

    def truncate(self, name: str | None = None) -> DataFrame:
        """Empty the table: a version without rows that stands for all before
        it. Returns the audit row (table, rows_before, rows_after). A missing
        table is an error."""
        before = self.row_count().first()["row_count"]
        self.log.add(0, None, None, self._stored_buckets())
        after = self.row_count().first()["row_count"]
        return self.spark.createDataFrame([(name or self.path.rpartition("/")[2], int(before), int(after))],
                                          "table_name string, rows_before bigint, rows_after bigint")
