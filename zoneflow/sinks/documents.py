"""Document sinks (SNK-02..SNK-08).

Documents are written from the executors as Parquet, one folder a batch of a writer
(``batches/batch_id=N/writer=W/written=T``) and in it one a date (``sync_date``). Writing a batch replaces its whole folder, so a
replayed batch leaves nothing of its earlier run, whatever its dates and rows are, and an empty one leaves no rows. A writer is
whoever counts batches by itself: a checkpoint, a scheduled job. Each has batches of its own, so a stream that starts again at 0 with
a new checkpoint replaces nothing of the old one's; of a document's versions the last written counts.

``compact`` folds closed batches into one folder a date, rewriting the dates that they touch and no others.
Range queries prune whole dates, also through the newest-version step, which has the date among its keys. Nothing is collected to
the driver but the names of folders.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from zoneflow import schemas as S
from zoneflow.functions.text import document_time_text
from zoneflow.session import child_names, make_folder, path_exists, remove_path

T = TypeVar("T")

DOC_KEY = ("zone", "synchronized_time")
DATE_COL = "sync_date"


def _partitioned(documents: DataFrame) -> DataFrame:
    return documents.withColumn(DATE_COL, F.to_date("synchronized_time"))


def with_retries(action: Callable[[int], T], attempts: int = 3, backoff_seconds: float = 2.0,
                 sleep: Callable[[float], None] = time.sleep) -> T:
    """SNK-05: run ``action(attempt)``; on failure wait ``backoff * attempt`` and retry.

    Raises the last error after the final attempt, so a streaming checkpoint does not advance
    past a batch that was not written.
    """
    for attempt in range(1, attempts + 1):
        try:
            return action(attempt)
        except Exception:
            if attempt == attempts:
                raise
            sleep(backoff_seconds * attempt)
    raise AssertionError("unreachable")


#: What tells versions of a document apart, the newest last; ``written`` is the milliseconds at which its batch was first written.
VERSION = ("written", "batch_id", "writer")


def checkpoint_writer(spark: SparkSession, checkpoint: str) -> str:
    """The writer that a checkpoint stands for: the same one after a restart, another one for another (or a lost) checkpoint."""
    folder = f"{checkpoint.rstrip('/')}/writer"
    names = child_names(spark, folder)
    if not names:
        make_folder(spark, f"{folder}/{uuid.uuid4().hex}")
        names = child_names(spark, folder)
    return names[0]


class DocumentSink:
    """SNK-03: keyed, idempotent document table at ``path``; ``writer`` (letters, digits, ``_`` and ``-``) names whose batches this
    sink writes and compacts. It reads those of all writers."""

    def __init__(self, path: str, attempts: int = 3, backoff_seconds: float = 2.0,
                 schema: StructType = S.UNIFIED_SCHEMA, writer: str = "main"):
        if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
            raise ValueError(f"not a writer's name: {writer!r}")
        self.path = path.rstrip("/")
        self.attempts = attempts
        self.backoff_seconds = backoff_seconds
        self.schema = schema
        self.writer = writer
        self._last = 0

    def as_writer(self, writer: str) -> DocumentSink:
        """The same table, written by another writer."""
        return DocumentSink(self.path, self.attempts, self.backoff_seconds, self.schema, writer)

    def write(self, documents: DataFrame, batch_id: int) -> None:
        """Replace this writer's batch ``batch_id`` by these documents (none: the batch becomes empty). A replaced
        batch keeps its place among the versions."""
        # One trigger's documents, clustered by date (few files per date, not one per task);
        # REBALANCE lets AQE split a date that holds most of the batch into several tasks.
        out = _partitioned(documents.select(*self.schema.names)).hint("rebalance", DATE_COL)
        folder = f"{self.path}/batches/batch_id={int(batch_id)}/writer={self.writer}"
        earlier = [n for n in child_names(documents.sparkSession, folder) if n.startswith("written=")]
        stamp = earlier[0] if earlier else f"written={self._next_stamp(documents.sparkSession)}"
        with_retries(lambda _: out.write.mode("overwrite").partitionBy(DATE_COL).parquet(f"{folder}/{stamp}"),
                     self.attempts, self.backoff_seconds)

    def _next_stamp(self, spark: SparkSession) -> int:
        """Now, but later than what this sink wrote and what was compacted, should clocks differ."""
        self._last = max(int(time.time() * 1000), self._last + 1, self._folded(spark).newest + 1)
        return self._last

    def __call__(self, documents: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` entry point (SNK-02)."""
        self.write(documents, batch_id)

    def _batches(self, spark: SparkSession) -> list[str]:
        """Folders of the batches that no compaction has folded."""
        root, folded = f"{self.path}/batches", self._folded(spark).batches
        names = [f"{b}/{w}/{t}" for b in child_names(spark, root) if b.startswith("batch_id=")
                 for w in child_names(spark, f"{root}/{b}") if w.startswith("writer=")
                 for t in child_names(spark, f"{root}/{b}/{w}") if t.startswith("written=")]
        return [n for n in names if n not in folded]

    def _folded(self, spark: SparkSession) -> Folded:
        """What the newest finished compaction says: which folder holds each date, and which batches are in them."""
        found = [Folded()]
        for name in child_names(spark, f"{self.path}/compacted"):
            folder = f"{self.path}/compacted/{name}"
            if path_exists(spark, f"{folder}/_SUCCESS"):
                rows = spark.read.schema(MANIFEST_DDL).parquet(folder).collect()  # a row a date and lately folded batch
                found.append(Folded(max(r.generation for r in rows), {r.name: r.held for r in rows if r.kind == "date"},
                                    frozenset(r.name for r in rows if r.kind == "batch"),
                                    max((int(r.name) for r in rows if r.kind == "newest"), default=0)))
        return max(found, key=lambda f: f.generation)

    def _full_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(DATE_COL, DateType()), StructField("batch_id", LongType()),
                           StructField("writer", StringType()), StructField("written", LongType())])

    def _rows(self, spark: SparkSession, root: str, names: list[str]) -> DataFrame:
        full = self._full_schema()
        if not names:
            return spark.createDataFrame([], full)
        return (spark.read.schema(full).option("basePath", f"{self.path}/{root}")
                .parquet(*[f"{self.path}/{root}/{n}" for n in names]).select(*full.names))

    def read_all(self, spark: SparkSession) -> DataFrame:
        """All versions of all documents, with ``sync_date``, ``batch_id``, ``writer`` and ``written``. A missing table has
        no rows."""
        dates = [f"generation={g}/{d}" for d, g in sorted(self._folded(spark).dates.items())]
        parts = [self._rows(spark, root, names) for root, names in (("batches", self._batches(spark)), ("dates", dates)) if names]
        return reduce(DataFrame.union, parts) if parts else self._rows(spark, "batches", [])

    def read(self, spark: SparkSession, key: tuple[str, ...] = DOC_KEY,
             keep_date: bool = False) -> DataFrame:
        """Current documents: the last written version of each key. ``keep_date`` keeps the
        ``sync_date`` partition column so range filters prune dates (see metrics.in_range)."""
        docs = latest_version(self.read_all(spark), key)
        return docs if keep_date else docs.drop(DATE_COL)

    def dates(self, spark: SparkSession) -> list[str]:
        """The dates that have documents, newest first, from the names of the folders."""
        held = {d for n in self._batches(spark) for d in child_names(spark, f"{self.path}/batches/{n}")} | set(self._folded(spark).dates)
        names = (d.split("=", 1)[1] for d in held if d.startswith(f"{DATE_COL}="))
        return sorted((d for d in names if not d.startswith("__")), reverse=True)

    def newest(self, spark: SparkSession, n: int) -> DataFrame:
        """ST-02: the ``n`` newest documents, from as few of the newest dates as hold so many.

        Dates are counted from the newest on, twice as many at a time; only their partitions are scanned, and no others for the
        result. Documents without a time count as oldest: they are read if the dates hold fewer than ``n``."""
        docs, dates, since, found, step = self.read(spark, keep_date=True), self.dates(spark), None, 0, 1
        while dates and found < n:
            some, dates = dates[:step], dates[step:]
            between = F.col(DATE_COL).between(F.lit(some[-1]).cast("date"), F.lit(some[0]).cast("date"))
            found += docs.filter(between).count()
            since, step = some[-1], step * 2
        if found >= n and since is not None:
            docs = docs.filter(F.col(DATE_COL) >= F.lit(since).cast("date"))
        return docs.drop(DATE_COL).orderBy(F.col("synchronized_time").desc(), F.col("zone")).limit(n)

    def compact(self, spark: SparkSession, upto: int, key: tuple[str, ...] = DOC_KEY) -> None:
        """Fold this writer's batches up to ``upto`` into one folder a date, keeping the newest version of each document, so that the
        number of folders does not grow with the number of triggers.

        Only the dates in these batches are rewritten; the others stay where they are. The batches must be closed: a batch that
        is written again after this adds to what was folded of it. The compaction counts from the moment its list of
        folders is complete; only then are the folders it replaces removed, so a failure at any point loses nothing and reads as before
        or after.
        """
        old = self._folded(spark)
        closed = [n for n in self._batches(spark) if n.split("/")[1] == f"writer={self.writer}"
                  and int(n.split("/")[0].split("=")[1]) <= upto]
        if not closed:
            return
        touched = sorted({d for n in closed for d in child_names(spark, f"{self.path}/batches/{n}") if d.startswith(f"{DATE_COL}=")})
        generation = 1 + max([old.generation] + [int(n.split("=")[1]) for n in child_names(spark, f"{self.path}/dates")])
        if touched:
            again = [f"generation={old.dates[d]}/{d}" for d in touched if d in old.dates]
            rows = reduce(DataFrame.union, [self._rows(spark, r, n) for r, n in (("batches", closed), ("dates", again)) if n])
            out = latest_version(rows, key, keep=True).hint("rebalance", DATE_COL)
            with_retries(lambda _: out.write.mode("overwrite").partitionBy(DATE_COL).parquet(f"{self.path}/dates/generation={generation}"),
                         self.attempts, self.backoff_seconds)
        dates = old.dates | {d: generation for d in touched}
        newest = max([old.newest] + [int(n.split("=")[-1]) for n in closed])
        manifest = ([("date", d, g) for d, g in dates.items()] + [("batch", n, generation) for n in closed]
                    + [("newest", str(newest), generation)])
        name = f"batch_id={int(upto)}" + (f".{generation}" if f"batch_id={int(upto)}" in child_names(spark, f"{self.path}/compacted") else "")
        (spark.createDataFrame([(generation, *row) for row in manifest], MANIFEST_DDL).coalesce(1)
         .write.parquet(f"{self.path}/compacted/{name}"))
        self._clean(spark, name, dates, closed)

    def _clean(self, spark: SparkSession, name: str, dates: dict[str, int], closed: list[str]) -> None:
        """Remove what the compaction ``name`` replaces."""
        for folder in closed:
            batch, writer, _ = folder.split("/")
            remove_path(spark, f"{self.path}/batches/{batch}/{writer}")
            if not child_names(spark, f"{self.path}/batches/{batch}"):
                remove_path(spark, f"{self.path}/batches/{batch}")
        for other in child_names(spark, f"{self.path}/compacted"):
            if other != name:
                remove_path(spark, f"{self.path}/compacted/{other}")
        for generation in child_names(spark, f"{self.path}/dates"):
            folder = f"{self.path}/dates/{generation}"
            held = [d for d, g in dates.items() if f"generation={g}" == generation]
            for d in child_names(spark, folder):
                if d.startswith(f"{DATE_COL}=") and d not in held:
                    remove_path(spark, f"{folder}/{d}")
            if not held:
                remove_path(spark, folder)


#: A compaction's list: which generation's folder holds a date; the batches it folded; the newest stamp among them.
MANIFEST_DDL = "generation bigint, kind string, name string, held bigint"


@dataclass(frozen=True)
class Folded:
    generation: int = 0
    dates: dict[str, int] = field(default_factory=dict)
    batches: frozenset[str] = frozenset()
    newest: int = 0


def latest_version(docs: DataFrame, key: tuple[str, ...] = DOC_KEY, keep: bool = False) -> DataFrame:
    """Last write per key wins (``VERSION``; ``keep`` keeps its columns). The date, which follows from the time in
    the key, is among the window's keys, so that date predicates pass it and reach the scan."""
    keys = [*key, *([DATE_COL] if DATE_COL in docs.columns else [])]
    version = [c for c in VERSION if c in docs.columns]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in version])
    newest = docs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return newest if keep else newest.drop(*version)


def render_documents(documents: DataFrame) -> DataFrame:
    """SNK-04: one (doc_id, JSON document) row per document, rendered on the executors.

    Timestamps become document text (SC-08); null fields are kept as ``null``, so every
    document carries all of its fields.
    """
    def shown(f):
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return document_time_text(f.name)
        return F.col(f.name)

    fields = [shown(f).alias(f.name) for f in documents.schema.fields]
    return (documents.select(F.struct(*fields).alias("d"))
            .select(F.concat_ws("-", "d.zone", "d.synchronized_time").alias("doc_id"),
                    F.to_json("d", {"ignoreNullFields": "false"}).alias("document")))


def show_vertical(df: DataFrame, n: int = 100) -> None:
    """SNK-08: print up to ``n`` rows, one field per line (debugging only)."""
    df.show(n, truncate=False, vertical=True)


def write_batches(documents: DataFrame, path: str, batch_col: str = "batch_id", writer: str = "main") -> None:
    """Write many batches in one job to a new table: each value of ``batch_col`` is a batch."""
    (_partitioned(documents.withColumn("batch_id", F.col(batch_col).cast("long")))
     .withColumn("writer", F.lit(writer)).withColumn("written", F.lit(int(time.time() * 1000)))
     # clustered by (batch, date) so each partition folder gets few files; AQE splits a hot
     # one into advisory-sized tasks instead of writing it from one task
     .hint("rebalance", "batch_id", DATE_COL)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "writer", "written", DATE_COL).parquet(f"{path.rstrip('/')}/batches"))


class RejectSink:
    """SNK-06 / PRJ-08: rejected messages with their reason and raw payload, one folder a batch."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, rejects: DataFrame, batch_id: int) -> None:
        with_retries(lambda _: rejects.write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}"))

    def read(self, spark: SparkSession) -> DataFrame:
        """All rejects (none if nothing was written yet)."""
        names = [n for n in child_names(spark, self.path) if n.startswith("batch_id=")]
        schema = "topic string, json_payload string, kafka_time timestamp_ntz, kafka_partition int, kafka_offset bigint, reject_reason string"
        if not names:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])
