"""Repeated byte strings across all texts, removed by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes (a window) that also starts earlier: in a text of a smaller key, or further
left in the same text. Suffixes that share a window share what marks it, so no task has to hold all suffixes:

1. Texts are written once, in blocks, as a table bucketed by block; every later step meets them there without shuffling
   them again. Of equal texts only the first goes on; the others are repeats as a whole.
2. Each window is marked by its least k-gram (by a hash), so equal windows have equal marks at equal places. The windows that one
   mark occurrence stands for are one row; marks that occur once in the whole corpus can't be repeats and go.
3. What is left sends its context, the bytes of its windows. Equal contexts fold, before the shuffle, into the first of them.
4. The suffixes that start in the different contexts of a mark are sorted. In this suffix order the previous and the next suffix of
   smaller text position give each one's longest previous factor; a window that is shorter than it is a repeat.
   Marks with too many different contexts for a task are cut into single windows, which fold like contexts.
5. The starts that are first occurrences return to their block; all other windows of repeated marks are removed there.

Hashes only choose what is compared; windows are compared byte by byte (single windows of crowded marks and whole texts by SHA-256).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm.blocks import HOT_SHARE, carried, carried_kind, text_batches
from zoneflow.llm.common import written
from zoneflow.session import intermediate_path

#: Bytes of a repeated string.
LENGTH = 100
#: Bytes of texts in a block, about: what one Python call holds. A longer text is a block of its own.
BLOCK_BYTES = 32 << 20
#: Marks with more different contexts than this are cut into single windows.
MOST_CONTEXTS = 20_000
#: One in so many texts is looked at beforehand to see which marks are hot. It decides who shuffles, not what results.
HOT_SAMPLE = 64
#: Windows hashed at once, and suffixes sorted at once.
CHUNK, PASS = 1 << 20, 200_000
MOST_BUCKETS = 100_000  # Spark's own bound

_MIX = np.random.default_rng(100).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STIR = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
_PLACE = np.uint64((1 << 21) - 1)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k bytes in a row, by joining the hashes of powers of two."""
    size = len(data) - k + 1
    cur, width, out, done = _MIX[data], 1, None, 0
    while True:
        if k & width:
            if out is None:
                out = cur
            else:
                out = out[: len(data) - done - width + 1] * np.uint64(pow(_BASE, width, 1 << 64)) + cur[done : done + len(data) - done - width + 1]
            done += width
        if width * 2 > k:
            break
        cur = cur[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + cur[width:]
        width *= 2
    out = out[:size].copy()
    out ^= out >> np.uint64(32)
    out *= _STIR
    out ^= out >> np.uint64(29)
    return out


def marks(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, mark, spot) of every stretch of windows with the same mark occurrence.

    A spot is place << 32 | before << 16 | windows: the place of the mark in its text, how far before it the first of its
    windows starts, and their number. A window's mark is its least k-gram, the leftmost of equal ones.
    """
    k = max(1, length // 4)
    w = length - k + 1
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for s in range(0, max(len(data) - length + 1, 0), CHUNK):
        e = min(s + CHUNK, len(data) - length + 1)
        grams = gram_hashes(data[s : e + length - 1], k)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        step = 1
        while step * 2 <= w:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < w:
            least = np.minimum(least[: step - w], least[w - step :])
        place = (least & _PLACE).astype(np.int64)
        starts = np.arange(s, e)
        text = np.searchsorted(ends, starts, "right")
        place[starts + length > ends[text]] = -1  # windows that reach into the next text
        cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
        windows = np.diff(np.append(cut, len(place)))
        real = place[cut] >= 0
        cut, windows = cut[real], windows[real]
        at, number = place[cut], text[cut]
        out.append((number, grams[at].astype(np.int64), (at + s - begins[number]) << 32 | (at - cut) << 16 | windows))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def spot_parts(spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first start, number of windows) of spots."""
    return (spot >> 32) - (spot >> 16 & 0xFFFF), spot & 0xFFFF


def previous_smaller(pos: np.ndarray, common: np.ndarray, floor: int) -> np.ndarray:
    """What each suffix has in common with the nearest suffix before it, in suffix order, that has a smaller position. ``common[i]``:
    with suffix i-1. Answers of ``floor`` or less are not worked out further. By jumping along the answers of the others."""
    before, best = np.arange(len(pos)) - 1, common.copy()
    active = np.arange(len(pos))
    while True:
        active = active[(before[active] >= 0) & (best[active] > floor)]
        active = active[pos[before[active]] > pos[active]]
        if not len(active):
            return np.where(before >= 0, best, 0)
        via = before[active]
        best[active], before[active] = np.minimum(best[active], best[via]), before[via]


def longest_previous(rows: np.ndarray, pos: np.ndarray, floor: int) -> np.ndarray:
    """The longest previous factor of every suffix, given as byte rows of one length: how many leading bytes it shares with
    a suffix of smaller position, through the previous and next smaller positions in suffix order."""
    order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
    sorted_rows, at = rows[order], pos[order]
    common = np.zeros(len(rows) + 1, np.int64)
    differ = sorted_rows[1:] != sorted_rows[:-1]
    common[1:-1] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    up = previous_smaller(at, common[:-1], floor)
    down = previous_smaller(at[::-1], common[:0:-1], floor)[::-1]
    out = np.empty(len(rows), np.int64)
    out[order] = np.maximum(up, down)
    return out


def first_starts(group: np.ndarray, before: np.ndarray, contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each context, the starts whose windows don't occur in an earlier context of its group. Contexts are in text order;
    ``before``: how far before the mark they start."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    windows = sizes - length + 1
    text = np.repeat(np.arange(len(contexts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    klass = np.unique(group, return_inverse=True)[1][text] << 16 | (before[text] - start)
    order = np.argsort(klass, kind="stable")
    klass, cuts = klass[order], [0]
    edges = np.append(np.flatnonzero(np.diff(klass)) + 1, len(klass))
    while cuts[-1] < len(klass):  # whole classes, up to PASS suffixes or one class
        i = int(np.searchsorted(edges, cuts[-1] + PASS, "right")) - 1
        cuts.append(int(edges[i]) if i >= 0 and edges[i] > cuts[-1] else int(edges[np.searchsorted(edges, cuts[-1], "right")]))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    windows_of = np.lib.stride_tricks.sliding_window_view(data, length)
    at = (np.cumsum(sizes) - sizes)[text] + start
    repeat = np.zeros(len(text), bool)
    for lo, hi in zip(cuts, cuts[1:]):
        which = order[lo:hi]
        rows = np.empty((hi - lo, 8 + length), np.uint8)
        rows[:, :8] = klass[lo:hi].astype(">i8").view(np.uint8).reshape(-1, 8)
        rows[:, 8:] = windows_of[at[which]]
        repeat[which] = longest_previous(rows, which, 8) >= 8 + length
    return [np.flatnonzero(~r) for r in np.split(repeat, np.cumsum(windows)[:-1])]


def spans_of(size: int, spots: np.ndarray, firsts: dict[int, np.ndarray | None], length: int) -> list[tuple[int, int]]:
    """Maximal removed stretches (start, end) of a text: windows of its spots that are no first occurrences."""
    edge = np.zeros(size + 1, np.int64)
    for spot in spots.tolist():
        kept = firsts.get(spot, ())
        if kept is None:
            continue
        begin, windows = (spot >> 32) - (spot >> 16 & 0xFFFF), spot & 0xFFFF
        gone = np.ones(windows, bool)
        gone[np.asarray(kept, np.int64)] = False
        starts = np.flatnonzero(gone) + begin
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
    covered = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(covered))
    return [(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2])]


def written_in_blocks(frame: DataFrame, name: str, key: str) -> DataFrame:
    """``frame`` written to the shared folder as a table bucketed by ``key``: joins and groups by it don't shuffle it again."""
    spark = frame.sparkSession
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    label = f"zoneflow_{name}_{uuid.uuid4().hex}"
    (frame.write.format("parquet").option("compression", "zstd").option("path", intermediate_path(spark, name))
     .bucketBy(buckets, key).saveAsTable(label))
    return spark.table(label)


def in_blocks(spark: SparkSession, docs: DataFrame, key: str, text: str, block_bytes: int) -> DataFrame:
    """(block, row, key, tie, digest, size, data): the texts as UTF-8 bytes, numbered, in blocks of a task's neighbouring rows."""

    @F.pandas_udf("bigint")
    def block_of(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        base, number, full = TaskContext.get().partitionId() << 32, 0, 0
        for batch in sizes:
            out = []
            for size in batch:
                if full and full + size > block_bytes:
                    number, full = number + 1, 0
                full += size
                out.append(base + number)
            yield pd.Series(out, dtype="int64")

    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), data.alias("data"))
    rows = rows.select("key", F.xxhash64("data").alias("tie"), F.unhex(F.sha2("data", 256)).alias("digest"),
                       F.octet_length("data").alias("size"), F.monotonically_increasing_id().alias("row"), "data")
    return written_in_blocks(rows.withColumn("block", block_of("size")), "texts", "block")


def repeated_marks(texts: DataFrame, own: DataFrame, length: int) -> DataFrame:
    """(mark, block, row, spot) of the marks that come more than once in the first texts ``own`` (block, row)."""
    spark = texts.sparkSession

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        number, mark, spot = marks(frame["data"].tolist(), length)
        return pd.DataFrame({"mark": mark, "block": frame["block"].to_numpy()[number], "row": frame["row"].to_numpy()[number], "spot": spot})

    def of_own(frame: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        return of(frame[frame["row"].isin(mine["own"])])

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield of(batch)

    schema = "mark bigint, block bigint, row bigint, spot bigint"
    long = texts.where(F.col("size") >= length).select("block", "row", "data")
    few = texts.where(F.col("size") >= length).where(F.pmod("tie", F.lit(HOT_SAMPLE)) == 0).select("block", "row", "data")
    counts = written(few.mapInPandas(of_batches, schema).groupBy("mark").agg(F.count("*").alias("n")), "sampled")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("n") > 1) & (F.col("n") * HOT_SHARE > total)).select("mark", F.lit(True).alias("hot"))  # < HOT_SHARE rows

    mine = own.select("block", F.col("row").alias("own"))
    found = long.groupBy("block").cogroup(mine.groupBy("block")).applyInPandas(of_own, schema)
    found = found.join(F.broadcast(hot), "mark", "left").withColumn("salt", F.when(F.col("hot"), F.col("row")).otherwise(0))
    together = Window.partitionBy("mark", "salt")  # a hot mark is known to come twice: its rows need not meet
    return (found.withColumn("n", F.count("*").over(together)).where("hot or n > 1")
            .select("mark", "block", "row", "spot"))


def contexts(texts: DataFrame, spots: DataFrame, length: int) -> DataFrame:
    """(mark, before, context, first): each different context of a mark with its first occurrence in text order."""
    kind = texts.schema["key"].dataType.simpleString()

    def of(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        data = dict(zip(frame["row"], frame["data"]))
        begin, windows = spot_parts(found["spot"].to_numpy(np.int64))
        out = found[["mark", "block", "row", "spot"]].assign(
            before=(found["spot"].to_numpy(np.int64) >> 16 & 0xFFFF).astype(np.int32),
            context=[data[r][b : b + n + length - 1] for r, b, n in zip(found["row"], begin.tolist(), windows.tolist())])
        return out.merge(frame[["row", "held", "tie"]].astype({"held": object}), on="row")

    long = texts.where(F.col("size") >= length).select("block", "row", carried("key", kind).alias("held"), "tie", "data")
    rows = long.groupBy("block").cogroup(spots.groupBy("block")).applyInPandas(
        of, f"mark bigint, before int, context binary, held {carried_kind(kind)}, tie bigint, block bigint, row bigint, spot bigint")
    place = F.struct(F.col("held").isNull().alias("none"), F.col("held").cast(kind).alias("key"), "tie", "row", "spot", "block")
    return rows.groupBy("mark", "before", "context").agg(F.min(place).alias("first"))


def first_windows(folded: DataFrame, length: int, most: int) -> DataFrame:
    """(block, row, spot, kept): of each context, the starts (from its own first one) that are first occurrences in the corpus.
    Contexts without any are left out."""
    spark = folded.sparkSession
    crowded = written(folded.groupBy("mark").agg(F.count("*").alias("n")).where(F.col("n") > most).select("mark"), "crowded")
    place = ["first.block", "first.row", "first.spot"]

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def of(rows: pd.DataFrame) -> pd.DataFrame:
            kept = first_starts(rows["mark"].to_numpy(), rows["before"].to_numpy(np.int64), rows["context"].tolist(), length)
            out = rows[["block", "row", "spot"]].assign(kept=kept)
            return out[[len(k) > 0 for k in kept]]

        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch])
            last = rows["mark"].to_numpy() == rows["mark"].iloc[-1] if len(rows) else np.empty(0, bool)
            rest = rows[last]
            if not last.all():
                yield of(rows[~last])
        if rest is not None and len(rest):
            yield of(rest)

    schema = "block bigint, row bigint, spot bigint, kept array<int>"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lone = crowded.isEmpty()
    calm = folded if lone else folded.join(crowded, "mark", "left_anti")
    calm = (calm.repartition(tasks, "mark").sortWithinPartitions("mark", "first")
            .select("mark", "before", "context", *place).mapInPandas(sort, schema))
    if lone:
        return calm
    window = F.explode(F.sequence(F.lit(0), F.octet_length("context") - length))
    cut = (folded.join(crowded, "mark", "left_semi").select("mark", "before", "context", "first", window.alias("start"))
           .select("mark", (F.col("before") - F.col("start")).alias("off"), "first", "start",
                   F.unhex(F.sha2(F.expr(f"substring(context, start + 1, {length})"), 256)).alias("window"))
           .groupBy("mark", "off", "window").agg(F.min(F.struct("first", "start")).alias("m"))
           .groupBy("m.first.block", "m.first.row", "m.first.spot").agg(F.collect_list("m.start").alias("kept")))
    return calm.unionByName(cut)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   block_bytes: int = BLOCK_BYTES, most_contexts: int = MOST_CONTEXTS, listed: bool = False) -> DataFrame:
    """One row a document: ``key``, n_bytes, n_removed, n_spans (maximal removed stretches) and kept_sha256 (digest of the other bytes).

    Removed is each byte in a string of ``length`` bytes (4 to 65535) that starts earlier too: in a document of a smaller key, or
    in the same one. Documents of equal keys are ordered by their texts' hash, null keys come last. ``listed`` adds ``spans``
    (array of start, end) and ``kept`` (the other bytes). Null texts count as empty; texts under ``length`` bytes lose nothing; an empty
    table gives an empty one; other columns are not read, whatever their names. Text bytes are at most 2 GB a document, as Arrow's are.
    """
    if not 4 <= length <= 65535:
        raise ValueError("length must be 4 to 65535")
    spark = docs.sparkSession
    text_batches(spark, 1024)
    texts = in_blocks(spark, docs, key, text, block_bytes)
    place = F.struct(F.col("key").isNull().alias("none"), "key", "row", "block")
    own = written(texts.where(F.col("size") >= length).groupBy("digest").agg(F.min(place).alias("first"))
                  .select("first.block", "first.row"), "own")
    spots = written(repeated_marks(texts, own, length), "spots")
    folded = written(contexts(texts, spots, length), "contexts")
    firsts = first_windows(folded, length, most_contexts)

    none = F.lit(None).cast("array<int>").alias("kept")
    side = (own.select("block", "row", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("spot"), none)
            .unionByName(spots.select("block", "row", F.lit(1).alias("kind"), "spot", none))
            .unionByName(firsts.select("block", "row", F.lit(2).alias("kind"), "spot", "kept")))

    def of(frame: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        side = side.sort_values("row", kind="stable")
        rows, kinds = side["row"].to_numpy(), side["kind"].to_numpy()
        places, kept = side["spot"].to_numpy(), side["kept"].to_numpy()
        out = []
        for row, held, data in zip(frame["row"], frame["held"], frame["data"]):
            spans: list[tuple[int, int]] = []
            if len(data) >= length:
                lo, hi = np.searchsorted(rows, [row, row + 1])
                kind = kinds[lo:hi]
                if not (kind == 0).any():
                    spans = [(0, len(data))]  # an earlier document has the same text
                elif (kind == 1).any():
                    at = places[lo:hi]
                    first = {int(s): k for s, k in zip(at[kind == 2], kept[lo:hi][kind == 2])}
                    spans = spans_of(len(data), at[kind == 1].astype(np.int64), first, length)
            rest, at = [], 0
            for a, b in spans:
                rest.append(data[at:a])
                at = b
            rest = b"".join([*rest, data[at:]])
            out.append((held, len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                        [{"start": a, "end": b} for a, b in spans], rest))
        return pd.DataFrame(out, columns=["held", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])[names]

    kind = docs.schema[key].dataType.simpleString()
    columns = f"held {carried_kind(kind)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    columns += ", spans array<struct<start:bigint,end:bigint>>, kept binary" * listed
    names = ["held", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * listed
    whole = texts.select("block", "row", carried("key", kind).alias("held"), "data")
    rows = whole.groupBy("block").cogroup(side.groupBy("block")).applyInPandas(of, columns)
    return rows.select(F.col("held").cast(kind).alias(key), *names[1:])


#: DuckDB: the same result over documents by numbering all windows that are equal (texts as hex, two letters a byte).
SQL = r"""
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200) x),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM windows) x WHERE n > 1),
parted AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM later),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM parted) x GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
