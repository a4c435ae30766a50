"""Near duplicates: a similarity join on word n-gram sets by MinHash bands, with every link verified on full sets.

1. Exact copies fold into one text (its class), so no later step grows with the number of copies.
2. MinHash signatures of all distinct texts, cut into bands; bands and rows are chosen for a target recall.
3. Shuffle on band hashes: a bucket's texts are tied to its smallest and largest id (two pairs a text, never all pairs of
   a bucket). A tie counts if it is seen in ``TIES`` buckets, which chance collisions of texts that only share a passage
   hardly ever are. Connected ties make candidate groups.
4. All pairs of a candidate group are verified on full n-gram sets in numpy. Only counts of links and a spanning forest
   leave the task. Large groups are cut into blocks, each pair of blocks a task of its own.
5. Components of the verified links are the classes of near duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import groups, small_batches, written
from zoneflow.llm.graph import components
from zoneflow.llm.shingles import mixed, shingle_sets

NGRAM, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Buckets that two texts must share to be candidates, and signature values at most.
TIES, MOST_HASHES = 2, 192
#: Texts and n-grams of one block of a large candidate group: they bound a verifying task.
BLOCK_TEXTS, BLOCK_GRAMS = 256, 1 << 18


def recall_of(bands: int, rows: int, similarity: float, ties: int = TIES) -> float:
    """Chance that two texts of the given similarity share ``ties`` bands or more."""
    p = similarity ** rows
    return 1 - sum(math.comb(bands, i) * p ** i * (1 - p) ** (bands - i) for i in range(ties))


def choose_bands(similarity: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, thus the fewest chance collisions, that reach the recall within ``most`` hashes."""
    for rows in range(most, 0, -1):
        bands = next((b for b in range(TIES, most // rows + 1) if recall_of(b, rows, similarity) >= recall), None)
        if bands:
            return bands, rows
    raise ValueError("no bands reach this recall within so many hashes")


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """MinHash signatures, one column a text that has shingles (bounds without empty texts), ``count`` rows."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64)).astype(np.uint32)
    out = np.empty((count, len(bounds) - 1), np.uint32)
    scratch = np.empty_like(short)
    for k in range(count):
        np.bitwise_xor(short, seeds[2 * k], out=scratch)
        np.multiply(scratch, seeds[2 * k + 1] | np.uint32(1), out=scratch)
        out[k] = np.minimum.reduceat(scratch, bounds[:-1])
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash a band and text, of the band's number and its rows."""
    out = np.empty((signature.shape[1], bands), np.int64)
    for b in range(bands):
        h = np.full(signature.shape[1], b + 1, np.uint64)
        for row in signature[b * rows:(b + 1) * rows]:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + row)
        out[:, b] = h.view(np.int64)
    return out


def with_bands(texts: DataFrame, ngram: int, bands: int, rows: int) -> DataFrame:
    """(key, digest, grams, bands) of rows (key, digest, text); texts without a word get no bands."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            grams, found = np.zeros(len(raw), np.int64), [np.zeros(0, np.int64)] * len(raw)
            for first, hashes, bounds in shingle_sets(raw, ngram):
                sizes = np.diff(bounds)
                grams[first:first + len(sizes)] = sizes
                full = np.flatnonzero(sizes)
                if len(full):
                    hashed = band_hashes(signatures(hashes, np.append(bounds[full], bounds[-1]), bands * rows), bands, rows)
                    for i, own in zip(full, hashed, strict=True):
                        found[first + i] = own
            yield pd.DataFrame({"key": batch["key"], "digest": batch["digest"], "grams": grams, "bands": found})

    return texts.mapInPandas(run, f"key {texts.schema['key'].dataType.simpleString()}, digest string, grams bigint, bands array<bigint>")


def links(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Boolean matrix: which of the n-gram sets (sorted, distinct) have a Jaccard similarity of at least ``similarity``.

    n-grams that occur in the same texts are counted together, so near copies cost few distinct columns.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    grams, gram = np.unique(np.concatenate(sets), return_inverse=True)
    marks = mixed(np.arange(1, n + 1, dtype=np.uint64))  # a set of texts is known by the sum of its texts' marks
    of_gram = np.zeros(len(grams), np.uint64)
    np.add.at(of_gram, gram, marks[owner])
    uses = np.bincount(gram, minlength=len(grams))
    _, lead, column, weight = np.unique(of_gram, return_index=True, return_inverse=True, return_counts=True)
    wanted = np.flatnonzero(uses[lead] > 1)  # n-grams of one text meet in no pair
    shared = np.zeros((n, n))
    leads = np.isin(gram, lead[wanted])
    place = np.full(len(weight), -1)
    place[wanted] = np.arange(len(wanted))
    rows, columns = owner[leads], place[column[gram[leads]]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    step = 2048
    for start in range(0, len(wanted), step):
        a, b = np.searchsorted(columns, [start, start + step])
        here = np.zeros((n, min(step, len(wanted) - start)), np.float32)
        here[rows[a:b], columns[a:b] - start] = 1
        shared += (here * weight[wanted[start:start + step]].astype(np.float32)) @ here.T
    shared = np.rint(shared).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - shared
    out = shared * 10**6 >= round(similarity * 10**6) * union
    np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a boolean link matrix, as pairs of places."""
    n, seen, out = len(linked), np.zeros(len(linked), bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            at = stack.pop()
            fresh = np.flatnonzero(linked[at] & ~seen)
            seen[fresh] = True
            out += [(at, int(x)) for x in fresh]
            stack += fresh.tolist()
    return out


def verified(members: DataFrame, ngram: int, similarity: float) -> DataFrame:
    """Of rows (grp, one, two, block, key, copies, text): per text its verified links and one pair of the forest.

    Blocks ``one`` and ``two`` of a group meet in one task; within a block pairs count where one = two. Rows out:
    (key, texts, docs, other): links to so many texts and documents, and a text that the forest ties it to, or null.
    """
    small_batches(members.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups(batches, ["grp", "one", "two"]):
            group = group.drop_duplicates("key")
            if len(group) < 2:
                continue
            sets = []
            for _, hashes, bounds in shingle_sets([t.encode() for t in group["text"]], ngram):
                sets += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            linked = links(sets, similarity)
            block = group["block"].values
            if group["one"].iloc[0] != group["two"].iloc[0]:
                linked &= block[:, None] != block[None, :]
            keys, copies = group["key"].values, group["copies"].values
            pairs = forest(linked)
            yield pd.DataFrame({"key": keys, "texts": linked.sum(axis=1), "docs": linked @ copies, "other": pd.array([None] * len(keys), "Int64")})
            if pairs:
                yield pd.DataFrame({"key": keys[[a for a, _ in pairs]], "texts": 0, "docs": 0,
                                    "other": pd.array(keys[[b for _, b in pairs]], "Int64")})

    # a given number: verifying costs far more than its bytes tell, so tasks are not to be merged by bytes
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartition(tasks, "grp", "one", "two").sortWithinPartitions("grp", "one", "two", "key")
    return dealt.mapInPandas(run, "key bigint, texts bigint, docs bigint, other bigint")


def digest_of(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def classified(docs: DataFrame, key: str, text: str, ngram: int, similarity: float, recall: float) -> DataFrame:
    """The rows of ``near_duplicates`` with the key as ``key`` and the digest of the text."""
    bands, rows = choose_bands(similarity, recall)
    whole = docs.select(F.col(key).cast("bigint").alias("key"), digest_of(F.col(text)).alias("digest"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    banded = written(with_bands(whole, ngram, bands, rows), "bands")
    worded = banded.where("grams > 0")
    classes = written(worded.groupBy("digest").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams"),
        F.first("bands").alias("bands")), "classes")

    # ties of bucket members to the smallest and the largest id; both sides are keyed by the band hash
    hashed = classes.where("rep IS NOT NULL").select("rep", F.explode("bands").alias("bucket"))
    buckets = hashed.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    ends = F.array(F.when(F.col("rep") > F.col("lo"), F.struct(F.col("lo").alias("a"), F.col("rep").alias("b"))),
                   F.when((F.col("rep") > F.col("lo")) & (F.col("rep") < F.col("hi")),
                          F.struct(F.col("rep").alias("a"), F.col("hi").alias("b"))))
    ties = (hashed.join(buckets, "bucket").select(F.explode(F.array_compact(ends)).alias("t")).select("t.a", "t.b")
            .groupBy("a", "b").count().where(F.col("count") >= TIES))
    candidates = written(components(ties), "candidates")

    # candidate groups, in blocks that bound the texts and n-grams of one task
    sized = candidates.join(classes.select("rep", "digest", "copies", "grams"), F.col("id") == F.col("rep"))
    blocks = sized.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("grams") / BLOCK_GRAMS)).alias("blocks"))
    members = (sized.join(blocks, "root")
               .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
               .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
               .select(F.col("root").alias("grp"), F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"),
                       "block", F.col("rep").alias("key"), "digest", "copies"))
    checked = written(verified(whole.join(members, ["key", "digest"]).select("grp", "one", "two", "block", "key", "copies", "text"),
                               ngram, similarity), "links")
    counts = checked.groupBy("key").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    near = components(checked.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    per_class = written(
        classes.select("digest", "rep", "copies")
        .join(counts, F.col("rep") == F.col("key"), "left").drop("key")
        .join(near, F.col("rep") == F.col("id"), "left")
        .select("digest", F.col("rep").alias("copy_of"), F.coalesce("root", "rep").alias("class_id"),
                (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
                F.coalesce("texts", F.lit(0)).cast("bigint").alias("n_text_links")), "classes")
    return banded.select("key", "digest").join(per_class, "digest", "left").select(
        "key", "digest", F.coalesce("class_id", "key").alias("class_id"), F.coalesce("copy_of", "key").alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("bigint").alias("n_text_links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM,
                    similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row a document: ``key``, class_id (smallest key of its near-duplicate class), copy_of (smallest key of the
    documents with the very same text), n_links (documents linked to it, copies included) and n_text_links (different
    texts linked to it).

    ``key`` is an integer. Texts of fewer than ``ngram`` words are one n-gram of all their words. Null texts and texts
    without a word link to nothing: copy_of and class_id are their own key. A null key is kept; such rows count as
    copies but never name a class unless their text has no other key. Repeated rows give repeated results and count as
    copies. Other columns are not read. An empty table gives no rows.
    """
    return classified(docs, key, text, ngram, similarity, recall).drop("digest").withColumnRenamed("key", key)


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM,
                            similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without near duplicates, with their columns as they are: of each class the document of the
    smallest key stays (once, if its row is repeated). Texts without a word are in no class and stay. Of rows with a null
    key, one a text stays if no row with a key has that text."""
    classes = classified(docs, key, text, ngram, similarity, recall)
    stay = classes.where(F.col("class_id").eqNullSafe(F.col("key"))).select(
        F.col("key").alias("stays"), F.coalesce("digest", F.lit("")).alias("of")).distinct()
    own = docs.select(F.struct("*").alias("doc"), F.col(key).cast("bigint").alias("key"),  # no column of documents can clash
                      F.coalesce(digest_of(F.col(text)), F.lit("")).alias("digest"))
    return (own.join(stay, F.col("key").eqNullSafe(F.col("stays")) & (F.col("digest") == F.col("of")))
            .dropDuplicates(["key", "digest"]).select("doc.*"))


#: DuckDB's form of ``near_duplicates`` over documents: all pairs of texts that share an n-gram, exactly.
SQL = r"""
WITH RECURSIVE texts AS (
  SELECT text AS t, min(doc_id) AS rep, count(*) AS copies, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY text),
grams AS (
  SELECT DISTINCT rep, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts) x),
sizes AS (SELECT rep, count(*) AS n FROM grams GROUP BY rep),
shared AS (SELECT a.rep AS a, b.rep AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.rep <> b.rep GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.rep = a JOIN sizes y ON y.rep = b WHERE 5 * s.n >= 4 * (x.n + y.n - s.n)),
reach(a, b) AS (SELECT rep, rep FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
classes AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a AS rep, count(*) AS others, sum(copies) AS docs FROM links JOIN texts ON texts.rep = b GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(t.rep, doc_id) AS copy_of,
  (coalesce(copies, 1) - 1 + coalesce(docs, 0))::BIGINT AS n_links, coalesce(others, 0)::BIGINT AS n_text_links
FROM documents d LEFT JOIN texts t ON d.text = t.t LEFT JOIN classes c ON c.rep = t.rep LEFT JOIN counts n ON n.rep = t.rep
"""
