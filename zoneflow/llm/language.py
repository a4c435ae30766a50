"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of lower-cased text: contexts of up to ``ORDER`` bytes, as deep as the training
sample knows them. In a context with N observations of q different bytes, a byte seen c times has probability c / (N + q);
the escape probability q / (N + q) goes to the bytes not seen there, in proportion to their probability in the next shorter
context (so probabilities add up to one), down to the uniform distribution. With frozen statistics each (context, byte) has
one code length per language, so a text's exact code length is a sum of table entries; the shortest one wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import held_out, small_batches
from zoneflow.llm.shingles import chunks

#: Bounds of the training sample: texts of a language, texts in all, bytes of a text.
PER_LANGUAGE, SAMPLE, TEXT_BYTES = 400, 20_000, 20_000
#: Longest context; bytes told apart (the rarer ones count as one); observations that make a context; table entries of all
#: languages together (15,625 contexts with four languages; more languages share them, the commonest contexts first).
ORDER, SYMBOLS, LEAST, ENTRIES = 3, 128, 4, 8_000_000
#: Bytes scored at once.
CHUNK = 500_000
#: What stands before a text's first byte.
START = 10
UNDETERMINED = "und"


@dataclass
class Model:
    """``deepest``: the deepest context's number for each history of ORDER symbols; ``lengths``: code lengths in nats, a
    row for each context and symbol, a column a language."""

    languages: list[str]
    symbol: np.ndarray
    deepest: np.ndarray
    lengths: np.ndarray


def as_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def histories(symbols: np.ndarray, base: int) -> np.ndarray:
    """For symbols with ORDER start symbols before them: the number of the ORDER symbols before each."""
    out = np.zeros(len(symbols) - ORDER, np.int32)
    for j in range(ORDER):
        out *= base
        out += symbols[j:len(symbols) - ORDER + j]
    return out


def train(texts: dict[str, list[bytes]]) -> Model:
    """A model of the texts of each language."""
    languages = sorted(texts)
    if not languages:
        return Model([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    counts = np.zeros(256, np.int64)
    for t in texts.values():
        for x in t:
            counts += np.bincount(np.frombuffer(x, np.uint8), minlength=256)
    counts[START] += 1
    common = [b for b in np.argsort(-counts, kind="stable")[:SYMBOLS - 1] if counts[b]]
    base = len(common) + 1
    symbol = np.full(256, base - 1, np.uint8)
    symbol[common] = np.arange(base - 1)
    prefix = np.full(ORDER, symbol[START], np.uint8)

    # counts of (history, symbol) by language, in one pass over the sample
    size = len(languages)
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    for language in languages:
        codes = []
        for x in texts[language]:
            s = np.concatenate([prefix, symbol[np.frombuffer(x, np.uint8)]])
            codes.append(histories(s, base).astype(np.int64) * base + s[ORDER:])
        seen.append(np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_counts=True))

    most = max(1, ENTRIES // (base * size))
    deepest = np.zeros(base**ORDER, np.int32)
    parents_of = None
    probabilities = [np.full((1, base, size), 1 / base)]  # number 0: below the empty context
    numbers = 1
    for order in range(ORDER + 1):
        span = base**order
        context_counts = []
        for codes, n in seen:
            context = (codes // base) % span
            pair, place = np.unique(context * base + codes % base, return_inverse=True)
            context_counts.append((pair, np.bincount(place, n, len(pair))))
        every = np.concatenate([p // base for p, _ in context_counts])
        weights = np.concatenate([c for _, c in context_counts])
        contexts, place = np.unique(every, return_inverse=True)
        total = np.bincount(place, weights, len(contexts))
        keep = np.flatnonzero(total >= (LEAST if order else 1))
        room = most - numbers
        if len(keep) > room:
            keep = np.sort(keep[np.argsort(-total[keep], kind="stable")[:max(0, room)]])
        contexts = contexts[keep]
        if not len(contexts):
            break
        # the next shorter context drops the oldest symbol; the deepest one known so far stands in for a missing one
        if order == 0:
            parent = np.zeros(1, np.int64)
        else:
            parent = deepest_of(parents_of, contexts % (span // base))
        below = np.concatenate(probabilities)[parent]
        own = np.zeros((len(contexts), base, size))
        for k, (pair, c) in enumerate(context_counts):
            at = np.searchsorted(contexts, pair // base)
            at[at == len(contexts)] = 0
            known = contexts[at] == pair // base
            own[at[known], (pair % base)[known], k] = c[known]
        n = own.sum(axis=1, keepdims=True)
        q = (own > 0).sum(axis=1, keepdims=True)
        unseen = np.where(own > 0, 0, below)
        left = unseen.sum(axis=1, keepdims=True)
        escaped = np.where(left > 0, q / np.maximum(n + q, 1) * unseen / np.where(left > 0, left, 1), 0)
        p = np.where(n > 0, np.where(own > 0, own / np.maximum(n + np.where(left > 0, q, 0), 1), escaped), below)
        probabilities.append(p)
        parents_of = (contexts, numbers, parents_of, span)
        numbers += len(contexts)
        # histories that end in these contexts
        view = deepest.reshape(-1, span)
        view[:, contexts] = numbers - len(contexts) + np.arange(len(contexts), dtype=np.int32)
    table = np.concatenate(probabilities)
    return Model(languages, symbol, deepest, -np.log(np.maximum(table, 1e-12)).reshape(-1, size).astype(np.float32))


def deepest_of(levels: tuple | None, contexts: np.ndarray) -> np.ndarray:
    """Numbers of the deepest known contexts that the given contexts end in."""
    out = np.zeros(len(contexts), np.int64)
    chain = []
    while levels is not None:
        chain.append(levels)
        levels = levels[2]
    for known, first, _, span in reversed(chain):  # from the empty context on
        here = contexts % span
        at = np.searchsorted(known, here)
        at[at == len(known)] = 0
        found = known[at] == here
        out[found] = first + at[found]
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Exact code length of each text, a column a language (in nats)."""
    base = round(len(model.deepest) ** (1 / ORDER))
    out = np.zeros((len(texts), len(model.languages)))
    start = bytes([START]) * ORDER
    for a, b in chunks(texts, CHUNK):
        symbols = model.symbol[np.frombuffer(start + start.join(texts[a:b]), np.uint8)]
        row = model.deepest[histories(symbols, base)] * base + symbols[ORDER:]
        sizes = np.array([len(t) for t in texts[a:b]])
        ends = np.cumsum(sizes + ORDER) - ORDER
        lengths = model.lengths
        for i, (e, n) in enumerate(zip(ends, sizes, strict=True)):
            if n:
                # entries are summed in double precision, in pieces so that memory stays small
                own = row[e - n:e]
                out[a + i] = sum(lengths[own[k:k + CHUNK]].sum(axis=0, dtype=np.float64) for k in range(0, n, CHUNK))
    return out


def chosen_rows(rows: DataFrame, per_language: int) -> DataFrame:
    """(key, lang) of at most ``per_language`` rows (key, lang, long) of each language, by the hash of the key; long texts come last.

    A bound on the hash that leaves about four times as many rows of a language comes before they are ordered, so no task
    receives many rows of a language, however many there are."""
    sizes = rows.groupBy("lang", "long").agg(F.count(F.lit(1)).alias("n"))
    mark = F.xxhash64(F.col("key").cast("string"))
    place = (mark.cast("double") + 2.0**63) / 2.0**64
    few = rows.join(sizes, ["lang", "long"]).where(place * F.col("n") <= 4 * per_language + 100)
    order = Window.partitionBy("lang").orderBy("long", mark, "key")
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("key", "lang").distinct()


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model of the languages in ``lang``, from at most ``per_language`` texts of each (``SAMPLE`` in all) that are not
    held out; texts are chosen by the hash of their key among those that are not null.

    Texts of more than ``TEXT_BYTES`` bytes are learnt from only where a language has too few others, and then from that many bytes of
    their middle. With several languages on one key the first by name counts, with several texts the smallest."""
    rows = docs.where(~held_out(key) & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), (F.octet_length(text) > TEXT_BYTES).alias("long"))
    chosen = chosen_rows(rows, per_language).groupBy("key").agg(F.min("lang").alias("lang"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(SAMPLE))  # SAMPLE rows at most
    middle = F.substring(F.col("text"), (F.char_length("text") / 2 - TEXT_BYTES / 8).cast("int"), F.lit(TEXT_BYTES // 4))
    cut = F.when(F.octet_length("text") > TEXT_BYTES, middle).otherwise(F.col("text"))
    found = (docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
             .select("key", cut.alias("text")).join(chosen, "key").groupBy("key", "lang").agg(F.min("text").alias("text")))
    texts: dict[str, list[bytes]] = {}
    for r in sorted(found.collect(), key=lambda r: r.key):
        texts.setdefault(r.lang, []).append(as_bytes(r.text))
    return train(texts)


def predictor(docs: DataFrame, model: Model):
    """A function from a text column to struct<lang_pred, score>, for use on ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most ENTRIES code lengths of four bytes and SYMBOLS**ORDER numbers
    held: dict[str, Model] = {}

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if not held:
            held["model"] = shared.value
        m = held["model"]
        lettered = np.array([bool(m.languages) and has_letter(t) for t in texts], bool)
        names, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        if lettered.any():
            lengths = code_lengths(m, [as_bytes(t) for t in texts[lettered]])
            ahead = np.exp(lengths.min(axis=1, keepdims=True) - lengths)
            names[lettered] = np.array(m.languages, object)[lengths.argmin(axis=1)]
            scores[lettered] = 1 / ahead.sum(axis=1)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row a document: ``key``, held_out, lang_pred and score, the probability of that language if all are alike likely.

    Null texts and texts without a letter, and all texts if no language could be learnt, are ``und`` with score 0. Of
    languages with equal code lengths the first by name wins. A null key is not held out, and not learnt from. Repeated
    rows give equal results, other columns are not read, an empty table gives no rows.
    """
    predict = predictor(docs, learn(docs, key, text, lang, per_language))
    return docs.select(F.col(key), held_out(key).alias("held_out"), predict(F.col(text)).alias("_p")).select(
        key, "held_out", "_p.lang_pred", "_p.score")
