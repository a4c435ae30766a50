"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts is unlabelled, whatever they may be. With the
class prior, the share of toxic texts, the risk of a classifier g is estimated without any confirmed clean text:

    prior * E_P[loss(g, +)]  +  max(0, E_U[loss(g, -)] - prior * E_P[loss(g, -)])

The second term estimates the clean texts' risk; it is kept from falling below 0, where a flexible model would only fit
the unlabelled sample. When a batch's estimate is below 0, the step goes against it instead.

The class prior is estimated from the same two samples: where a classifier finds positives that it did not learn from, it also finds
their share of the unlabelled texts, and more only by mistake, so the least ratio of the two over all thresholds is the prior.

The classifier is linear in the densities of hashed words and word beginnings, so a text's score is a sum of one number a
word. It is trained in numpy by one task, from a sample whose rows and bytes are bounded by parameters; the driver gets the weights.
"""

from __future__ import annotations

import re
import zlib
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.blocks import chosen_texts
from zoneflow.llm.common import held_out, small_batches

#: Bounds of the training sample: confirmed toxic texts, unlabelled texts, and bytes of a text that may be in it.
POSITIVES, UNLABELLED, TEXT_BYTES = 2000, 4000, 100_000
#: Hashed features; lengths of the word beginnings; texts of the sample that must have a feature.
FEATURES, BEGINNINGS, LEAST_TEXTS = 1 << 18, (3, 4, 5, 6, 7), 4
#: Training: passes, texts of a batch, step, weight decay (more for few positives); one of so many positives is kept to place
#: the threshold.
PASSES, BATCH, STEP, DECAY, KEPT = 20, 512, 0.05, 1e-3, 5
#: Prior of the first training, which only serves to estimate the prior; bounds of the estimate, and the share of the positives that
#: the thresholds it looks at have to find.
FIRST_PRIOR, LEAST_PRIOR, MOST_PRIOR, SURE = 0.1, 1e-4, 0.9, 0.5
#: Runs of more letters than this are clauses of a script without spaces, or several words in one: of them all grams of so
#: many letters are features too, and each ``WORD`` letters count as a word.
LONG_RUN, GRAM, WORD = 20, 4, 6
#: Scale of the densities: words added to a text's own, and the power of the sum.
PRIOR_WORDS, POWER = 10, 0.6
#: Words that one worker remembers.
REMEMBERED = 500_000
RUN = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed features of a lower-case token: each run of letters as a whole, and its beginnings; of a very long one also
    all that stands inside."""
    out = []
    for run in RUN.findall(word):
        if len(run) > LONG_RUN:
            out += [zlib.crc32(b"~" + run[i:i + GRAM].encode()) % FEATURES for i in range(len(run) - GRAM + 1)]
        out.append(zlib.crc32(b"=" + run.encode()) % FEATURES)
        out += [zlib.crc32(run[:n].encode()) % FEATURES for n in BEGINNINGS if len(run) >= n]
    return out


def tokens(text: str | None) -> set[str]:
    """The different lower-case tokens of a text: repeating a word a thousand times counts once."""
    return set((text or "").lower().split())


class Sparse:
    """Texts as sparse rows: column ``cols[first[i]:first[i + 1]]`` with ``values`` for text i."""

    def __init__(self, texts: list[str | None]):
        known: dict[str, np.ndarray] = {}
        rows = []
        for t in texts:
            words = tokens(t)
            for w in words:
                if w not in known:
                    known[w] = np.array(features(w), np.int32)
            cols, n = np.unique(np.concatenate([known[w] for w in words] or [np.zeros(0, np.int32)]), return_counts=True)
            rows.append((cols.astype(np.int32), (n / density(word_count(words))).astype(np.float32)))
        seen = np.zeros(FEATURES, np.int32)
        for cols, _ in rows:
            seen[cols] += 1
        rows = [(c[k], v[k]) for c, v in rows for k in [seen[c] >= LEAST_TEXTS]]
        self.rows = rows

    def batch(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text's place in the batch, column, value) of all entries."""
        own = [self.rows[i] for i in which]
        at = np.repeat(np.arange(len(own)), [len(c) for c, _ in own])
        return at, np.concatenate([c for c, _ in own]), np.concatenate([v for _, v in own])


def word_count(words: set[str]) -> int:
    """Different tokens, of which very long ones count as several words."""
    return len(words) + sum(len(w) // WORD for w in words if len(w) > LONG_RUN)


def density(words: int) -> float:
    """What a text's sum over its different tokens is divided by: less than their number, as long texts dilute insults."""
    return (words + PRIOR_WORDS) ** POWER / 2


def train(positives: list[str], unlabelled: list[str], prior: float, passes: int = PASSES, seed: int = 0) -> np.ndarray:
    """Weights of the features, then the bias: nnPU with the logistic loss and Adam steps."""
    data = Sparse(positives + unlabelled)
    p, u = np.arange(len(positives)), len(positives) + np.arange(len(unlabelled))
    rng = np.random.default_rng(seed)
    w = np.zeros(FEATURES + 1)
    first, second, steps = np.zeros_like(w), np.zeros_like(w), 0
    if not len(p) or not len(u):  # nothing to learn from: every text scores the prior
        w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return w
    w[-1] = np.log(prior / (1 - prior))
    count = max(1, -(-len(u) // BATCH))
    decay = DECAY * (1 + 100 / len(p))
    for turn in range(passes):
        parts_p, parts_u = np.array_split(rng.permutation(p), count), np.array_split(rng.permutation(u), count)
        for mine, theirs in zip(parts_p, parts_u, strict=True):
            if not len(mine) or not len(theirs):
                continue
            at, col, val = data.batch(np.concatenate([mine, theirs]))
            n = len(mine) + len(theirs)
            g = w[-1] + np.bincount(at, val * w[col], n)
            toxic = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            gp, gu = g[:len(mine)], g[len(mine):]
            clean_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            dg = np.zeros(n)
            if clean_risk >= 0:
                dg[:len(mine)] = prior * (toxic[:len(mine)] - 1) / len(mine) - prior * toxic[:len(mine)] / len(mine)
                dg[len(mine):] = toxic[len(mine):] / len(theirs)
            else:  # against the estimate of the clean risk alone
                dg[:len(mine)] = prior * toxic[:len(mine)] / len(mine)
                dg[len(mine):] = -toxic[len(mine):] / len(theirs)
            grad = np.bincount(col, val * dg[at], FEATURES + 1)
            grad[-1] = dg.sum()
            grad[:-1] += decay * w[:-1]
            steps += 1
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
            w -= STEP * (1 - turn / passes) * (first / (1 - 0.9 ** steps)) / (np.sqrt(second / (1 - 0.999 ** steps)) + 1e-8)
    return w


def placed(w: np.ndarray, positives: list[str], unlabelled: list[str], prior: float) -> np.ndarray:
    """``w`` with the bias moved so that probability 1/2 has the least estimated 0-1 risk, on positives kept from training.

    The risk is the same estimate with the 0-1 loss: prior * missed + max(0, found in unlabelled - prior * found)."""
    known = Weights(w)
    p, u = (np.sort([logit(known, t) for t in part]) for part in (positives, unlabelled))
    if not len(p) or not len(u):
        return w
    at = np.unique(np.concatenate([p, u]))
    cuts = np.concatenate([at[:1] - 1, (at[1:] + at[:-1]) / 2, at[-1:] + 1])
    missed = np.searchsorted(p, cuts) / len(p)
    found = 1 - np.searchsorted(u, cuts) / len(u)
    risk = prior * missed + np.maximum(0, found - prior * (1 - missed))
    least = risk.argmin()
    error = np.sqrt(found[least] * (1 - found[least]) / len(u) + prior ** 2 * missed[least] * (1 - missed[least]) / len(p))
    best = cuts[risk <= risk[least] + error / 2]  # cuts that this sample can't tell apart: their middle
    out = w.copy()
    out[-1] -= (best[0] + best[-1]) / 2
    return out


def class_prior(w: np.ndarray, positives: list[str], unlabelled: list[str]) -> float:
    """The share of positives in the unlabelled texts: the least of found in unlabelled / found in positives over the thresholds that find
    ``SURE`` of the positives, found in unlabelled moved up by its standard error. Both were kept from training."""
    known = Weights(w)
    p, u = (np.sort([logit(known, t) for t in part]) for part in (positives, unlabelled))
    if not len(p) or not len(u):
        return FIRST_PRIOR
    found_p = 1 - np.searchsorted(p, p) / len(p)
    found_u = len(u) - np.searchsorted(u, p)
    found_u = (found_u + np.sqrt(found_u + 1)) / len(u)
    sure = found_p >= SURE
    return float(np.clip((found_u[sure] / found_p[sure]).min(), LEAST_PRIOR, MOST_PRIOR))


def estimated_prior(learnt: list[str], kept: list[str], unlabelled: list[str]) -> float:
    """The class prior of the unlabelled texts, by a classifier that learns from ``learnt`` and a part of them. Texts that
    are among ``learnt`` are known positives: they are counted, not judged."""
    known, share = set(learnt), 0.0
    judged = unlabelled[::KEPT]
    if judged:
        share = sum(t in known for t in judged) / len(judged)
        judged = [t for t in judged if t not in known]
    w = train(learnt, [t for i, t in enumerate(unlabelled) if i % KEPT], FIRST_PRIOR, PASSES // 2)
    return share + (1 - share) * class_prior(w, kept, judged)


def fit(positives: list[str], unlabelled: list[str], prior: float | None = None) -> np.ndarray:
    """Train without some positives, which then give the prior, if that is not given, and place the threshold."""
    learnt, kept = [t for i, t in enumerate(positives) if i % KEPT], positives[::KEPT]
    if prior is None:
        prior = estimated_prior(learnt, kept, unlabelled)
    return placed(train(learnt, unlabelled, prior), kept, unlabelled, prior)


class Weights(dict):
    """Score of one token, remembered up to a bound."""

    def __init__(self, w: np.ndarray):
        super().__init__()
        self.w = w

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = float(self.w[features(word)].sum()) if word else 0.0
        return out


def logit(known: Weights, text: str | None) -> float:
    words = tokens(text)
    return float(known.w[-1]) + sum(map(known.__getitem__, words)) / density(word_count(words))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> np.ndarray:
    """The classifier of ``docs`` and ``labels``, from rows that are not held out.

    Positives: at most ``positives`` documents that have a label 1. Unlabelled: at most ``unlabelled`` of all documents, as the
    estimator takes them for a sample of everything; their labels are not looked at, and labels 0 are not used at all.
    ``prior``: the share of toxic texts, if it is known; else it is estimated. One task trains, on at most
    ``positives + unlabelled`` texts of ``TEXT_BYTES`` bytes.
    """
    toxic = labels.where(~held_out(key) & (F.col(label) == 1)).select(key)
    p = chosen_texts(docs, toxic, positives, TEXT_BYTES, key, text).withColumn("kind", F.lit(1))
    u = chosen_texts(docs, docs.where(~held_out(key)).select(key), unlabelled, TEXT_BYTES, key, text).withColumn("kind", F.lit(0))
    small_batches(docs.sparkSession)

    def fitted(batches):
        texts: tuple[list[str], list[str]] = ([], [])
        for batch in batches:
            for kind, mine in zip((1, 0), texts, strict=True):
                mine += batch["text"][batch["kind"] == kind].tolist()
        for mine in texts:
            mine.sort()  # in whatever order they came
        yield pd.DataFrame({"weights": [fit(*texts, prior).tobytes()]})

    sample = p.select("kind", "text").unionByName(u.select("kind", "text"))
    row = sample.repartition(1).mapInPandas(fitted, "weights binary").first()
    if row is None:  # no text at all
        return fit([], [], prior)
    return np.frombuffer(bytes(row.weights), np.float64)


def scorer(docs: DataFrame, model: np.ndarray):
    """A function from a text column to its probability of being toxic, for use on ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model.astype(np.float32))  # FEATURES + 1 numbers
    held: dict[str, Weights] = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not held:  # once a task: the words it meets are remembered
            held["weights"] = Weights(shared.value)
        known = held["weights"]
        g = np.array([logit(known, t) for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(g, -700, 700))))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
             threshold: float = 0.5) -> DataFrame:
    """One row a document: ``key``, held_out, score (probability of being toxic) and predicted (score >= ``threshold``).

    Null and empty texts score as the model's bias says; a null key is not held out; repeated rows score alike; other
    columns are not read. Without labelled toxic rows every text scores ``FIRST_PRIOR``. An empty table gives no rows.
    """
    score = scorer(docs, learn(docs, labels, key, text, label))
    return docs.select(key, held_out(key).alias("held_out"), score(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns as they are."""
    score = scorer(docs, learn(docs, labels, key, text, label))
    return docs.where(score(F.col(text)) < threshold)
