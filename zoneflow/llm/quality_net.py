"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into blocks of ``BLOCK`` bytes; two neighbouring blocks make a chunk, so chunks overlap by half and cover the
whole text. Each byte has a learnt vector, learnt filters run over ``WIDTH`` bytes at every ``STRIDE`` bytes, and each filter's
largest response in a chunk is kept. A hidden layer reads these; its mean over all chunks gives one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import held_out, sample_texts, small_batches

#: Bounds of the training sample: texts, bytes of a text.
SAMPLE, TEXT_BYTES = 4000, 100_000
#: The network.
BLOCK, WIDTH, STRIDE, DEPTH, FILTERS, HIDDEN = 128, 6, 2, 8, 32, 16
#: Training: steps and passes at least, texts of a batch, blocks of a text in a pass (a random run of them), step, weight decay.
STEPS, PASSES, BATCH, RUN, STEP, DECAY = 1500, 12, 32, 16, 4e-3, 1e-4
#: Blocks scored at once.
AT_ONCE = 2048
HALO = WIDTH - STRIDE

Net = dict[str, np.ndarray]


def blocks_of(text: bytes) -> np.ndarray:
    """All blocks of a text, one a row, each with the first ``HALO`` bytes of the next; zero bytes after the end."""
    count = max(1, -(-len(text) // BLOCK))
    padded = np.zeros(count * BLOCK + HALO, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, BLOCK + HALO)[::BLOCK]


def fresh(seed: int = 0) -> Net:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {"bytes": normal(256, DEPTH, scale=0.5), "filters": normal(WIDTH * DEPTH, FILTERS, scale=(WIDTH * DEPTH) ** -0.5),
            "filter_bias": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS, HIDDEN, scale=FILTERS ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=HIDDEN ** -0.5), "out_bias": np.zeros(1, np.float32)}


def windows_of(net: Net, blocks: np.ndarray) -> np.ndarray:
    """(block, place, WIDTH * DEPTH): the byte vectors under each place of the filters."""
    vectors = net["bytes"][blocks]
    view = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH, axis=1)[:, ::STRIDE]  # (block, place, DEPTH, WIDTH)
    return view.transpose(0, 1, 3, 2).reshape(len(blocks), -1, WIDTH * DEPTH)


def responses(net: Net, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, and each filter's largest response in each block with its place."""
    under = windows_of(net, blocks)
    raw = (under.reshape(-1, WIDTH * DEPTH) @ net["filters"]).reshape(len(blocks), -1, FILTERS)
    at = raw.argmax(axis=1)
    top = np.take_along_axis(raw, at[:, None], axis=1)[:, 0] + net["filter_bias"]
    return under, np.maximum(top, 0), at


def chunked(top: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The larger responses of each block and the next block of the same text, and which of the two has them."""
    following = np.vstack([top[1:], top[-1:]])
    second = (following > top) & ~last[:, None]
    return np.where(second, following, top), second


def logits(net: Net, texts: list[bytes]) -> np.ndarray:
    """One logit a whole text; long texts go through in pieces, so memory stays small."""
    out = np.zeros(len(texts))
    rows = [blocks_of(t) for t in texts]
    sums, counts = np.zeros((len(texts), HIDDEN)), np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(texts)), counts)
    every = np.vstack(rows) if rows else np.zeros((0, BLOCK + HALO), np.uint8)
    tops = np.empty((len(every), FILTERS), np.float32)
    for k in range(0, len(every), AT_ONCE):
        under = windows_of(net, every[k:k + AT_ONCE])
        raw = (under.reshape(-1, WIDTH * DEPTH) @ net["filters"]).reshape(under.shape[0], -1, FILTERS)
        tops[k:k + AT_ONCE] = np.maximum(raw.max(axis=1) + net["filter_bias"], 0)
    if len(every):
        last = np.append(owner[1:] != owner[:-1], True)
        chunk, _ = chunked(tops, last)
        hidden = np.maximum(chunk @ net["hidden"] + net["hidden_bias"], 0)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        sums = np.add.reduceat(hidden.astype(np.float64), starts, axis=0)
        out = (sums / counts[:, None]) @ net["out"].astype(np.float64) + float(net["out_bias"][0])
    return out


def gradients(net: Net, blocks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> Net:
    """Gradients of the mean logistic loss of texts whose blocks are the rows of ``blocks`` (``owner``: the text's place)."""
    n, counts = len(labels), np.bincount(owner, minlength=len(labels))
    under, top, at = responses(net, blocks)
    last = np.append(owner[1:] != owner[:-1], True)
    chunk, second = chunked(top, last)
    hidden = np.maximum(chunk @ net["hidden"] + net["hidden_bias"], 0)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mean = np.add.reduceat(hidden, starts, axis=0) / counts[:, None]
    g = mean @ net["out"] + net["out_bias"][0]
    dg = ((1 / (1 + np.exp(-np.clip(g, -30, 30))) - labels) / n).astype(np.float32)
    d: Net = {"out": mean.T.astype(np.float32) @ dg, "out_bias": dg.sum(keepdims=True)}
    d_hidden = (dg / counts).astype(np.float32)[owner][:, None] * net["out"] * (hidden > 0)
    d["hidden"], d["hidden_bias"] = chunk.T @ d_hidden, d_hidden.sum(axis=0)
    d_chunk = d_hidden @ net["hidden"].T
    d_top = np.where(second, 0, d_chunk)
    d_top[1:] += np.where(second, d_chunk, 0)[:-1]
    d_top *= top > 0
    d["filter_bias"] = d_top.sum(axis=0)
    used = np.take_along_axis(under, at[:, :, None], axis=1)  # (block, filter, WIDTH * DEPTH): the window that won
    d["filters"] = np.einsum("bfw,bf->wf", used, d_top, optimize=True)
    row, col = np.nonzero(d_top)
    back = (d_top[row, col][:, None] * net["filters"].T[col]).reshape(-1, DEPTH)
    place = (at[row, col] * STRIDE)[:, None] + np.arange(WIDTH)
    which = blocks[row[:, None], place].ravel()
    d["bytes"] = np.stack([np.bincount(which, back[:, j], 256) for j in range(DEPTH)], axis=1).astype(np.float32)
    return d


def train(texts: list[bytes], labels: np.ndarray, seed: int = 0) -> Net:
    """Adam on random runs of blocks of each text; scoring later covers whole texts."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    if not len(texts):
        return net
    passes = max(PASSES, -(-STEPS * BATCH // len(texts)))
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    net["out_bias"][0] = np.log(rate / (1 - rate))
    rows = [blocks_of(t) for t in texts]
    first, second, steps = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}, 0
    for turn in range(passes):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            own = []
            for i in order[k:k + BATCH]:
                start = rng.integers(0, max(1, len(rows[i]) - RUN + 1))
                own.append(rows[i][start:start + RUN])
            owner = np.repeat(np.arange(len(own)), [len(x) for x in own])
            d = gradients(net, np.vstack(own), owner, labels[order[k:k + BATCH]])
            steps += 1
            step = STEP * (1 - turn / passes)
            for name, w in net.items():
                grad = d[name] + DECAY * w
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                w -= (step * (first[name] / (1 - 0.9**steps)) / (np.sqrt(second[name] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Net:
    """The network of at most ``sample`` labelled texts that are not held out, chosen by the hash of their key."""
    known = labels.where(~held_out(key) & F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("_label"))
    rows = sample_texts(docs, known, sample, TEXT_BYTES, key, text)
    return train([t.encode() for _, t, _ in rows], np.array([y for *_, y in rows], np.float32))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = 0.3) -> DataFrame:
    """One row a document: ``key``, held_out, score (probability of label 1) and predicted (score >= ``threshold``).

    Null and empty texts are one block of zero bytes and score as such. A null key is not held out; repeated rows score
    alike; other columns are not read. Without labels the untrained network scores. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, 64)
    net = spark.sparkContext.broadcast(learn(docs, labels, key, text, label))  # a fixed number of weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            g = logits(net.value, [t.encode() for t in batch])
            yield pd.Series(1 / (1 + np.exp(-np.clip(g, -700, 700))))

    return docs.select(key, held_out(key).alias("held_out"), score(F.coalesce(F.col(text), F.lit(""))).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
