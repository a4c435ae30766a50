"""Periodic runs of words, found as maximal pairs.

A run of period q is a stretch whose words q apart are equal and that no neighbouring word extends. Its two copies shifted by q
are a maximal pair: two positions whose following words agree for as long as possible and whose words before differ. Conversely a
maximal pair at distance d that agrees for d words or more is a whole run of period d (or of a divisor of d, which
then comes up as a pair of its own with the same start and length), so pairs need no extension.

Maximal pairs are enumerated on the tree of LCP intervals, from the deepest up. An interval holds its positions in text order and
once more by the word before them. Where a smaller interval joins a larger one, each of its positions meets the larger one's positions
within reach; whole stretches with the same word before are jumped. The pairs met are at most the exponents of all runs, which
are linear in the number of words, so texts of any length and any repetition take little more than linear time.

Documents are independent: nothing is shuffled, and the frame's own partitions are kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.blocks import carried, carried_kind, text_batches

#: A run has this many words at least, and two periods.
LEAST_WORDS = 12
#: Words of one pass of the suffix sort: texts are sorted together up to so many (a longer text is a pass of its own).
PASS_WORDS = 400_000


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of a sequence of non-negative numbers, by doubling; a suffix that ends is less than one that goes on."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    size, step = len(ids), 1
    while True:
        after = np.zeros(size, np.int64)
        after[: max(size - step, 0)] = rank[step:] + 1
        key = rank * (size + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
        step *= 2
        if step >= size or rank[order[-1]] == size - 1:
            return order, rank


def common_prefixes(ids: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Words that each suffix has in common with the one before it in suffix order (0 for the first)."""
    size, common, length = len(ids), [0] * len(ids), 0
    for i in range(size):
        at = rank[i]
        if at:
            j = order[at - 1]
            while i + length < size and j + length < size and ids[i + length] == ids[j + length]:
                length += 1
            common[at] = length
            if length:
                length -= 1
        else:
            length = 0
    return common


class Interval:
    """The positions of an LCP interval: all in text order, and by the word before them."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: list[int]):
        self.places, self.classes = [place], {left[place]: [place]}

    def add(self, place: int, left: list[int]) -> None:
        insort(self.places, place)
        row = self.classes.get(left[place])
        if row is None:
            self.classes[left[place]] = [place]
        else:
            insort(row, place)

    def near(self, x: int, reach: int, left: list[int]) -> Iterator[int]:
        """Positions at most ``reach`` from x whose word before is not x's; stretches of x's own class are jumped."""
        own, mine, places = left[x], self.classes.get(left[x]), self.places
        if mine is not None and len(mine) == len(places):
            return
        for way in (1, -1):
            j = bisect_left(places, x)
            if way < 0:
                j -= 1
            while 0 <= j < len(places) and abs(places[j] - x) <= reach:
                if left[places[j]] != own:
                    yield places[j]
                    j += way
                    continue
                c = bisect_left(mine, places[j])  # the longest stretch in which both rows agree, by doubling and halving
                far, step = 0, 1
                while step:
                    n = far + step
                    a, b = j + way * n, c + way * n
                    if 0 <= a < len(places) and 0 <= b < len(mine) and places[a] == mine[b]:
                        far, step = n, step * 2
                    else:
                        step //= 2
                j += way * (far + 1)


def join(one: Interval, two: Interval, common: int, least: int, left: list[int], found: dict[tuple[int, int], int]) -> Interval:
    """The union of two child intervals; their maximal pairs that are runs go into ``found``: (start, length) -> least period."""
    if len(one.places) < len(two.places):
        one, two = two, one
    for x in two.places:
        for y in one.near(x, common, left):
            start, period = (x, y - x) if x < y else (y, x - y)
            if period + common >= least:
                at = (start, period + common)
                if found.get(at, period) >= period:
                    found[at] = period
    for x in two.places:
        one.add(x, left)
    return one


def runs_of(ids: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``least`` words or more, by start, then period.

    ``ids``: the words as numbers; several texts may follow one another if no number is in two of them.
    """
    if len(ids) < least:
        return []
    order, rank = suffix_order(ids)
    ids_, order_, rank_ = ids.tolist(), order.tolist(), rank.tolist()
    common = common_prefixes(ids_, order_, rank_)
    left = [-1, *ids_[:-1]]
    low = (least + 1) // 2  # period <= common and period + common >= least: shallower pairs are no runs
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, Interval]] = []  # open intervals: their depth rises
    current: Interval | None = None
    for at in range(1, len(ids_) + 1):
        depth = common[at] if at < len(ids_) else 0
        if current is None:
            if depth >= low:
                current = Interval(order_[at - 1], left)
                stack.append((depth, current))
                current = Interval(order_[at], left)
            continue
        # current is the suffix at-1 alone: it joins the interval on the stack once no deeper one can open with it
        while stack and stack[-1][0] > depth:
            d, held = stack.pop()
            current = join(held, current, d, least, left, found)
        if depth < low:
            stack, current = [], None
            continue
        if stack and stack[-1][0] == depth:
            d, held = stack.pop()
            current = join(held, current, d, least, left, found)
        stack.append((depth, current))
        current = Interval(order_[at], left)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repeats(ids: np.ndarray, words: int) -> bool:
    """Whether some ``words`` words come twice (by a hash, so now and then when they don't): without it there is no run."""
    if len(ids) < words + 1:
        return False
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    total = np.zeros(len(ids) - words + 1, np.uint64)
    for j in range(words):
        total = total * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : j + len(total)]
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def made_periodic(words: list[bytes], checksum: int) -> list[bytes]:
    """The words, with a periodic end where the checksum of the document's key asks for it (a fixed test pattern)."""
    g, n = checksum // 10, len(words)
    if checksum % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def describe(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the longest run (ties: smallest start, then period) and the digests of all runs and of the words kept."""
    if not runs:
        return 0, None, None, None, None, _digest(b""), _digest(b" ".join(words))
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), start, length, period, 1000 * length // period, _digest(text.encode()),
            _digest(b" ".join([words[i] for i in kept])))


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (a list of words). Texts in which no words repeat drop out by a hash; the others are sorted together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    low = (least + 1) // 2
    waiting: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if not waiting:
            return
        starts = np.cumsum([0] + [len(ids) for _, ids in waiting])
        base, parts = 0, []
        for _, ids in waiting:  # no number is in two texts
            parts.append(ids + base)
            base += int(ids.max()) + 1
        for s, n, q in runs_of(np.concatenate(parts), least):
            k = int(np.searchsorted(starts, s, "right")) - 1
            out[waiting[k][0]].append((s - int(starts[k]), n, q))
        waiting.clear()

    total = 0
    for k, words in enumerate(texts):
        if len(words) < least:
            continue
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        if len(known) == len(words) or not repeats(ids, low):
            continue
        waiting.append((k, ids))
        total += len(ids)
        if total >= PASS_WORDS:
            flush()
            total = 0
    flush()
    return out


COLUMNS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def word_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS,
              periodic_ends: bool = False, listed: bool = False, kept_text: bool = False) -> DataFrame:
    """One row a document: ``key``, n_runs, the longest run (start, length, period, exponent_milli) and the digests of all runs and
    of the words that remain when each run keeps its first period alone.

    Words are what stands between the white space of ASCII. ``listed`` adds ``runs`` (array of start, length, period), ``kept_text``
    the text without the dropped words. ``periodic_ends`` first makes the ends of some texts periodic, as ``made_periodic`` says.
    Null and empty texts have no words and no runs (four nulls, the digests of nothing); a null key stays null and its text
    as it is; repeated rows give repeated results; an empty table gives an empty one; other columns are not read, whatever their names.
    """
    text_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    columns = f"held {carried_kind(kind)}, {COLUMNS}"
    columns += ", runs array<struct<start:bigint,length:bigint,period:bigint>>" * listed
    columns += ", kept_text string" * kept_text
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode().split() for t in batch["text"]]
            if periodic_ends:
                texts = [made_periodic(w, int(c)) for w, c in zip(texts, batch["checksum"])]
            found = runs_of_texts(texts, least)
            rows = [describe(w, r) for w, r in zip(texts, found)]
            out = pd.DataFrame({"held": batch["held"].astype(object)} | {n: pd.Series([r[i] for r in rows], dtype="Int64" if i < 5 else "object")
                                                             for i, n in enumerate(names)})
            if listed:
                out["runs"] = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
            if kept_text:
                out["kept_text"] = [collapsed(w, r) for w, r in zip(texts, found)]
            yield out

    checksum = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(-1)) if periodic_ends else F.lit(-1)
    rows = docs.select(carried(key, kind).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       checksum.alias("checksum")).mapInPandas(run, columns)
    return rows.select(F.col("held").cast(kind).alias(key), *rows.columns[1:])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one space, each run cut to its first period."""
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join([w for i, w in enumerate(words) if i not in gone]).decode()
