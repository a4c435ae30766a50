"""Quality rules as a short-circuit cascade.

Each rule rejects texts for one reason, from whole texts. A bounded sample tells what a rule costs (seconds a byte) and which
share of the texts that are still there it rejects; the rule that rejects most per cost goes first, then again among the
rest. A text that a rule rejects is not looked at by the rules after it. The order changes the time alone: a text is kept
if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import sample_texts, small_batches
from zoneflow.llm.shingles import Words, chunks, mixed

#: Bounds of the sample that orders the rules: texts, bytes of a text.
SAMPLE, TEXT_BYTES = 1000, 100_000
#: Base: words at least, percent of words in repeated windows at most, words of a window. Fixed values.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BLANK = " \t\n\v\f\r"


class Batch:
    """Texts of one chunk with their words; counts are by text."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.words = texts, Words(texts)
        self.n_words = np.diff(self.words.first)

    def letters(self, marks: np.ndarray, which: np.ndarray) -> np.ndarray:
        """How many bytes of the given texts are marked (a table of 256)."""
        of, at = self.words.buffer, self.words.offsets
        return np.array([int(np.count_nonzero(marks[of[at[i]:at[i + 1] - 1]])) for i in which], np.int64)

    def base(self) -> dict[str, np.ndarray]:
        all_ = np.arange(len(self.texts))
        whole = np.ones(256, bool)
        whole[0x80:0xC0] = False  # continuation bytes are no code points of their own
        whole[list(BLANK.encode())] = False
        lines, repeated = [], np.zeros(len(self.texts), np.int64)
        for t in self.texts:
            worded = [x for x in t.split(b"\n") if x.strip()]  # bytes strip and split by the same six bytes as words
            lines.append((len(worded), len(worded) - len(set(worded))))
        hashes, bounds = self.words.windows(WINDOW)
        if len(hashes):
            own = np.repeat(all_.astype(np.uint64), np.diff(bounds))
            keyed = hashes ^ mixed(own + np.uint64(1))
            order = np.argsort(keyed, kind="stable")
            same = keyed[order[1:]] == keyed[order[:-1]]
            twice = np.zeros(len(keyed), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            at = np.flatnonzero(twice)
            place = (self.words.first[:-1] - bounds[:-1])[own[at].astype(np.int64)] + at  # the window's first word
            steps = np.zeros(len(self.words.hashes) + 1, np.int64)
            np.add.at(steps, place, 1)
            np.add.at(steps, place + WINDOW, -1)
            covered = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])
            repeated = covered[self.words.first[1:]] - covered[self.words.first[:-1]]
        self.lines = np.array(lines, np.int64).reshape(-1, 2)
        self.n_symbols, self.word_chars = self.letters(SYMBOLS, all_), self.letters(whole, all_)
        return {"n_words": self.n_words, "word_chars": self.word_chars, "n_symbols": self.n_symbols,
                "n_dup_lines": self.lines[:, 1], "n_repeat_words": repeated}


def marks(*parts: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    for p in parts:
        out[list(p)] = True
    return out


UPPER, LOWER, DIGITS = marks(bytes(range(65, 91))), marks(bytes(range(97, 123))), marks(b"0123456789")
LETTERS = UPPER | LOWER | marks(bytes(range(0x80, 0x100)))


def many_symbols(b: Batch, i: np.ndarray) -> np.ndarray:
    return 10 * b.n_symbols[i] > b.n_words[i]


def many_shouts(b: Batch, i: np.ndarray) -> np.ndarray:
    return np.array([10 * b.texts[k].count(b"!") for k in i], np.int64) > b.n_words[i]


def upper_case(b: Batch, i: np.ndarray) -> np.ndarray:
    upper = b.letters(UPPER, i)
    return 3 * upper > upper + b.letters(LOWER, i)


def word_after_itself(b: Batch, i: np.ndarray) -> np.ndarray:
    h, first = b.words.hashes, b.words.first
    return np.array([10 * int(np.count_nonzero(h[first[k] + 1:first[k + 1]] == h[first[k]:max(first[k], first[k + 1] - 1)])) for k in i],
                    np.int64) > b.n_words[i]


def repeated_lines(b: Batch, i: np.ndarray) -> np.ndarray:
    return 10 * b.lines[i, 1] > 4 * b.lines[i, 0]


def odd_words(b: Batch, i: np.ndarray) -> np.ndarray:
    """Words of less than 2 or more than 16 code points on average."""
    return (b.word_chars[i] < 2 * b.n_words[i]) | (b.word_chars[i] > 16 * b.n_words[i])


def few_letters(b: Batch, i: np.ndarray) -> np.ndarray:
    letters, digits = b.letters(LETTERS, i), b.letters(DIGITS, i)
    return letters < digits + b.n_symbols[i]


RULES: dict[str, Callable[[Batch, np.ndarray], np.ndarray]] = {
    f.__name__: f for f in (many_symbols, many_shouts, upper_case, word_after_itself, repeated_lines, odd_words, few_letters)}


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])


def ordered(texts: list[bytes], clock: Callable[[], float] = time.perf_counter) -> list[str]:
    """The rules by rejection per cost on a sample, each next one among the texts that the ones before it left."""
    batches = []
    for a, b in chunks(texts):
        batch = Batch(texts[a:b])
        batches.append((batch, np.flatnonzero(~base_failed(batch.base()))))
    out: list[str] = []
    while len(out) < len(RULES):
        best, best_rate, best_left = None, -1.0, batches
        for name, rule in RULES.items():
            if name in out:
                continue
            began, rejected, size, left = clock(), 0, 1, []
            for batch, i in batches:
                bad = rule(batch, i)
                rejected += int(bad.sum())
                size += sum(len(batch.texts[k]) for k in i)
                left.append((batch, i[~bad]))
            rate = rejected / (max(clock() - began, 1e-9) / size)
            if rate > best_rate:
                best, best_rate, best_left = name, rate, left
        out.append(best)
        batches = best_left
    return out


def judge(texts: list[bytes], order: list[str]) -> pd.DataFrame:
    """Base counts and the verdict of whole texts, the rules in the given order."""
    out = []
    for a, b in chunks(texts):
        batch = Batch(texts[a:b])
        base = batch.base()
        failed = base_failed(base)
        left = np.flatnonzero(~failed)
        for name in order:
            if not len(left):
                break
            left = left[~RULES[name](batch, left)]
        kept = np.zeros(b - a, bool)
        kept[left] = True
        out.append(pd.DataFrame(base | {"base_failed": failed, "kept": kept}))
    return pd.concat(out) if out else pd.DataFrame()


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``key``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    Null and empty texts have no words and fail the base. Repeated rows give equal results, a null key stays null, other
    columns are not read; an empty table gives no rows. The sample that orders the rules is bounded by ``SAMPLE`` texts
    of ``TEXT_BYTES`` bytes, chosen by the hash of their key; without one the rules keep the order they are listed in.
    """
    small_batches(docs.sparkSession)
    sample = sample_texts(docs, docs.select(key), SAMPLE, TEXT_BYTES, key, text)
    order = ordered([t.encode() for _, t in sample]) if sample else list(RULES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = judge([t.encode() for t in batch["text"]], order)
                yield pd.concat([batch[["key"]].reset_index(drop=True), rows.reset_index(drop=True)], axis=1)

    counts = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"key {docs.schema[key].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean").withColumnRenamed("key", key)


#: DuckDB's form of ``quality`` over documents (the order of the rules does not matter to the verdict).
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8) x),
twice AS (SELECT rid, g FROM windows GROUP BY rid, g HAVING count(*) > 1),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (rid, g)) x GROUP BY rid),
counted AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, length(t) - length(replace(t, '!', '')) AS shouts,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS again,
    strlen(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS other_bytes, length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits
  FROM d LEFT JOIN repeated USING (rid)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * shouts > n_words OR 3 * upper_ > upper_ + lower_ OR 10 * again > n_words
       OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words OR word_chars > 16 * n_words
       OR upper_ + lower_ + other_bytes < digits + n_symbols) AS kept
FROM judged
"""
