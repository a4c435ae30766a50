"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a word exactly one token can end the word's canonical merge result there. The tokens that end at a
position are the suffix matches of an automaton over the vocabulary; one of them is the prefix's last token if it stands
at the word's start or if it is compatible with the last token of the prefix before it, that is, if merging the two
tokens' bytes by rank gives back exactly these two tokens. Following the last tokens backwards gives the exact ids.

The vocabulary file is a parameter; it is read on the driver (a few MB by its format: one entry a token) and broadcast.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import small_batches

#: Fixed value: the pattern by which byte-level BPE vocabularies of this kind split text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words (and token pairs) that one worker remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
#: Longer words are not remembered.
REMEMBERED_LENGTH = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such a vocabulary: printable Latin-1 as itself, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class KnownWords(dict):
    """The ids of the words met lately: when it is full, its words become the old ones, which are asked before a word
    is encoded again, and the older ones are forgotten."""

    def __init__(self, encode_word: Callable[[str], bytes]):
        super().__init__()
        self.encode_word, self.old = encode_word, {}

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word) or self.encode_word(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out


class PrefixBpe:
    """An encoder and decoder for one vocabulary; ``spec`` is the parsed JSON of the tokenizers library."""

    def __init__(self, spec: dict):
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.added_pattern = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(WORDS)
        self.to_letters = {b: letters[b] for b in range(256)}  # for str.translate on Latin-1 text
        of_byte = {c: bytes([b]) for b, c in enumerate(letters)}
        texts = {i: b"".join(of_byte[c] for c in t) for t, i in ids.items()}
        texts |= {i: t.encode() for t, i in self.added.items()}
        self.bytes_of = [texts.get(i, b"") for i in range(max(texts) + 1)]
        #: rank of the merge of two ids; halves and rank of each merged id (its earliest merge); -1 for single bytes
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {i: -1 for t, i in ids.items() if len(t) == 1}
        for r, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.rank.setdefault((a, b), r)
            if whole not in self.made:
                self.made[whole], self.halves[whole] = r, (a, b)
        self.suffixes = ahocorasick.Automaton()
        for t, i in ids.items():
            if i in self.made:
                self.suffixes.add_word(t, (i, len(t)))
        self.suffixes.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known = KnownWords(self.encode_word)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens by rank ends in exactly these two tokens.

        That fails if some merge across the border comes before the merges that finish both sides. The tokens are
        taken apart from the border outwards, the one that was merged last first; a border pair that merges before
        the merge just taken apart would have won.
        """
        before = len(self.rank) + 1
        a, b = left, right
        while True:
            across = self.rank.get((a, b))
            if across is not None and across < before:
                return False
            made_a, made_b = self.made[a], self.made[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                before, a = made_a, self.halves[a][1]
            else:  # of equal ranks the left merge comes first, so a border merge of the same rank still wins
                before, b = made_b + 1, self.halves[b][0]

    def last_tokens(self, word: str) -> list[tuple[int, int]]:
        """The last token and its length for every prefix of a word in byte letters (index 0: the empty prefix)."""
        last: list = [None] * (len(word) + 1)
        pairs = self.pairs
        for end, match in self.suffixes.iter(word):
            end += 1
            if last[end] is None:
                token, length = match
                if length < end:
                    pair = (last[end - length][0], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= REMEMBERED:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(*pair)
                    if not fits:
                        continue
                last[end] = match
        return last

    def encode_word(self, word: str) -> bytes:
        """The ids of one word as little-endian unsigned 32-bit integers."""
        letters = word.encode().decode("latin-1").translate(self.to_letters)
        last, at, ids = self.last_tokens(letters), len(letters), []
        while at:
            token, length = last[at]
            ids.append(token)
            at -= length
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each; the strings of added tokens give their ids."""
        if self.added_pattern is not None and any(t in text for t in self.added):
            parts = self.added_pattern.split(text)  # pieces and added tokens in turn
        else:
            parts = [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(struct.pack("<I", self.added[part]))
            else:
                out += map(self.known.__getitem__, self.words.findall(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids as ``encode`` gives them; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def load(path: str) -> str:
    """The vocabulary file's JSON text; the file's format bounds it (one line of vocabulary a token)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


#: One encoder a worker process, by the hash of its vocabulary; reused from task to task.
ENCODERS: dict[str, PrefixBpe] = {}


def encoder(spec: str, key: str) -> PrefixBpe:
    if key not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[key] = PrefixBpe(json.loads(spec))
    return ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                     with_ids: bool = True, check: bool = True) -> DataFrame:
    """One row a document: ``key``, n_tokens, ids (array<int>, if ``with_ids``) and, if ``check``, the digests of the ids
    and of the text decoded from them.

    ``vocabulary``: path of a byte-level BPE vocabulary in the tokenizers library's JSON form. Null text counts as empty
    (no ids); a null key stays null; repeated rows give repeated results; other columns are not read. Documents are
    independent, so the frame's own partitions are kept and nothing is shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    spec = load(vocabulary)
    digest = hashlib.sha256(spec.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(spec)
    kind = docs.schema[key].dataType.simpleString()
    columns = [f"`{key}` {kind}", "n_tokens bigint"] + ["ids array<int>"] * with_ids
    columns += ["ids_sha256 string", "decoded_sha256 string"] * check

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(shared.value, digest)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch["text"]]
            out = {key: batch["key"], "n_tokens": [len(i) // 4 for i in ids]}
            if with_ids:
                out["ids"] = [np.frombuffer(i, "<u4").astype(np.int32) for i in ids]
            if check:
                out["ids_sha256"] = [hashlib.sha256(i).hexdigest() for i in ids]
                out["decoded_sha256"] = [hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids]
            yield pd.DataFrame(out)

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(run, ", ".join(columns))


def decode_documents(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with a column ``out``: the text of the token ids in column ``ids`` (null ids: empty text)."""
    spark = rows.sparkSession
    small_batches(spark)
    spec = load(vocabulary)
    digest = hashlib.sha256(spec.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(spec)

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        of = encoder(shared.value, digest).bytes_of
        return pd.Series([b"".join([of[i] for i in (() if x is None else x)]).decode("utf-8", "replace") for x in column])

    return rows.withColumn(out, text_of(F.col(ids)))
