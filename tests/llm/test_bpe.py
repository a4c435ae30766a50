"""BPE: exact against the tokenizers library, and a round trip."""

import hashlib
import json
import random
import struct

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import bpe, catalog

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n  x", "a" * 3000, "naïve café ½ Ⅷ ²", "don't I'LL we've", "<|endoftext|>x<|endoftext|>", "日本語テキスト", "🙂👩‍👩‍👧", "\x00\x1c\x1d\x85\xa0  ​",
       "été́", "\t\t a\r\n\r\nb ", "####$$$$ 1234567890" * 40, "ǅ ʰ ˈ", "﻿�", "  <|endoftext", "À́ ̀"]


def reference(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


LIBRARY = Tokenizer.from_file(PATH)


def check(texts, mine):
    for t in texts:
        ids, back = reference(t)
        got = mine.encode(t)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids, repr(t[:80])
        assert mine.decode(got) == back


def test_ids_equal_the_library_on_odd_and_random_texts():
    mine = bpe.PrefixBpe(json.loads(bpe.load(PATH)))
    rng = random.Random(5)
    pool = "abcdefghijklmnopqrstuvwxyz  ETAOIN'’.,-_0123é漢\n\t½²"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(200))) for _ in range(300)]
    check(ODD + texts, mine)


def test_nulls_repeats_clashing_columns_and_empty_frames(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "hi there", "b"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(docs, PATH)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == [("1", 0), ("1", 0), ("2", 0), ("None", 2)]
    back = bpe.decode_documents(got, PATH).where(F.col("doc_id").isNull()).first()
    assert back.text == "hi there"
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark):
    got = {r.doc_id: r for r in catalog.QUERIES["op10_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, back = reference(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
