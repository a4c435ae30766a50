"""Secrets in text: three fixed patterns, and a battery of randomness tests over long tokens. DataFrame functions only.

The battery asks of each long token whether it looks drawn at random from the alphabet of its inferred encoding:

* chi-squared uniformity of the letters (mean k-1 and variance 2(k-1)(n-1)/n under randomness),
* the runs above and below the alphabet's middle (binomial under randomness),
* the lag-1 serial correlation of the letters' places in the alphabet.

The smallest of the three p-values m, as 1 - (1 - m)**3, is the token's p-value: uniform for random tokens, while words
pile up near 0. That splits a histogram of p-values: per encoding and length class, the count above 1/2 tells
how many tokens are random (Storey's estimator), and what else lies above a threshold is a false discovery. Each class
takes the lowest threshold that keeps the share of false discoveries within ``fdr``; short lengths, where tests have
little power, thereby need a larger p-value. No class is too small for a threshold: its histogram borrows ``PRIOR`` tokens
in the shares of the other classes of its length, and those borrow ``WIDER`` from the other lengths, which borrow as many
random ones. So a lone token has the threshold of its length, while many words in a class still raise its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base kinds in their order, and the least length of what counts.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]

#: Runs that the battery tests, as a whole if an alphabet has all their letters, and in pieces: between '+' and '/', between
#: '_' and '-', and between all four (those of the first two kinds that have a mark left, as the last has the others).
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
PIECES = [(r"[A-Za-z0-9_-]{20,}", "[_-]"), (r"[A-Za-z0-9+/]{20,}", "[+/]"), (r"[A-Za-z0-9]{20,}", ".")]
#: The alphabets it infers, the narrowest that has all of a token's letters.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    "HEX": (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    "base32": (r"^[A-Z2-7]+$", UPPER + "234567"),
    "base36": (r"^[a-z0-9]+$", DIGITS + LOWER),
    "base62": (r"^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    "base64": (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
}
#: Length classes by their least length.
LENGTHS = [20, 28, 40, 64, 128]
BINS = 100
#: Elements of a block of ``running``.
BLOCK = 128
#: Share of false discoveries that a class may have; tokens that its histogram borrows, and that the lent ones borrow.
FDR, PRIOR, WIDER = 0.05, 40.0, 200.0
SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: higher-order functions don't share equal parts of an expression."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine) -> Column:
    """The array of running sums (or maxima: ``combine`` of two) of an array of integers from 0 on.

    An array that grows step by step is copied at each step, so it only grows within blocks of ``BLOCK``, and once more over the
    blocks: a text with very many matches takes little more than linear time."""
    def grown(part: Column, before: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return let(combine(acc["at"], x), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

        start = F.struct(before.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def in_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda part: F.aggregate(part, F.lit(0), lambda acc, x: combine(acc, x)))
        before = F.concat(F.array(F.lit(0)), grown(totals, F.lit(0)))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), grown))

    def of(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(values) > 0, let(blocks, in_blocks)).otherwise(F.array().cast("array<int>"))

    return let(values, of)


def places(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points: text between matches, then the match, in turn."""
    def of(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = running(F.zip_with(found, between, lambda m, b: F.char_length(b) + F.char_length(m)), lambda a, b: a + b)
        return F.zip_with(found, ends, lambda m, e: F.struct(
            (e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("value")))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def tokens_of(text: Column) -> Column:
    """Every run of ``TOKEN`` that fits an alphabet, and the long pieces of every run, each in its place."""
    def having(found: Column, mark: str) -> Column:
        return F.filter(found, lambda m: m["value"].rlike(mark))

    found = F.concat(*[having(places(text, pattern), mark) for pattern, mark in PIECES])
    return F.when(text.rlike(TOKEN), found).otherwise(F.array().cast(SPAN))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, within 2e-4 (logistic form)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def p_random(token: Column, letters: Column, size: Column) -> Column:
    """The battery's p-value of one token under randomness over ``letters``, an alphabet of ``size``."""
    n = F.char_length(token).cast("double")
    chars = F.split(token, "")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow(
        F.char_length(token) - F.char_length(F.replace(token, c, F.lit(""))), F.lit(2)))
    uniform = (size / n * squares - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    at = F.transform(chars, lambda c: F.instr(letters, c).cast("double"))
    here, following = F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1)
    half = (size + 1) / 2
    changes = F.aggregate(F.zip_with(here, following, lambda a, b: ((a > half) != (b > half)).cast("double")),
                          F.lit(0.0), lambda acc, x: acc + x)
    runs = F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    # letters are centred on the alphabet's middle, their mean under randomness; its variance there is (k^2-1)/12
    lagged = F.aggregate(F.zip_with(here, following, lambda a, b: (a - half) * (b - half)), F.lit(0.0),
                         lambda acc, x: acc + x)
    serial = F.abs(lagged / ((size * size - 1) / 12)) / F.sqrt(n - 1)
    smallest = F.least(F.lit(1.0), upper_tail(uniform), 2 * upper_tail(runs), 2 * upper_tail(serial))
    return 1 - F.pow(1 - smallest, F.lit(3))


def tested(text: Column) -> Column:
    """array<struct<start, end, cls, token, p>>: every long token and piece with its encoding and length class, hash and p-value."""
    def one(m: Column) -> Column:
        token = m["value"]
        name, letters = F.lit(None).cast("string"), F.lit(None).cast("string")
        for k, (pattern, alphabet) in reversed(ALPHABETS.items()):
            name = F.when(token.rlike(pattern), F.lit(k)).otherwise(name)
            letters = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(letters)
        length = F.lit(LENGTHS[0])
        for least in LENGTHS[1:]:
            length = F.when(F.char_length(token) >= least, F.lit(least)).otherwise(length)
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), token.alias("value"),
                        F.concat_ws("/", name, length.cast("string")).alias("cls"), letters.alias("letters"))

    return F.transform(F.transform(tokens_of(text), one), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["cls"].alias("cls"), F.xxhash64(m["value"]).alias("token"),
        p_random(m["value"], m["letters"], F.char_length(m["letters"]).cast("double")).alias("p")))


def length_of(cls: str) -> str:
    return cls.split("/")[1]


def borrowed(h: list[float], wider: list[float], size: float) -> list[float]:
    """A histogram with ``size`` more tokens in the shares of a wider one."""
    return [n + size * w / sum(wider) for n, w in zip(h, wider)]


def lowest(by: dict[str, list[int]], fdr: float) -> dict[str, float]:
    """The threshold of each class, from the classes' histograms."""
    def others(wider: list[str], without: list[str]) -> list[float]:
        return [float(sum(by[c][b] for c in wider if c not in without)) for b in range(BINS)]

    found = {}
    for cls, own in sorted(by.items()):
        same = [c for c in by if length_of(c) == length_of(cls)]
        every = borrowed(others(list(by), same), [1.0] * BINS, WIDER)
        h = borrowed(own, borrowed(others(same, [cls]), every, WIDER), PRIOR)
        random = 2 * sum(h[BINS // 2:])
        for b in range(1, BINS // 2 + 1):  # the lowest threshold whose surplus over random tokens is small; 1/2 has none
            above = sum(h[b:])
            if b == BINS // 2 or above - random * (1 - b / BINS) <= fdr * above:
                found[cls] = b / BINS
                break
    return found


def thresholds(docs: DataFrame, text: str, fdr: float = FDR) -> dict[str, float]:
    """The least p-value that counts as random, by class; classes without tokens are missing.

    A token counts once, however often it occurs: copies are no further tests. Different tokens are told apart by their
    hash, combined before the shuffle; only counts by class and histogram bin are collected (at most 35 classes of
    ``BINS`` bins), over all documents.
    """
    tokens = docs.select(F.explode(tested(F.coalesce(F.col(text), F.lit("")))).alias("t"))
    different = tokens.select("t.cls", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
                              "t.token").distinct()
    counts = different.groupBy("cls", "bin").count()
    by: dict[str, list[int]] = {}
    for r in counts.collect():
        by.setdefault(r.cls, [0] * BINS)[r.bin] = r["count"]
    return lowest(by, fdr)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the three base kinds, by start and then kind (0, 1, 2 as listed)."""
    assign = F.filter(places(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["value"], ASSIGN, 2)) >= LEAST["assign"])
    # greedy runs: a long enough match is the same whether short ones are matched and dropped or never matched
    access = places(text, r"AKIA[A-Z0-9]{16,}")
    hexes = places(text, r"[0-9a-f]{24,}")
    return F.array_sort(F.concat(*[of_kind(found, k) for k, found in enumerate((assign, access, hexes))]))


def of_kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def outermost(found: Column) -> Column:
    """The spans that are in no other one of ``found``, by start."""
    def of(longest_first: Column) -> Column:
        upto = F.concat(F.array(F.lit(0)), running(F.transform(longest_first, lambda s: -s["back"]), F.greatest))
        fresh = F.zip_with(longest_first, F.slice(upto, F.lit(1), F.size(longest_first)), lambda s, before: F.struct(
            s["start"].alias("start"), (-s["back"]).alias("end"), (-s["back"] > before).alias("fresh")))
        return F.transform(F.filter(fresh, lambda s: s["fresh"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    return let(F.array_sort(F.transform(found, lambda t: F.struct(t["start"].alias("start"), (-t["end"]).alias("back")))), of)


def apart(spans: Column, base: Column) -> Column:
    """The ``spans`` that overlap none of ``base``: of the base spans that start before a span's end, none ends after its start."""
    def of(events: Column) -> Column:  # a span stands at its end, before base spans that start there
        upto = running(F.transform(events, lambda e: F.when(e["base"], e["end"]).otherwise(F.lit(0))), F.greatest)
        seen = F.zip_with(events, upto, lambda e, u: F.struct(e["start"].alias("start"), e["end"].alias("end"),
                                                              (~e["base"] & (u <= e["start"])).alias("alone")))
        return F.transform(F.filter(seen, lambda e: e["alone"]), lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))

    def event(span: Column, at: str, is_base: bool) -> Column:
        return F.struct(span[at].alias("at"), F.lit(is_base).alias("base"), span["start"].alias("start"), span["end"].alias("end"))

    return let(F.array_sort(F.concat(F.transform(spans, lambda s: event(s, "end", False)),
                                     F.transform(base, lambda b: event(b, "start", True)))), of)


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text: str = "text", out: str = "spans", fdr: float = FDR) -> DataFrame:
    """``docs`` with a column ``out``: array<struct<start:int, kind:int, end:int>> of all secrets, by start and kind.

    ``kind`` indexes ``KINDS``; places count code points, the end is exclusive. The battery's tokens that overlap a base
    span are left out, the base span has them; so are pieces of a token that is found as a whole. Null and empty text has no spans; repeated rows give equal spans; other
    columns are kept as they are, but for one of the name ``out``, which is replaced. The battery's thresholds come from
    all rows of ``docs``; an empty table finds nothing.
    """
    at_least = thresholds(docs, text, fdr)
    whole = F.coalesce(F.col(text), F.lit(""))
    base = base_spans(whole)
    if not at_least:
        return docs.withColumn(out, base)
    least = F.create_map(*[F.lit(x) for kv in sorted(at_least.items()) for x in kv])

    def random(row_base: Column) -> Column:
        passing = F.filter(tested(whole), lambda t: F.coalesce(t["p"] >= least[t["cls"]], F.lit(False)))
        found = F.transform(passing, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
        return let(found, lambda spans: F.when(F.size(spans) > 0, of_kind(outermost(apart(spans, row_base)), 3)).otherwise(
            F.array().cast("array<struct<start:int,kind:int,end:int>>")))

    return docs.withColumn(out, base).withColumn(out, F.array_sort(F.concat(F.col(out), random(F.col(out)))))


def redact(found: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """``found`` with every span of ``text`` replaced by ``mark`` (touching and overlapping spans by one); null stays null."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] > acc["at"]
        kept = F.when(fresh, F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])).otherwise(F.lit(""))
        first = fresh | (acc["out"] == "")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.concat(acc["out"], kept, F.when(first, F.lit(mark)).otherwise(F.lit(""))).alias("out"))

    cut = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                      lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.char_length(F.col(text)))))
    return found.withColumn(text, F.when(F.size(F.col(spans)) > 0, cut).otherwise(F.col(text)))


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: counts of the base kinds, digest of the base spans, and all spans as text."""
    found = find_secrets(docs.select(key, text), text, "spans")
    base = F.filter(F.col("spans"), lambda s: s["kind"] < 3)
    count = [count_of(F.col("spans"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(key, *count[:3], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count[3])
