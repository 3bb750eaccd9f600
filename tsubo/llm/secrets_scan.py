"""Secrets in text: fixed patterns, and values in credential context that are hard to guess.

How hard a value is to guess is the cheapest way to build it from ranked words,
dates, repeated characters, keyboard walks and brute force (dynamic programming
over its positions, costs in bits).  Words are ranked by the number of documents
that hold them, over the whole corpus; what stands in credential context teaches
no words, so that a copied password does not become one.

NULL and empty texts have no spans and no values; repeated rows are rows of their
own; a value of any length is priced whole, in time that grows as n log n at most;
an empty table gives an empty result, with the fixed words alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.llm.spans import count_kind, digest, joined, of_kinds

BASE_KINDS = ("assign", "access", "hex")
GUESS = "guess"
KINDS = (*BASE_KINDS, GUESS)
VALUE = "value"  # a value in credential context, secret or not
SPAN_TYPE = "ARRAY<STRUCT<kind: STRING, start: INT, `end`: INT, value_start: INT, value_end: INT, bits: DOUBLE>>"

# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs shorter than 32 would be dropped anyway.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

# Where a value may be a credential.
CONTEXT = re.compile(
    r"""(?:passphrase|passcode|password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?)["']?\x20*(?:[:=]|=>|->|\bis\b)\x20*["']?([^\s"'`<>]+)""",
    re.I | re.A,
)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential")
# A value of at least this many bits of guessing is a secret.
SECRET_BITS = 45.0

# Common parts of passwords, by rank.
COMMON = (
    "password pass admin root user test guest login welcome master secret token key letmein monkey dragon shadow "
    "sunshine princess football baseball superman batman iloveyou love hello summer winter spring autumn changeme "
    "default example sample your here value none null true false qwerty abc access database server public private "
    "service account dev prod staging the and for with not this that from"
).split()
# Learned words: so many are ranked (this bounds what tasks receive), each of this many letters and held by this many documents.
LEARNED_WORDS = 20_000
WORD_LETTERS = (3, 24)
WORD_DOCUMENTS = 3
LIST_BITS = 1.0  # for taking a word from the learned list
LEET = str.maketrans("4310$5@7", "aeiossat")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LINES = (*ROWS, "abcdefghijklmnopqrstuvwxyz", *("".join(pair) for upper, lower in zip(ROWS, ROWS[1:]) for pair in zip(upper, lower)))
STEPS = {pair for line in LINES for way in (line, line[::-1]) for pair in zip(way, way[1:])}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d", re.A)
DATE_LENGTHS = (4, 8, 9, 10)
DATE_BITS = {True: 5.5, False: 15.2}  # a year alone; a day of a century
# Brute force: bits per character of a class, and for changing to another class.
CLASS_BITS = {"lower": 2.0, "upper": 3.0, "digit": math.log2(10), "other": 5.0}
CHANGE_BITS = 2.0
WALK_BITS = 6.0
LEAST_RUN = 3  # characters of a repeat or walk


class Words(NamedTuple):
    """Bits of each known word, and the length of the longest."""

    bits: dict[str, float]
    longest: int


def ranked(learned: list[str] | tuple[str, ...] = ()) -> Words:
    """The fixed words, and ``learned`` ones by rank; a word of both lists costs the lesser of the two."""
    bits = {word: LIST_BITS + math.log2(rank + 1) for rank, word in enumerate(learned, 1)}
    for rank, word in enumerate(COMMON, 1):
        bits[word] = min(bits.get(word, math.inf), math.log2(rank + 1))
    return Words(bits, max(map(len, bits)))


FIXED = ranked()


def learn_words(docs: DataFrame, text: str = "text", most: int = LEARNED_WORDS) -> Words:
    """Words ranked by the number of rows of ``docs`` that hold them (ties by the word), counted over all whole texts.

    One shuffle of counts that are combined in each task first; at most ``most`` words reach the driver.
    """
    low = F.lower(F.col(text))
    plain = F.when(low.rlike("|".join(CONTEXT_WORDS)), F.regexp_replace(low, f"(?i){CONTEXT.pattern}", " ")).otherwise(low)
    least, longest = WORD_LETTERS
    held = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    counts = held.filter(F.length("word").between(least, longest)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.filter(F.col("n") >= WORD_DOCUMENTS).orderBy(F.desc("n"), "word").limit(most).select("word").toArrow()
    return ranked(rows["word"].to_pylist())


def _class(c: str) -> str:
    return "digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "other"


def _lower(value: str) -> str:
    """Lower-cased character by character, so that positions stay."""
    low = value.lower()
    return low if len(low) == len(value) else "".join(x if len(x := c.lower()) == 1 else c for c in value)


class _Starts:
    """Where a repeat or walk that goes on may have begun: positions of the present run with their costs.

    Only positions that are cheaper than all later ones are kept, so the cheapest from any position on is one search.
    """

    def __init__(self) -> None:
        self.begin, self.at, self.cost = 0, [], []

    def restart(self, begin: int) -> None:
        self.begin, self.at, self.cost = begin, [], []

    def cheapest(self, end: int, best: list[float]) -> float:
        """Least cost up to the start, and bits of the length, over all starts at least ``LEAST_RUN`` before ``end``."""
        start = end - LEAST_RUN
        if start < self.begin:
            return math.inf
        while self.cost and self.cost[-1] >= best[start]:
            self.at.pop()
            self.cost.pop()
        self.at.append(start)
        self.cost.append(best[start])
        widths = range(LEAST_RUN.bit_length(), (end - self.begin).bit_length() + 1)
        # up to 2 ** w - 1 characters are written in w bits
        return min(w + self.cost[min(bisect_left(self.at, end - (1 << w) + 1), len(self.at) - 1)] for w in widths)


def guess_bits(value: str, words: Words = FIXED) -> float:
    """Bits of the cheapest segmentation of ``value``, over all segmentations; 0 for empty text."""
    n = len(value)
    low = _lower(value)
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # cheapest that ends in a brute-forced character
    runs, walks = _Starts(), _Starts()
    last = ""
    for j in range(1, n + 1):
        c = value[j - 1]
        kind = _class(c)
        brute[j] = CLASS_BITS[kind] + min(best[j - 1] + CHANGE_BITS, brute[j - 1] + (0.0 if kind == last else CHANGE_BITS))
        last = kind
        cost = brute[j]
        for i in range(max(0, j - words.longest), j):
            part = low[i:j]
            if part in words.bits:
                cost = min(cost, best[i] + words.bits[part] + (value[i:j] != part) + CHANGE_BITS)
            if (part := plain[i:j]) in words.bits:
                cost = min(cost, best[i] + words.bits[part] + (value[i:j] != part) + CHANGE_BITS)
        if j > 1 and c != value[j - 2]:
            runs.restart(j - 1)
        if j > 1 and (low[j - 2], low[j - 1]) not in STEPS:
            walks.restart(j - 1)
        cost = min(cost, runs.cheapest(j, best) + CLASS_BITS[kind] + CHANGE_BITS, walks.cheapest(j, best) + WALK_BITS)
        if kind == "digit":
            for length in DATE_LENGTHS:
                if j >= length and DATE.fullmatch(value, j - length, j):
                    cost = min(cost, best[j - length] + DATE_BITS[length == 4])
        best[j] = cost
    return best[n]


def _base_spans(text: str, context: bool) -> list[tuple[str, int, int, int, int]]:
    found = []
    if context:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                found.append(("assign", m.start(), m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    return found + [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]


def find_all(text: str | None, cost=guess_bits) -> list[tuple[str, int, int, int, int, float | None]]:
    """``kind, start, end, value_start, value_end, bits``: spans, and every value in credential context with its cost.

    A value of ``SECRET_BITS`` or more that no base span touches is a ``guess`` span as well.  By start, then kind.
    """
    if not text:
        return []
    low = text.lower()
    context = any(word in low for word in CONTEXT_WORDS)
    base = _base_spans(text, context)
    found = [(*s, None) for s in base]
    if context:
        starts, ends = [], []  # base spans, overlapping ones as one
        for x, y in sorted((s[1], s[2]) for s in base):
            if ends and x < ends[-1]:
                ends[-1] = max(ends[-1], y)
            else:
                starts.append(x)
                ends.append(y)
        for m in CONTEXT.finditer(text):
            value = m.group(1).rstrip(".,;:!?)]}")
            if not value:
                continue
            a, b = m.start(1), m.start(1) + len(value)
            bits = cost(value)
            found.append((VALUE, a, b, a, b, bits))
            before = bisect_right(ends, a)  # spans that end up to the value's start
            if bits >= SECRET_BITS and not (before < len(starts) and starts[before] < b):
                found.append((GUESS, a, b, a, b, bits))
    return sorted(found, key=lambda s: (s[1], (*KINDS, VALUE).index(s[0])))


def find_spans(text: str | None, cost=guess_bits) -> list[tuple[str, int, int, int, int]]:
    """``kind, start, end, value_start, value_end`` of the spans by start, then kind as listed in ``KINDS``."""
    return [s[:5] for s in find_all(text, cost) if s[0] != VALUE]


def _costs(words: Words):
    """The cost of a value, remembered within a task for short ones."""
    known = lru_cache(maxsize=4096)(lambda value: guess_bits(value, words))
    return lambda value: known(value) if len(value) <= 256 else guess_bits(value, words)


def secret_spans(text: Column, words: Words = FIXED) -> Column:
    """All spans and values of a text, ordered by start; NULL and empty texts have none."""

    @F.pandas_udf(SPAN_TYPE)
    def find(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "value_start", "value_end", "bits")
        cost = _costs(words)
        return pd.Series([[dict(zip(names, s)) for s in find_all(t, cost)] for t in texts], dtype=object)

    return find(text)


def scan(docs: DataFrame, text: str = "text", words: Words | None = None) -> DataFrame:
    """``row`` (the input row, whatever its columns), ``spans`` and ``values``; one row per input row.

    Without ``words`` they are learned from ``docs`` first.
    """
    words = learn_words(docs, text) if words is None else words
    found = docs.select(F.struct("*").alias("row"), secret_spans(F.col(text), words).alias("found"))
    return found.select("row", of_kinds(F.col("found"), KINDS).alias("spans"), of_kinds(F.col("found"), (VALUE,)).alias("values"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: Words | None = None) -> DataFrame:
    """Counts and digests of the spans per document, and what its values in credential context cost.

    ``n_values`` counts these values, ``n_weak`` those below ``SECRET_BITS``, whether a base span covers them or not
    (an assignment of a placeholder, say); ``guess_costs`` lists ``start:end:bits``, bits to two decimals.
    """
    spans, values = F.col("spans"), F.col("values")
    base = of_kinds(spans, BASE_KINDS)
    costs = F.transform(values, lambda v: F.concat_ws(":", v["start"], v["end"], F.format_string("%.2f", v["bits"])))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return scan(narrow, "text", words).select(
        "row.doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in KINDS),
        digest(base).alias("base_sha256"),
        joined(spans).alias("spans"),
        F.size(values).cast("bigint").alias("n_values"),
        F.size(F.filter(values, lambda v: v["bits"] < SECRET_BITS)).cast("bigint").alias("n_weak"),
        F.array_join(costs, ",").alias("guess_costs"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", words: Words | None = None) -> DataFrame:
    """``docs`` with the value of every secret replaced; rows and columns stay, NULL stays NULL.

    Without ``words`` they are learned from ``docs`` first.
    """
    words = learn_words(docs, text) if words is None else words

    @F.pandas_udf("STRING")
    def clean(texts: pd.Series) -> pd.Series:
        out, cost = [], _costs(words)
        for t in texts:
            parts, at = [], 0
            for a, b in sorted((s[3], s[4]) for s in find_spans(t, cost)):
                if b <= at:
                    continue
                if a >= at:
                    parts += [t[at:a], mark]
                at = b
            out.append("".join(parts) + t[at:] if parts else t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, clean(F.col(text)))
