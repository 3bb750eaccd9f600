"""Personal data: fixed patterns, and terms that give a protected entity away.

Every personal datum is a protected entity.  How much a term t tells about an
entity e is their pointwise mutual information over the documents,
PMI = log2(n_et * N / (n_e * n_t)); the entity itself holds IC = log2(N / n_e).
A term with PMI >= DISCLOSURE * IC that occurs with e in enough different texts
reveals e, and is generalised or removed in the texts that hold e.

An entity of fewer than SUPPORT texts asks for all of them, and PMI then bounds
the rarity of the term: in the one document of e (n_e = n_et = 1) the terms that
at most N ** (1 - DISCLOSURE) documents hold reveal e.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.llm.spans import count_kind, digest, joined, of_kinds
from tsubo.llm.words import WORD, words
from tsubo.operators.lookup import BROADCAST_BYTES, attach
from tsubo.sources.staging import measure, stage

BASE_KINDS = ("email", "ip", "card", "phone")
TERM = "term"
KINDS = (*BASE_KINDS, TERM)
SPAN_TYPE = "ARRAY<STRUCT<kind: STRING, start: INT, `end`: INT, value: STRING>>"

# Fixed patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# A term reveals an entity from this share of the entity's information on.
DISCLOSURE = 0.9
# Both must stand together in this many different texts, or in all texts of an entity that has fewer.
SUPPORT = 3


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def find_spans(text: str | None) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, value`` by kind as listed, then start."""
    if not text:
        return []
    found = []
    if "@" in text:
        found += [("email", m.start(), m.end(), m.group().lower()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        if "." in text:
            found += [("ip", m.start(), m.end(), m.group()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end(), digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = _digits(m.group())
                if 9 <= len(digits) <= 15:
                    found.append(("phone", m.start(), m.end(), "+" + digits))
    return found


def base_spans(text: Column) -> Column:
    @F.pandas_udf(SPAN_TYPE)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "value"), s)) for s in find_spans(t)] for t in texts])

    return find(text)


def term_spans(text: Column, terms: Column) -> Column:
    """Spans of words that are among ``terms`` (lower-cased) and touch no personal datum."""

    @F.pandas_udf(SPAN_TYPE)
    def find(texts: pd.Series, lists: pd.Series) -> pd.Series:
        word = re.compile(WORD)
        out = []
        for t, wanted in zip(texts, lists):
            wanted, base = set(wanted), find_spans(t)
            spans = [(m.start(), m.end(), m.group().lower()) for m in word.finditer(t) if m.group().lower() in wanted]
            out.append([{"kind": TERM, "start": a, "end": b, "value": v} for a, b, v in spans if not any(s[1] < b and a < s[2] for s in base)])
        return pd.Series(out)

    return find(text, terms)


def _terms(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def revealing_terms(texts: DataFrame, holds: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``k, terms``: per text that holds a personal datum, its terms that reveal one.

    ``texts`` has ``k, text`` (one row per document, equal texts have equal k);
    ``holds`` has ``e, k, rows`` (entity, text, documents with that text).
    Counts are of documents, support is of different texts.  Entities of the
    same texts have the same counts with every term and are taken as one, so a
    text that lists many data opens its terms once.  Terms of the whole corpus
    are counted only where they stand with an entity often enough.
    """
    sets = holds.groupBy("e").agg(F.count(F.lit(1)).alias("m"), F.sum("rows").alias("n_e"), F.bit_xor(F.xxhash64("k")).alias("x"), F.sum(F.xxhash64("k", F.lit(1)).cast("decimal(38,0)")).alias("s"))
    sets = stage(sets.select("e", F.xxhash64("m", "x", "s").alias("c"), F.least("m", F.lit(support)).alias("least"), "n_e"), "entity_sets")
    held = stage(holds.join(sets, "e").groupBy("c", "k").agg(F.first("rows").alias("rows"), F.first("least").alias("least"), F.first("n_e").alias("n_e")), "held")
    keys = stage(held.select("k").distinct(), "holding_texts")
    of_text = attach(texts, keys, ["k"], "inner").dropDuplicates(["k"]).select("k", _terms(F.col("text")).alias("all")).select("k", F.explode_outer("all").alias("term"))
    of_text = stage(of_text.filter(F.col("term").isNotNull()), "terms_of_texts")
    together = of_text.join(held, "k").groupBy("c", "term", "n_e", "least").agg(F.count(F.lit(1)).alias("m"), F.sum("rows").alias("n_et"))
    together = stage(together.filter(F.col("m") >= F.col("least")).select("c", "term", "n_e", "n_et"), "together")
    wanted = stage(together.select("term").distinct(), "wanted_terms")
    every = texts.select(_terms(F.col("text")).alias("all")).select(F.explode_outer("all").alias("term"))
    if measure(wanted).bytes <= BROADCAST_BYTES:
        counted = every.join(F.broadcast(wanted), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    else:
        # tasks add up their own terms first, so that the words of the corpus are not shuffled one by one
        counted = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(wanted, "term")
    counts = stage(counted, "term_counts")
    n = texts.count()
    content = F.log2(F.lit(float(n)) / F.col("n_e"))
    pmi = F.log2(F.col("n_et") * F.lit(float(n)) / (F.col("n_e") * F.col("n_t")))
    # an entity in every document has no information to lose
    telling = stage(together.join(counts, "term").filter((content > 0) & (pmi >= disclosure * content)).select("c", "term"), "telling")
    return of_text.join(held.select("k", "c"), "k").join(telling, ["c", "term"]).groupBy("k").agg(F.collect_set("term").alias("terms"))


def find_private(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, k, spans`` per row of ``docs``: spans by kind as listed in ``KINDS``, then start.

    ``k`` is a hash of the text.  NULL and empty texts have no spans.  Repeated
    rows get the same spans; rows that share an id are rows of their own.  Texts
    without a personal datum get no ``term`` spans.  Other columns are not read.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("k", F.xxhash64("text"))
    base = stage(texts.select("doc_id", "k", base_spans(F.col("text")).alias("spans")), "base_spans")
    each = base.filter(F.size("spans") > 0).select("k", F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["value"]))).alias("e"))
    holds = stage(each.select("k", F.explode("e").alias("e")).groupBy("e", "k").agg(F.count(F.lit(1)).alias("rows")), "holds")
    found = stage(revealing_terms(texts.select("k", "text"), holds, disclosure, support), "revealing")
    keys = stage(found.select("k"), "revealing_keys")
    chosen = attach(texts.select("k", "text"), keys, ["k"], "inner").dropDuplicates(["k"]).join(found, "k")
    added = stage(chosen.select("k", term_spans(F.col("text"), F.col("terms")).alias("added")), "term_spans")
    none = F.array().cast(SPAN_TYPE)
    return base.join(added, "k", "left").select("doc_id", "k", F.concat("spans", F.coalesce("added", none)).alias("spans"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Counts and digests of the spans per document."""
    spans = F.col("spans")
    found = find_private(docs, doc_id, text, **options)
    return found.select(
        "doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in KINDS),
        digest(of_kinds(spans, BASE_KINDS)).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", generalise: bool = True, **options) -> DataFrame:
    """``doc_id, text`` with personal data replaced by their kind.

    Revealing terms become ``[NUMBER]`` or ``[TERM]``, or are removed unless
    ``generalise``.  One row per different (id, text).
    """
    found = find_private(docs, doc_id, text, **options).dropDuplicates(["doc_id", "k"]).withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("_k", F.xxhash64("text")).dropDuplicates(["doc_id", "_k"])

    @F.pandas_udf("STRING")
    def replace(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(texts, lists):
            parts, at = [], 0
            for a, b, kind, value in sorted((s["start"], s["end"], s["kind"], s["value"]) for s in spans):
                if a < at:
                    at = max(at, b)
                    continue
                general = "[NUMBER]" if kind == TERM and DIGIT.search(value) else f"[{kind.upper()}]"
                parts += [t[at:a], general if generalise or kind != TERM else ""]
                at = b
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    both = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("k")))
    return both.select("doc_id", replace(F.col("text"), F.col("spans")).alias("text"))
