"""Mixing documents to target weights when their domain is only known in probability.

A naive Bayes classifier, learned from a labelled table, gives every document
a posterior over domains.  Rates r >= 0 are then fitted so that the expected
tokens of domain d, sum_i r_i * tokens_i * p_id, match target totals in the
least-squares sense.

The fit is a projected gradient: all rates start at 1, and a step takes the gap
between reached and wanted tokens, g, to ``r_i <- max(0, r_i - p_i . v)`` with
``v = G^-1 g``.  G, the Gram matrix of the documents whose rate is positive,
scales the gradient so that a step without projection closes the whole gap; a
step that does not lower the misfit is halved.  Targets that cannot be met, and
steps that stall, are finished on the convex dual: there the rates of least
misfit nearest to 1 (weighted by tokens) have the form max(0, 1 + p_i . y), and y
is found by Newton steps with a proximal term that shrinks from round to round.

One step, of either kind, is one distributed sum; the driver holds one vector of
length D (the number of domains) per step.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.functions.keys import shuffle_order
from tsubo.llm.words import words
from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage
from tsubo.sources.tables import planned_bytes

# Words are counted in this many buckets.
BUCKETS = 4096
# The classifier is fitted on at most this many labelled documents, in a repeatable random order.
TRAINING_DOCUMENTS = 20_000
# A document's words weigh in as this many words at most, which keeps memberships soft.
EVIDENCE_WORDS = 60
# Log-weights are kept as integers in these units, so that sums do not depend on their order.
UNIT = 1 << 16
# Posteriors are rounded to this many digits.  Documents with equal posteriors have equal rates, so
# the fit runs on one cell per combination: for three domains some 500,000 at most, whatever the input.
DIGITS = 3
# Files of the written cells, which are few; and bytes of documents whose memberships, a few dozen bytes each, share a file.
CELL_FILES, BYTES_PER_FILE = 8, 64 << 20
TOLERANCE = 1e-6
# Sums that the projected gradient may take, and the shortest part of a step: of 213 random sets of targets that can be
# met, nine in ten took 21 sums at most.
GRADIENT_SUMS, SHORTEST = 60, 1e-3
# Weight of the proximal term, what each round multiplies it by, and the least: below it 1 + p . y loses digits.
PROXIMAL, SHRINK, LEAST = 1e-2, 0.1, 1e-9
# Sums after which the dual gives up and returns its best rates, with a warning; 400 random sets took 61 at most.
DUAL_SUMS = 300

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.85, "low": 0.10, "toxic": 0.05}


def label_domain() -> Column:
    """Domain of a row of ``labels``; NULL where it says nothing."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def word_weights(docs: DataFrame, labels: DataFrame, domains=DOMAINS, most: int = TRAINING_DOCUMENTS) -> tuple[DataFrame, list[float]]:
    """Integer log-weights per bucket (``bucket, w_0, w_1, ...``; BUCKETS rows) and the domains' log-priors.

    ``labels`` has ``doc_id, domain``; a document with contradicting labels
    takes the first domain in alphabetical order.
    """
    known = labels.filter(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = known.orderBy(shuffle_order(F.col("doc_id")), "doc_id").limit(most)
    known = stage(known, "training")
    rows = attach(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()), known, ["doc_id"], "inner")
    each = rows.select("domain", F.explode_outer(words(F.col("text"))).alias("word")).filter(F.col("word").isNotNull())
    counts = {(r["domain"], r["bucket"]): r["n"] for r in each.groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {d: sum(n for (e, _), n in counts.items() if e == d) for d in domains}
    n_docs = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    priors = [math.log((n_docs.get(d, 0) + 1) / (sum(n_docs.values()) + len(domains))) for d in domains]
    table = [
        (b, *(round(UNIT * math.log((counts.get((d, b), 0) + 0.5) / (totals[d] + 0.5 * BUCKETS))) for d in domains))
        for b in range(BUCKETS)
    ]
    schema = "bucket INT, " + ", ".join(f"w_{k} BIGINT" for k in range(len(domains)))
    return docs.sparkSession.createDataFrame(table, schema), priors


def memberships(docs: DataFrame, labels: DataFrame, domains=DOMAINS) -> DataFrame:
    """``doc_id, tokens, p_<domain>...`` per document; posteriors sum to 1 up to rounding.

    Rows with the same id and text are one document.  A NULL or empty text has 0
    tokens and the priors as its posterior; without labels all domains are alike.
    """
    weights, priors = word_weights(docs, labels, domains)
    sums = [F.coalesce(F.sum(f"w_{k}"), F.lit(0)).alias(f"s_{k}") for k in range(len(domains))]
    # identical rows give the same key, so each row is counted within its own key and then once
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), words(F.col("text")).alias("words"))
    # the size is a column before the words are opened, so that no opened row carries the array
    each = keyed.select("doc_id", "row_key", F.size("words").alias("size"), "words").select("doc_id", "row_key", "size", F.explode_outer("words").alias("word"))
    scored = each.select("doc_id", "row_key", "size", F.when(F.col("word").isNotNull(), _bucket(F.col("word"))).alias("bucket")).join(F.broadcast(weights), "bucket", "left")
    per = scored.groupBy("doc_id", "row_key", "size").agg(F.count("bucket").alias("n"), *sums)
    # n is a multiple of size when rows repeat; the mean weight of a word is the same
    evidence = F.least(F.col("size"), F.lit(EVIDENCE_WORDS)) / F.greatest(F.col("n"), F.lit(1)) / F.lit(UNIT)
    logits = [F.col(f"s_{k}") * evidence + F.lit(prior) for k, prior in enumerate(priors)]
    named = per.select("doc_id", F.col("size").cast("bigint").alias("tokens"), F.array(*logits).alias("l"))
    named = named.withColumn("top", F.array_max("l"))
    for k in range(len(domains)):
        named = named.withColumn(f"e_{k}", F.exp(F.get("l", F.lit(k)) - F.col("top")))
    total = sum((F.col(f"e_{k}") for k in range(1, len(domains))), F.col("e_0"))
    return named.select("doc_id", "tokens", *(F.round(F.col(f"e_{k}") / total, DIGITS).alias(f"p_{d}") for k, d in enumerate(domains)))


def _gradient_path(sums, aim: np.ndarray, met: float, most: int = GRADIENT_SUMS) -> tuple[list[np.ndarray], float]:
    """Steps of the scaled projected gradient and the misfit (Euclidean) that they end with, which no step raises."""
    path: list[np.ndarray] = []
    reached, _, gram = sums(path)
    gap, taken = reached - aim, 1
    while np.abs(gap).max() > met:
        step, part = np.linalg.solve(gram + LEAST * np.eye(len(aim)), gap), 1.0
        while taken < most and part > SHORTEST:
            reached, _, found = sums([*path, part * step])
            taken += 1
            if np.linalg.norm(reached - aim) < np.linalg.norm(gap) * (1 - 1e-3 * part):
                break
            part /= 2
        else:
            break
        path, gap, gram = [*path, part * step], reached - aim, found
    return path, float(np.linalg.norm(gap))


def _dual_step(sums, aim: np.ndarray, met: float, most: int = DUAL_SUMS) -> tuple[np.ndarray, float]:
    """The one step from rate 1 that leads to the least misfit, and that misfit; for targets that cannot be met."""
    y = center = np.zeros(len(aim))
    weight, last, taken = PROXIMAL, None, 1
    reached, square, gram = sums([-y])
    best, least = y, float(np.linalg.norm(reached - aim))
    while np.abs(reached - aim).max() > met:
        # Newton steps to the least of square - y . aim + weight / 2 * |y - center|^2
        while taken < most:
            slope = reached - aim + weight * (y - center)
            if min(np.abs(slope).max() * 1000, np.abs(reached - aim).max()) <= met:
                break
            step = -np.linalg.solve(gram + weight * np.eye(len(aim)), slope)
            value = square - y @ aim + weight / 2 * float((y - center) @ (y - center))
            part = 1.0
            while taken < most and part > 1e-6:
                to = y + part * step
                found = sums([-to])
                taken += 1
                if found[1] - to @ aim + weight / 2 * float((to - center) @ (to - center)) <= value + 1e-4 * part * float(slope @ step) + 1e-15 * abs(value):
                    break
                part /= 2
            else:
                break
            y, (reached, square, gram) = to, found
        gap = reached - aim
        if np.linalg.norm(gap) < least:
            best, least = y, float(np.linalg.norm(gap))
        if last is not None and np.abs(gap - last).max() <= met / 10:
            break
        if taken >= most:
            warnings.warn(f"rates not settled after {most} sums; the misfit is {least:.2g} of all tokens", stacklevel=2)
            break
        last, center, weight = gap, y, max(weight * SHRINK, LEAST)
    return -best, least


def fit_rates(members: DataFrame, targets: Mapping[str, float] = TARGETS, budget: float | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``members`` with ``rate``: expected tokens per domain come to ``targets`` times ``budget``.

    ``members`` should read a written table.  Every step is one aggregate over its cells.
    ``budget`` is the tokens of all documents unless given.  Targets that cannot
    be met are met as far as nonnegative rates allow (least squares).  Documents
    without tokens keep rate 1.  Nothing but 1 + D + D * D sums reaches the driver.
    """
    names = list(targets)
    share = [F.col(f"p_{d}") for d in names]
    tokens = F.col("tokens")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    zero = F.lit(0.0)
    cells = stage(members.groupBy(*(f"p_{d}" for d in names)).agg(F.sum("tokens").alias("tokens")), "cells", CELL_FILES)
    whole = float(sum(targets.values())) or 1.0
    total = float(cells.agg(F.sum(tokens)).first()[0] or 0)
    if not total:
        return members.withColumn("rate", F.lit(1.0))
    budget = total if budget is None else budget
    # tokens count as shares of all tokens
    aim = np.array([targets[d] / whole for d in names]) * budget / total
    met = tolerance * max(1.0, float(aim.sum()) * total) / total

    def rate(path: list[np.ndarray]) -> Column:
        """The rate after these steps, each projected on the rates of 0 and more."""
        found = F.lit(1.0)
        for step in path:
            found = F.greatest(zero, sum((p * F.lit(float(-v)) for p, v in zip(share, step)), found))
        return found

    def sums(path: list[np.ndarray]) -> tuple[np.ndarray, float, np.ndarray]:
        """Tokens per domain, half the weighted square of the rates, and the Gram matrix of the documents with a positive rate."""
        r = F.col("_rate")
        positive = F.when(r > 0, tokens).otherwise(zero)
        row = (
            cells.withColumn("_rate", rate(path))
            .agg(
                F.sum(tokens * r * r).alias("square"),
                *(F.sum(tokens * p * r).alias(f"t_{i}") for i, p in enumerate(share)),
                *(F.sum(positive * share[i] * share[j]).alias(f"g_{i}_{j}") for i, j in pairs),
            )
            .first()
        )
        gram = np.zeros((len(names), len(names)))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = row[f"g_{i}_{j}"] / total
        return np.array([row[f"t_{i}"] for i in range(len(names))]) / total, row["square"] / total / 2, gram

    path, misfit = _gradient_path(sums, aim, met)
    if misfit > met * len(names) ** 0.5:
        step, least = _dual_step(sums, aim, met)
        path = [step] if least < misfit else path
    return members.withColumn("rate", F.when(tokens > 0, F.round(rate(path), 6)).otherwise(F.lit(1.0)))


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, budget: float | None = None) -> DataFrame:
    """``doc_id, tokens, p_<domain>..., rate`` per document.

    ``labels`` has ``doc_id, quality, toxic``.  Empty tables give no rows.  Only
    ``doc_id`` and ``text`` are read, whatever other columns are named.
    """
    named = labels.select("doc_id", label_domain().alias("domain"))
    # rows that are not read from files have no known size, and are planned as exabytes
    files = min(max(docs.sparkSession.sparkContext.defaultParallelism, -(-planned_bytes(docs) // BYTES_PER_FILE)), 2**31 - 1)
    members = stage(memberships(docs, named, tuple(targets)), "memberships", files)
    return fit_rates(members, targets, budget)
