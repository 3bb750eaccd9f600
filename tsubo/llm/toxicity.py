"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their beginnings of 4 to 6 letters
(so that inflected forms of one stem share a term), each hashed to one of 2**20
buckets; a term counts once per text.  The score is the logistic of

    b + sum_i w_i + sum_{i<j} <v_i, v_j>        over the text's terms,

so a pair of terms, such as an insult and the mention of a group, can weigh more
(or less) than both alone, which additive weights cannot express.

Only buckets whose share among toxic and other texts differs clearly (likelihood
ratio) get parameters; a text without any of them has the score of ``b`` alone.
The machine is fitted by full-batch Adam steps: the sample stays in partitions, each
step sums the partitions' gradients.  Texts are scored in bounded pieces, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.functions.keys import shuffle_order
from tsubo.llm.byte_hash import Hasher, buffers, chunks, mix
from tsubo.llm.shingles import CHUNK_BYTES, slices
from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage

# Learning reads at most this many labelled documents, in a repeatable random order.
TRAINING_DOCUMENTS = 20_000
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)
# Buckets with parameters: at most so many, each with at least this likelihood ratio (in nats, doubled as usual).
VOCABULARY = 4096
LEAST_RATIO = 12.0
FACTORS = 8
STEPS, RATE, PENALTY = 60, 0.15, 1e-4
PARTS = 8
# Gradients are added up as whole numbers of these units, so that sums do not depend on the order of texts and tasks
# (while they stay below 2**53 of them).
UNIT = 1 << 34
THRESHOLD = 0.3

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every term of a chunk of texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    hasher = Hasher(data)
    letters = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(letters, starts)
    rows, found = [row], [_bucket(hasher.ranges(starts, ends), 0)]
    for k in BEGINNINGS:
        end = np.append(letters, len(data))[np.minimum(at + k, len(letters))]
        longer = end < ends
        rows.append(row[longer])
        found.append(_bucket(hasher.ranges(starts[longer], end[longer]), k))
    return np.concatenate(rows), np.concatenate(found)


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a long text that end between words, of bounded length unless one word is longer."""
    at = 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(~_WORD[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(~_WORD[data[end:]])
                end = end + int(later[0]) + 1 if len(later) else len(data)
        yield at, end
        at = end


def row_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of bounded pieces of a text column: number of rows, and row and bucket of their distinct terms, ascending."""
    data, offsets = buffers(pc.utf8_lower(column.fill_null("") if column.null_count else column))
    for row, end in chunks(offsets, CHUNK_BYTES):
        here = data[offsets[row] : offsets[end]]
        if end == row + 1 and len(here) > CHUNK_BYTES:
            found = np.unique(np.concatenate([np.unique(_terms(here[a:b], np.array([0, b - a]))[1]) for a, b in _pieces(here)]))
            yield 1, np.zeros(len(found), np.int64), found
        else:
            rows, terms = _terms(here, offsets[row : end + 1] - offsets[row])
            both = np.unique(rows * BUCKETS + terms)
            yield end - row, both // BUCKETS, both % BUCKETS


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned from: a quarter, by the checksum of the id; NULL ids are not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Machine:
    feature: np.ndarray  # bucket -> feature number, or -1
    bias: float
    weights: np.ndarray  # per feature
    factors: np.ndarray  # features by FACTORS

    def margins(self, rows: int, row: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The machine's value per row, from the row and feature of every term (rows ascending)."""
        return _margins(self.bias, self.weights, self.factors, rows, row, features)[0]


def _sums(rows: int, row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per row the sum of its values (any order of additions is fixed by the input)."""
    out = np.zeros((rows, *values.shape[1:]))
    if len(row):
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[begin]] = np.add.reduceat(values, begin, axis=0)
    return out


def _margins(bias, weights, factors, rows, row, features) -> tuple[np.ndarray, np.ndarray]:
    own = factors[features]
    total = _sums(rows, row, own)
    square = _sums(rows, row, (own * own).sum(axis=1))
    return bias + _sums(rows, row, weights[features]) + 0.5 * ((total * total).sum(axis=1) - square), total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS) -> DataFrame:
    """``text, toxic`` of at most ``most`` labelled documents (``doc_id, toxic`` without NULLs; contradicting labels count as toxic)."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = known.join(docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct(), "doc_id", "left_semi")
    chosen = stage(present.orderBy(shuffle_order(F.col("doc_id")), "doc_id").limit(most).select("doc_id", F.col("toxic").cast("int").alias("_toxic")), "toxicity_sample")
    rows = attach(docs.select("doc_id", "text"), chosen, ["doc_id"], "inner").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_toxic").alias("toxic"))
    return stage(rows.select("text", "toxic").repartition(PARTS, F.xxhash64("doc_id")), "toxicity_texts")


def choose_terms(sample: DataFrame, vocabulary: int = VOCABULARY, least: float = LEAST_RATIO) -> tuple[np.ndarray, int, int]:
    """Feature number per bucket (-1: none), and how many toxic and other texts there are.

    A bucket's likelihood ratio compares its share of toxic texts with its share of the others.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(parts):
            toxic, at = batch.column("toxic").to_numpy(), 0
            for rows, row, bucket in row_terms(batch.column("text")):
                for label in (0, 1):
                    seen[label] += np.bincount(bucket[toxic[at : at + rows][row] == label], minlength=BUCKETS)
                at += rows
        found = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (found, seen[0][found], seen[1][found])], ["bucket", "other", "toxic"])

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    feature = np.full(BUCKETS, -1, np.int32)
    if not n0 or not n1:
        return feature, n1, n0
    counts = sample.mapInArrow(count, "bucket BIGINT, other BIGINT, toxic BIGINT").groupBy("bucket").agg(F.sum("other").alias("k0"), F.sum("toxic").alias("k1"))

    def part(k: Column, n: int, share: Column) -> Column:
        cells = ((k, k / (share * n)), (n - k, (n - k) / ((1 - share) * n)))
        return sum((F.when(c > 0, c * F.ln(r)).otherwise(0.0) for c, r in cells), F.lit(0.0))

    share = (F.col("k0") + F.col("k1")) / F.lit(n0 + n1)
    ratio = F.round(2 * (part(F.col("k0"), n0, share) + part(F.col("k1"), n1, share)), 6)
    best = counts.withColumn("ratio", ratio).filter(F.col("ratio") >= least).orderBy(F.desc("ratio"), "bucket").limit(vocabulary).select("bucket").collect()
    feature[sorted(r["bucket"] for r in best)] = np.arange(len(best))
    return feature, n1, n0


def fit(sample: DataFrame, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY, factors: int = FACTORS, vocabulary: int = VOCABULARY) -> Machine | None:
    """Learn from ``text, toxic`` (0 or 1), a bounded written table; None where one of the two labels is missing.

    The driver gets the chosen buckets and, per step and part, one gradient: sizes fixed by the parameters.
    """
    feature, toxic, other = choose_terms(sample, vocabulary)
    if not toxic or not other:
        return None
    n, width = toxic + other, int(feature.max()) + 1
    bias = float(np.log(toxic / other))
    context = sample.sparkSession.sparkContext
    if not width:
        return Machine(feature, bias, np.zeros(0), np.zeros((0, factors)))
    table = context.broadcast(feature)

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts):
            sets = []
            for rows, row, bucket in row_terms(batch.column("text")):
                number = table.value[bucket]
                cut = np.searchsorted(row[number >= 0], np.arange(rows + 1))
                chosen = number[number >= 0]
                sets += [chosen[cut[i] : cut[i + 1]].tobytes() for i in range(rows)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(sets, pa.binary())], ["toxic", "features"])

    encoded = stage(sample.mapInArrow(encode, "toxic INT, features BINARY"), "toxicity_features")
    table.destroy()

    def gradient_of(bias: float, weights: np.ndarray, own: np.ndarray):
        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g0, g1, g2 = 0.0, np.zeros(width), np.zeros((width, factors))
            for batch in parts:
                data, offsets = buffers(batch.column("features"))
                features, count = data.view(np.int32), np.diff(offsets) // 4
                row = np.repeat(np.arange(len(count)), count)
                value, total = _margins(bias, weights, own, len(count), row, features)
                miss = _sigmoid(value) - batch.column("toxic").to_numpy()
                pull = np.rint(UNIT * miss[row][:, None] * (total[row] - own[features]))
                miss = np.rint(UNIT * miss)
                g0 += miss.sum()
                g1 += np.bincount(features, miss[row], width)
                for f in range(factors):
                    g2[:, f] += np.bincount(features, pull[:, f], width)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[g0], g1, g2.ravel()]).tobytes()], pa.binary())], ["gradient"])

        return work

    start = np.random.default_rng(13).normal(0, 0.05, (width, factors))
    x = np.concatenate([[bias], np.zeros(width), start.ravel()])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        work = gradient_of(float(x[0]), x[1 : width + 1].astype(np.float32), x[width + 1 :].reshape(width, factors).astype(np.float32))
        parts = encoded.mapInArrow(work, "gradient BINARY").collect()
        g = sum(np.frombuffer(p["gradient"]) for p in parts) / UNIT / n
        g[1:] += penalty * x[1:]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (1 - (step - 1) / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Machine(feature, float(x[0]), x[1 : width + 1], x[width + 1 :].reshape(width, factors))


def score(docs: DataFrame, machine: Machine | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` per row, from the text alone.

    A text that is NULL, empty or without a known term has the score of the bias
    alone; all scores are 0 where nothing was learned.  Repeated rows stay; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if machine is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(parts):
            values = [np.zeros(0)]
            for count, row, bucket in row_terms(batch.column("text")):
                number = known.feature[bucket]
                values.append(known.margins(count, row[number >= 0], number[number >= 0]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_sigmoid(np.concatenate(values)), pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score DOUBLE")


def assess(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; learns only from labels that are not held out."""
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    machine = fit(training_rows(docs, known))
    found = score(docs, machine)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
