"""Language identification with blended-spectrum presence kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3) that
both hold, normalised by the geometric mean of the numbers that each holds.
Landmark texts give a Nystroem approximation; one-versus-rest kernel ridge
regression on it is solved from sums over the training texts, in which every
language weighs the same.  Texts are scored in batches: a 0/1 matrix of texts by
n-grams times one of n-grams by landmarks, times the weights.

Letters of any script are lower-cased; every other character counts as one and
the same border.  The features are all n-grams that the landmarks hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.functions.keys import shuffle_order
from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage

# Learning reads at most this many texts per language, in a repeatable random order ...
TEXTS_PER_LANGUAGE = 600
# ... and the first of them are landmarks, this many over all languages.
LANDMARKS = 128
# Texts up to this many characters are preferred as landmarks, so that the model stays small.
SHORT_LANDMARK = 1 << 16
# The sample is ranked in this many slices per language first, so that no task sees all rows of a language.
SLICES = 64
RIDGE = 1e-3
UNDETERMINED = "und"
N = 3
# Texts of a matrix product: 128, or as few as keep it below so many numbers.
BATCH_TEXTS, BATCH_NUMBERS, BATCH_LETTERS = 128, 1 << 23, 1 << 19
# Odd numbers that spread n-grams over a table, one for each level of the lookup.
SPREAD = [0x9E3779B97F4A7C15 + 2 * 0xD6E8FEB86659FD93 * k & 0xFFFFFFFFFFFFFFFF for k in range(64)]

_is_letter: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether a code point is a letter (built once per process)."""
    global _is_letter
    if _is_letter is None:
        _is_letter = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _is_letter


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def windows(codes: np.ndarray) -> list[np.ndarray]:
    """All n-grams as numbers of three 21-bit fields, per n; 0 stands before shorter ones, 1 for a border."""
    one = np.where(letter_table()[codes], codes, 1).astype(np.int64)
    two = one[:-1] << 21 | one[1:]
    return [one, two, two[:-1] << 21 | one[2:]]


def grams_of(codes: np.ndarray) -> np.ndarray:
    """The distinct n-grams."""
    return np.concatenate([np.unique(w) for w in windows(codes)])


@dataclass
class Model:
    grams: np.ndarray  # the n-gram of each feature, sorted; then -1, which no n-gram is
    levels: list[tuple[int, int, np.ndarray]]  # multiplier, bits and feature per slot; n-grams that share a slot go to the next level
    landmarks: np.ndarray  # features by landmarks, 0/1, each column divided by the root of its sum
    weights: np.ndarray  # landmarks by languages
    languages: list[str]
    usual: int  # the language that most texts have

    def features(self) -> int:
        return len(self.landmarks)

    def batch_texts(self) -> int:
        return int(max(1, min(BATCH_TEXTS, BATCH_NUMBERS // (self.features() + 1))))


def _slots(grams: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
    return (grams.astype(np.uint64) * np.uint64(multiplier) >> np.uint64(64 - bits)).astype(np.int64)


def lookup_levels(grams: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Tables that find each of the distinct ``grams``, whatever their number; free slots hold ``len(grams)``."""
    levels, left = [], np.arange(len(grams))
    while len(left):
        bits = int(len(left)).bit_length() + 4
        multiplier = SPREAD[len(levels)]
        slots = _slots(grams[left], multiplier, bits)
        table = np.full(1 << bits, len(grams), np.int32)
        table[slots] = left
        levels.append((multiplier, bits, table))
        left = left[table[slots] != left]
    return levels


def features_of(grams: np.ndarray, model: Model) -> np.ndarray:
    """The features of n-grams; those that no landmark holds are left out."""
    found, left = [], grams
    for multiplier, bits, table in model.levels:
        at = table[_slots(left, multiplier, bits)]
        hit = model.grams[at] == left
        found.append(at[hit])
        left = left[~hit]
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def kernel_rows(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Kernel of each text with each landmark, and whether the text has a letter."""
    present = np.zeros((len(texts), model.features()), np.float32)
    letters = np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        for at in range(0, max(len(text), 1), BATCH_LETTERS):
            codes = code_points(text[max(at - N + 1, 0) : at + BATCH_LETTERS])
            letters[row] |= letter_table()[codes].any()
            for grams in windows(codes):
                present[row, features_of(grams, model)] = 1
    size = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
    return (present @ model.landmarks) / size, letters


def _batches(parts: Iterator[pa.RecordBatch], size: int = BATCH_TEXTS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in parts:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            yield piece, [t or "" for t in piece.column("text").to_pylist()]


def fit(rows: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Learn from ``doc_id, text, lang`` rows without NULLs; None where there are none.

    Of rows that share an id and a language the least text is read.  The driver
    gets n-grams of the landmarks and, per task, sums of landmarks squared.
    """
    numbered = rows.select("doc_id", "lang", shuffle_order(F.col("doc_id")).alias("order"), F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).alias("slice"))
    order = Window.partitionBy("lang").orderBy("order", "doc_id")
    ranked = numbered.withColumn("in_slice", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("order", "doc_id"))).filter(F.col("in_slice") <= per_language)
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
    chosen = stage(ranked.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank")), "language_sample")
    sample = stage(attach(rows, chosen, ["doc_id", "lang"], "inner").groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text")), "language_texts")
    sampled = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    languages = sorted(sampled)
    if not languages:
        return None
    n = sum(sampled.values())
    # every language weighs the same, or one of few texts would hardly ever be predicted
    weight = {lang: n / len(languages) / count for lang, count in sampled.items()}

    def distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _batches(parts):
            found = [grams_of(code_points(t)).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["grams"])

    first = sample.orderBy(F.length("text") > SHORT_LANDMARK, "rank", "lang", "doc_id").limit(landmarks).select("text")
    sets = [np.frombuffer(r["grams"], np.int64) for r in first.mapInArrow(distinct, "grams BINARY").collect()]
    grams = np.unique(np.concatenate(sets))
    marks = np.zeros((len(grams), len(sets)), np.float32)
    for column, s in enumerate(sets):
        marks[np.searchsorted(grams, s), column] = 1 / np.sqrt(max(len(s), 1))
    texts_of = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    usual = max(range(len(languages)), key=lambda k: (texts_of[languages[k]], -k))
    model = Model(np.append(grams, -1), lookup_levels(grams), marks, np.zeros((len(sets), len(languages))), languages, usual)

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, target = np.zeros((len(sets), len(sets))), np.zeros((len(sets), len(languages)))
        for batch, texts in _batches(parts, model.batch_texts()):
            rows, _ = kernel_rows(texts, model)
            rows = rows.astype(np.float64)
            goal = np.array([[1.0 if lang == one else -1.0 for one in languages] for lang in batch.column("lang").to_pylist()]).reshape(-1, len(languages))
            weighted = rows * np.array([weight[lang] for lang in batch.column("lang").to_pylist()])[:, None]
            square += weighted.T @ rows
            target += weighted.T @ goal
        yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary()), pa.array([target.tobytes()], pa.binary())], ["square", "target"])

    parts = sample.select("text", "lang").repartition(8, F.xxhash64("text")).mapInArrow(sums, "square BINARY, target BINARY").collect()
    square = sum(np.frombuffer(p["square"]).reshape(len(sets), -1) for p in parts)
    target = sum(np.frombuffer(p["target"]).reshape(len(sets), -1) for p in parts)
    scaled = (marks > 0).astype(np.float64).T @ marks / np.sqrt(np.maximum((marks > 0).sum(axis=0), 1))[:, None]
    model.weights = np.linalg.solve(square + ridge * n * scaled + 1e-6 * n * np.eye(len(sets)), target)
    return model


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` per row, from the text alone.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing was
    learned.  A text that shares no n-gram with any landmark gets the language that
    most learned texts have, with the score of a guess; of languages with equal
    values the alphabetically first wins.  Whole texts are read, in bounded pieces.
    ``score`` is the share of the winner among the exponentials of all languages'
    regression values.  Repeated rows are rows of their own; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], object)
        for batch, texts in _batches(parts, known.batch_texts()):
            kernel, letters = kernel_rows(texts, known)
            values = kernel @ known.weights
            best = np.where(kernel.any(axis=1), values.argmax(axis=1), known.usual)
            share = 1 / np.exp(4 * (values - values.max(axis=1, keepdims=True))).sum(axis=1)
            best = np.where(letters, best, len(known.languages))
            score = np.where(letters, np.clip(share, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred STRING, score DOUBLE")


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: a quarter, by the checksum of the id; NULL ids are not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs`` (``doc_id, text, lang``).

    Learns from texts with a language and an id that are not held out.
    """
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = fit(known.select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
