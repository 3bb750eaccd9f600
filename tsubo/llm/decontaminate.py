"""Find short test items inside long documents.

Items are partitioned by size: class ``c`` holds those of ``2 ** c`` to
``2 ** (c + 1) - 1`` distinct shingles.  A class has one sketch length, and one
least number of shingles that a document must have to reach the containment of
any of its items.  An item's sketch are its shingles with the smallest hashes
(bottom-k MinHash).  A document that contains an item of ``n`` shingles, of
which ``need`` reach the containment, misses at most ``n - need`` of them; the
sketch length of the class is above that for each of its items, so the document
holds one of the sketch: the search has no false negatives, unlike banded
signatures, whose recall sinks with the square of the size ratio.  A document
probes only classes it is large enough for, and is verified, on the text of the
shingles, only against the classes it hit.

An item shorter than a shingle is one shingle of all its words.  Documents are
cut into windows of those lengths too, so that it is found inside long texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.llm.words import over_shingles, shingle_hash, shingle_text, words
from tsubo.operators.lookup import BROADCAST_BYTES, attach
from tsubo.sources.staging import measure, stage

SHINGLE_WORDS = 5
CONTAINMENT_PERCENT = 80


def _tokens(text: Column) -> Column:
    return words(F.lower(text))


def _needed(n: Column, percent: int) -> Column:
    """The least number of shared shingles, of ``n``, that reaches ``percent``; one at least."""
    return F.greatest(F.ceil(n * percent / F.lit(100)).cast("bigint"), F.lit(1).cast("bigint"))


def size_class(n: Column) -> Column:
    """``c`` for ``2 ** c <= n < 2 ** (c + 1)``, from the binary digits, which no rounding touches."""
    return F.length(F.bin(n)) - 1


def sketch_length(percent: int) -> Column:
    """Shingles that an item of the column ``size_class`` puts into the search: one more than the largest item of the class may miss."""
    most = F.expr("shiftleft(1L, size_class + 1)") - 1
    return most - _needed(most, percent) + 1


def classes_within(room: Column, percent: int) -> Column:
    """One bit per size class of which a document with ``room`` shingles can contain an item: ``2 ** c * percent / 100 <= room``."""
    largest = F.floor(room * 100 / F.lit(percent))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(largest))) - 1


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text", percent: int = CONTAINMENT_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per item and distinct shingle: ``item_id, n, need, size_class, rank, width, shingle, h``.

    ``rank`` orders an item's shingles by hash.  ``width`` is the number of words of
    the shingle, smaller than the parameter where the item is shorter.  Items
    without words have no rows; rows that share an ``item_id`` are one item.
    """
    tokens = items.select(F.col(item_id).alias("item_id"), _tokens(F.col(text)).alias("t"))
    each = tokens.select("item_id", over_shingles(F.col("t"), width, shingle_text).alias("all")).select("item_id", F.explode_outer("all").alias("shingle"))
    grouped = each.groupBy("item_id").agg(F.collect_set("shingle").alias("all"))
    # hashes are computed from the words, exactly as on the document side
    hashed = F.transform("all", lambda s: F.struct(over_hash(s, width).alias("h"), s.alias("shingle")))
    listed = grouped.select("item_id", F.size("all").cast("bigint").alias("n"), F.sort_array(hashed).alias("all"))
    listed = listed.select("item_id", "n", F.posexplode("all").alias("rank", "s"))
    words_in = F.size(F.split("s.shingle", " "))
    return listed.select("item_id", "n", _needed(F.col("n"), percent).alias("need"), size_class(F.col("n")).alias("size_class"), "rank", words_in.alias("width"), "s.shingle", "s.h")


def over_hash(shingle: Column, width: int) -> Column:
    """The hash of a shingle's words, from its text (words hold no blanks)."""
    return shingle_hash(F.split(shingle, " "), F.lit(0), width)


def row_key(docs: DataFrame, doc_id: str, text: str) -> Column:
    """A hash of id and text; equal keys of different rows only cost a verification."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def contained(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = CONTAINMENT_PERCENT,
    width: int = SHINGLE_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared`` with 100 * n_shared >= percent * n_item.

    Shingles are distinct, of lower-cased words.  An item of fewer words than a
    shingle is one shingle of all of them, found wherever a document holds these
    words in a row.  NULL and empty texts have no shingles and no pairs.  Rows with
    the same id and text count once; rows with one id but different texts are
    separate documents.  Other columns are not read.

    The document side is one narrow pass against the sketches, which are
    broadcast when measured small enough and joined by shuffle otherwise; only
    the texts of hits are read for verification.
    """
    return _pairs(docs, items, doc_id, text, percent, width, broadcast_bytes).drop("row_key")


def _windows(tokens: Column, widths: list[int], value) -> Column:
    """``value`` of every window of each of ``widths``; a text shorter than a window gives one of all its words."""
    return F.concat(*(over_shingles(tokens, w, value) for w in widths))


def _pairs(docs: DataFrame, items: DataFrame, doc_id: str, text: str, percent: int = CONTAINMENT_PERCENT, width: int = SHINGLE_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The pairs of ``contained`` with the ``row_key`` of their document."""
    wanted = stage(item_shingles(items, percent=percent, width=width), "item_shingles")
    # at most one length per word of a shingle
    widths = sorted(r["width"] for r in wanted.select("width").distinct().collect()) or [width]
    sketch = wanted.filter(F.col("rank") < sketch_length(percent)).select("h", F.expr("shiftleft(1L, size_class)").alias("class"))
    # one row per hash, with one bit per class that it stands for
    probe = sketch.groupBy("h").agg(F.bit_or("class").alias("classes"))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row_key(docs, doc_id, text).alias("row_key"))
    tokens = keyed.select("row_key", _tokens(F.col("text")).alias("t"))
    # sizes and shingles are columns before they are opened, so that no opened row carries an array; the outer form
    # keeps the planner from filtering on the array, which would compute it again for every element
    room = sum((F.greatest(F.size("t") - (w - 1), F.lit(1)) for w in widths[1:]), F.greatest(F.size("t") - (widths[0] - 1), F.lit(1)))
    hashes = tokens.select("row_key", room.cast("bigint").alias("room"), _windows(F.col("t"), widths, shingle_hash).alias("all"))
    hashes = hashes.select("row_key", "room", F.explode_outer("all").alias("h"))
    hits = attach(hashes, probe, ["h"], "inner", broadcast_bytes).select("row_key", F.col("classes").bitwiseAND(classes_within(F.col("room"), percent)).alias("classes"))
    hits = stage(hits.filter("classes != 0").groupBy("row_key").agg(F.bit_or("classes").alias("classes")), "hits")
    found = attach(keyed, hits, ["row_key"], "inner", broadcast_bytes).dropDuplicates(["row_key", "doc_id", "text"])
    found = found.select("row_key", "doc_id", "classes", _tokens(F.col("text")).alias("t"))
    shingles = found.select("row_key", "doc_id", "classes", F.array_distinct(_windows(F.col("t"), widths, shingle_text)).alias("all"))
    shingles = shingles.select("row_key", "doc_id", "classes", F.explode_outer("all").alias("shingle"))
    targets = wanted.select("item_id", "n", "need", "size_class", "shingle")
    small = measure(targets).bytes <= broadcast_bytes
    shared = shingles.join(F.broadcast(targets) if small else targets, "shingle").filter("classes & shiftleft(1L, size_class) != 0")
    shared = shared.groupBy("row_key", "doc_id", "item_id", "n", "need").count()
    return shared.filter(F.col("count") >= F.col("need")).select("row_key", "doc_id", "item_id", F.col("n").alias("n_item"), F.col("count").alias("n_shared"))


def clean_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, columns unchanged; a NULL text contains none.

    Of rows that share an id, or have none, only those whose own text contains an item go.
    """
    leaks = stage(_pairs(docs, items, doc_id, text, **options).select("doc_id", "row_key").distinct(), "leaks").withColumn("_leak", F.lit(True))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), row_key(docs, doc_id, text).alias("row_key"))
    return attach(rows, leaks, ["doc_id", "row_key"]).filter(F.col("_leak").isNull()).select("row.*")
