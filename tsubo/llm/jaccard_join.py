"""Similarity classes of documents by word-shingle Jaccard: a grouped prefix join.

Documents with equal shingle sets are one class.  Classes with equal size and
equal prefix (the first tokens in one global order, so many that similar sets
must share one) are one group.  Tokens are joined on groups; group pairs that
pass the size filter and share an early token are expanded to members and verified.

The order puts tokens of common buckets last, by a fixed-size frequency sketch;
any order gives the same result, this one keeps passages that very many
documents share out of the prefixes.

Only components are asked for, so links inside a component need not be listed.
First, in rounds, every token names a leader among its holders of about one size,
and one group of each other component that holds the token is verified against it:
as many pairs as there are holders, not their square.  Then tokens are
joined on each other, but only for groups that are still in different components,
and only where the token comes so early in both prefixes that it can be the first
shared one.  A group of m near copies thus costs some m pairs, and no link between
different components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.llm.byte_hash import buffers
from tsubo.llm.components import components
from tsubo.llm.shingles import binary, bounded_batches, row_sets, slices
from tsubo.operators.lookup import attach
from tsubo.sources.staging import discard, stage

SHINGLE_WORDS = 4
SIMILAR_PERCENT = 85
# Buckets of the frequency sketch: one byte each reaches every task, whatever the input.
SKETCH = 1 << 22
# Parts of a set's count sketch, one byte each: no two sets share more tokens than the sum of the lesser counts.
PARTS = 256
# A token that this many groups hold in their prefix is moved to the end of the order.
OFTEN = 12
REORDERINGS = 2
# Rounds in which parts meet the leaders of their tokens, before all pairs between components are looked at.
ROUNDS = 2


def _token_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, k, n, d1, d2, tokens`` per row of ``doc_id, text, k``: set size, set digest and the set itself.  Texts are hashed here only."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts):
            n, d1, d2, sets = [], [], [], []
            for tokens in row_sets(batch, "text", width):
                n.append(len(tokens))
                d1.append(int(tokens.sum().view(np.int64)) if len(tokens) else 0)
                d2.append(int(np.bitwise_xor.reduce(tokens * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)) if len(tokens) else 0)
                sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), binary(sets)],
                ["doc_id", "k", "n", "d1", "d2", "tokens"],
            )

    made = docs.mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, k BIGINT, n BIGINT, d1 BIGINT, d2 BIGINT, tokens BINARY")
    return made.withColumn("c", F.xxhash64("n", "d1", "d2")).drop("d1", "d2")


def _opened(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all rows of a batch, and where each row's begin (rows + 1 numbers)."""
    data, offsets = buffers(batch.column(column))
    return data.view(np.uint64), offsets // 8


def _common_buckets(sets: DataFrame) -> np.ndarray:
    """Per bucket of tokens, the logarithm of its count where that stands out, else 0."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint32)
        for batch in parts:
            np.add.at(counts, (_opened(batch, "tokens")[0] & np.uint64(SKETCH - 1)).astype(np.int32), 1)
        mean = float(counts.mean())
        found = np.flatnonzero(counts >= mean + 3 * np.sqrt(mean) + 4)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found].astype(np.int64))], ["bucket", "n"])

    sums = sets.select("tokens").mapInArrow(count, "bucket BIGINT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n"))
    # written, so that every task sees the same order; at most SKETCH rows
    rows = stage(sums.select("bucket", F.ceil(F.log2("n")).cast("int").alias("rank")), "common").toArrow()
    ranks = np.zeros(SKETCH, np.uint8)
    ranks[rows["bucket"].to_numpy()] = rows["rank"].to_numpy()
    return ranks


def _prefixes(sets: DataFrame, ranks: np.ndarray, percent: int) -> DataFrame:
    """``doc_id, k, c, n, g, prefix, sketch``, written, of ``sets`` with n > 0: the first tokens in the order of ``ranks``, the group key, the counts."""
    shared = sets.sparkSession.sparkContext.broadcast(ranks)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in slices(parts):
            every, begin = _opened(batch, "tokens")
            found, sketches = [], []
            for a, b in zip(begin[:-1], begin[1:]):
                tokens = every[a:b]
                # counts beyond a byte are cut off here and there; 255 then stands for any number
                sketches.append(np.minimum(np.bincount((tokens >> np.uint64(40)).astype(np.int64) % PARTS, minlength=PARTS), 255).astype(np.uint8).tobytes())
                late = order[(tokens & np.uint64(SKETCH - 1)).astype(np.int32)]
                length = len(tokens) - -(-percent * len(tokens) // 100) + 1
                found.append(tokens[np.argsort(late, kind="stable")[:length]].tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k", "c", "n")), binary(found), binary(sketches)], ["doc_id", "k", "c", "n", "prefix", "sketch"])

    key = sets.schema["doc_id"].dataType.simpleString()
    made = sets.select("doc_id", "k", "c", "n", "tokens").mapInArrow(work, f"doc_id {key}, k BIGINT, c BIGINT, n BIGINT, prefix BINARY, sketch BINARY").withColumn("g", F.xxhash64("n", "prefix"))
    written = stage(made, "prefixes")
    shared.destroy()
    return written


def _prefix_tokens(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of batches of ``g, n, prefix``.  A token makes four numbers of it, so a batch leaves in slices."""
    for batch in slices(parts):
        tokens, begin = _opened(batch, "prefix")
        lengths = np.diff(begin)
        g, n = (np.repeat(batch.column(c).to_numpy(), lengths) for c in ("g", "n"))
        place = np.arange(len(tokens)) - np.repeat(begin[:-1], lengths) + 1
        yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(g), pa.array(n), pa.array(place, pa.int64())], ["token", "g", "n", "place"])


def _open_prefixes(rows: DataFrame) -> DataFrame:
    """``token, g, n, place``: one row per prefix token of ``rows`` (``g, n, prefix``), its place counted from 1."""
    return rows.select("g", "n", "prefix").mapInArrow(_prefix_tokens, "token BIGINT, g BIGINT, n BIGINT, place BIGINT")


def _may_link(percent: int) -> Column:
    """Of two rows (n1, place1 and n2, place2) that hold one token: sizes are near enough, and the token comes early enough.

    Sets that link share at least ``overlap`` tokens, so the first of them lies within the first n - overlap + 1 of each.
    """
    overlap = F.ceil(percent * (F.col("n1") + F.col("n2")) / F.lit(100 + percent))
    sizes = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
    return sizes & (F.col("place1") <= F.col("n1") - overlap + 1) & (F.col("place2") <= F.col("n2") - overlap + 1)


def _verify(pairs: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes (``a, b``) whose sets are similar enough.

    Their sketches are compared first: sets travel only where these leave it open.
    """

    def possible(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            x, y = (buffers(batch.column(c))[0].reshape(-1, PARTS) for c in ("x", "y"))
            n1, n2 = (batch.column(c).to_numpy() for c in ("n1", "n2"))
            least = np.minimum(x, y)
            shared = np.where((least == 255).any(axis=1), np.minimum(n1, n2), least.sum(axis=1, dtype=np.int64))
            keep = pa.array((100 * shared >= percent * (n1 + n2 - shared)) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    pairs = pairs.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side, number, sketch in (("a", "n1", "x"), ("b", "n2", "y")):
        pairs = pairs.join(classes.select(F.col("c").alias(side), F.col("n").alias(number), F.col("sketch").alias(sketch)), side)
    pairs = stage(pairs.select("a", "b", "n1", "n2", "x", "y").mapInArrow(possible, "a BIGINT, b BIGINT"), "pairs")
    needed = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    where = stage(classes.join(needed, "c").select("c", "doc_id", "k"), "needed")

    def similar(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            (left, lo), (right, ro) = _opened(batch, "x"), _opened(batch, "y")
            keep = []
            for row in range(batch.num_rows):
                x, y = left[lo[row] : lo[row + 1]], right[ro[row] : ro[row + 1]]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])

    found = attach(sets.select("doc_id", "k", "c", "tokens"), where.drop("c"), ["doc_id", "k"], "left_semi")
    opened = stage(found.select("c", "tokens").dropDuplicates(["c"]), "sets")
    both = pairs.join(opened.select(F.col("c").alias("a"), F.col("tokens").alias("x")), "a").join(opened.select(F.col("c").alias("b"), F.col("tokens").alias("y")), "b")
    links = stage(both.select("a", "b", "x", "y").mapInArrow(similar, "a BIGINT, b BIGINT"), "links")
    discard(pairs, where, opened)
    return links


def similarity_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links; NULL ids do
    not count as smallest.  A text without words (or NULL) has 0 shingles, links
    with nothing and is its own component.  Rows that repeat, or share an id, are
    rows of their own; equal sets always link.  Other columns are not read.
    Tokens are 64-bit hashes of the words.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("k", F.xxhash64("text"))
    with bounded_batches(docs.sparkSession):
        rows, placed = _classes(plain, percent, width)
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = stage(placed.join(smallest, "root").select("c", "component_id"), "component_ids")
    out = attach(rows.select("doc_id", "n", "c"), found, ["c"])
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _classes(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Of ``doc_id, text, k``: ``doc_id, k, n, c`` per row, and ``c, doc_id, root`` per class ``c`` of equal sets.

    ``root`` names the component, ``doc_id`` is the smallest of the class.  Both are written on return.
    """
    sets = stage(_token_sets(docs, width), "shingle_sets")
    some = sets.filter("n > 0")
    # of each class one row stands for all: the smallest id, and the smallest text hash of it
    rows = some.groupBy("c", "doc_id", "k").agg(F.count(F.lit(1)).alias("copies"))
    named = rows.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "k", "copies")).alias("one"))
    named = stage(named.select("c", "one.doc_id", "one.k", "one.copies"), "named")
    key = ["c", "doc_id", "k"]

    def one_each(prefixes: DataFrame) -> DataFrame:
        """The rows that stand for their class; only rows that are repeated are moved to keep one."""
        found = attach(prefixes, named, key, "inner")
        return found.filter("copies = 1").unionByName(found.filter("copies > 1").dropDuplicates(["c"])).drop("copies")

    ranks = _common_buckets(some)
    prefixes = _prefixes(some, ranks, percent)
    for _ in range(REORDERINGS):
        # tokens that many prefixes still hold go to the end as well
        often = _open_prefixes(one_each(prefixes)).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)
        often = often.groupBy(F.col("token").bitwiseAND(F.lit(SKETCH - 1).cast("bigint")).alias("bucket")).agg(F.ceil(F.log2(F.max("n"))).cast("int").alias("rank"))
        late = stage(often, "often")
        found = late.toArrow()
        at = found["bucket"].to_numpy()
        ranks = ranks.copy()
        ranks[at] = np.maximum(ranks[at], found["rank"].to_numpy())
        discard(prefixes, late)
        prefixes = _prefixes(some, ranks, percent)
    classes = stage(one_each(prefixes), "classes")
    discard(prefixes)
    groups = stage(classes.groupBy("g", "n").agg(F.min("c").alias("head"), F.count(F.lit(1)).alias("members"), F.first("prefix").alias("prefix")), "groups")
    classes = classes.drop("prefix")

    # tokens of which the holder next in size may link, in size bands: within one, any two sizes are near enough
    by_size = Window.partitionBy("token").orderBy("n", "g")
    postings = _open_prefixes(groups).withColumns({"_before": F.lag("n").over(by_size), "_after": F.lead("n").over(by_size)})
    near = (100 * F.col("_before") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("_after"))
    band = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent))) if percent < 100 else F.col("n")
    postings = stage(postings.filter(near).select("token", "g", "n", "place", band.alias("band")), "shared_tokens")
    one, two = groups.select(F.col("g").alias("g1"), F.col("head").alias("a")), groups.select(F.col("g").alias("g2"), F.col("head").alias("b"))
    crowded = stage(classes.join(groups.filter("members > 1").select("g"), "g").select("g", "c", "n", F.lit(1).alias("place")), "crowded")

    def labelled(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Root of each class, and of each group whose classes have one root."""
        labels = stage(classes.join(components(links).withColumnRenamed("node", "c"), "c", "left").select("c", "g", F.coalesce("root", "c").alias("root")), "labels")
        state = labels.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return labels, stage(state.select("g", F.when(F.col("low") == F.col("high"), F.col("low")).alias("root")), "states")

    def to_leaders(rows: DataFrame, key: list[str], member: str, first: Column) -> DataFrame:
        """Of ``rows`` (key, member, part, n, place): one member of each part of a key beside the key's leader, which comes first; parts differ."""
        chosen = rows.groupBy(*key, "part").agg(F.min(F.struct(first.alias("first"), F.col(member).alias("member"), "part", "n", "place")).alias("one"))
        leader = chosen.groupBy(*key).agg(F.min("one").alias("leader"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
        met = chosen.join(leader, key).filter("one.part != leader.part")
        met = met.select(*(F.col(f"{row}.{c}").alias(f"{c}{i}") for i, row in ((1, "leader"), (2, "one")) for c in ("member", "n", "place")))
        return met.filter(_may_link(percent)).select("member1", "member2").distinct()

    links, labels, state = None, None, None
    for number in range(ROUNDS):
        if labels is None:
            holders, members = postings.withColumn("part", F.col("g")), crowded.withColumn("part", F.col("c"))
        else:
            holders = postings.join(state, "g").withColumn("part", F.coalesce("root", "g"))
            members = crowded.join(labels.select("c", F.col("root").alias("part")), "c")
        # the first leader is the holder with fewest rarer tokens, that is, nearest to what the others are copies of; later ones change
        across = to_leaders(holders, ["token", "band"], "g", F.col("place") if labels is None else F.xxhash64("g", F.lit(number)))
        across = across.toDF("g1", "g2").join(one, "g1").join(two, "g2").select("a", "b")
        within = to_leaders(members, ["g"], "c", F.xxhash64("c", F.lit(number))).toDF("a", "b")
        more = _verify(across.unionByName(within), sets, classes, percent)
        if labels is not None and more.isEmpty():
            break
        links = more if links is None else stage(links.unionByName(more), "links")
        labels, state = labelled(links)

    # all that share an early token and are still apart
    tokens = postings.drop("band").join(state, "g")
    open_tokens = tokens.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.col("root").isNull()).alias("mixed"))
    open_tokens = open_tokens.filter("mixed OR low != high").select("token")
    open_rows = stage(tokens.join(open_tokens, "token"), "open_tokens")
    x, y = (open_rows.select("token", *(F.col(c).alias(f"{c}{i}") for c in ("g", "n", "place", "root"))) for i in (1, 2))
    apart = (F.col("root1").isNull() | F.col("root2").isNull() | (F.col("root1") != F.col("root2"))) & ((F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("g1") < F.col("g2"))))
    left = x.join(y, "token").filter(apart & _may_link(percent)).select("g1", "g2").distinct()
    mixed = state.filter("root IS NULL").select(F.col("g").alias("g1"), F.col("g").alias("g2"))
    member = [labels.select(F.col("g").alias(f"g{i}"), F.col("c").alias(name), F.col("root").alias(f"r{i}")) for i, name in ((1, "a"), (2, "b"))]
    expanded = left.unionByName(mixed).join(member[0], "g1").join(member[1], "g2").filter("r1 != r2").select("a", "b")
    more = _verify(expanded, sets, classes, percent)
    discard(postings, open_rows)

    roots = components(links.unionByName(more)).withColumnRenamed("node", "c")
    return sets.drop("tokens"), stage(classes.select("c", "doc_id").join(roots, "c", "left").select("c", "doc_id", F.coalesce("root", "c").alias("root")), "placed")


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs`` per similarity class, columns unchanged.

    The row with the smallest id stays (NULL ids come last); of several such
    rows of the class (one id, or repeated rows) the one with the smallest text.
    Rows that share an id, or have none, but are not similar are classes of
    their own.  Texts without words all stay.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("k", F.xxhash64("text"))
    with bounded_batches(docs.sparkSession):
        sets, placed = _classes(plain, percent, width)
    smallest = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id")).alias("one"))
    named = stage(placed.select("c", "root").join(smallest, "root").select("c", "root", F.col("one.doc_id").alias("first")), "named_classes")
    chosen = attach(sets.filter("n > 0").select("doc_id", "k", "c"), named, ["c"], "inner").filter(F.col("doc_id").eqNullSafe(F.col("first")))
    # a row is found again by its id and the hash of its text
    chosen = stage(chosen.groupBy("doc_id", "k", "root").agg(F.count(F.lit(1)).alias("rows")), "chosen")
    ties = stage(chosen.groupBy("root").agg(F.sum("rows").alias("all")).filter(F.col("all") > 1).select("root", F.col("root").alias("tie")), "ties")
    kept = stage(attach(chosen.select("doc_id", "k", "root"), ties, ["root"]).select("doc_id", "k", "tie", F.lit(True).alias("stays")), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("k"))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = attach(rows, kept, ["doc_id", "k"])
    single = marked.filter(wordless | (F.col("stays") & F.col("tie").isNull())).select("row.*")
    tied = marked.filter(~wordless & F.col("tie").isNotNull())
    first = tied.groupBy("tie").agg(F.min_by("row", F.struct("text", F.xxhash64("row"))).alias("row")).select("row.*")
    return single.unionByName(first)
