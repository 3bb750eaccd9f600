"""Remove byte ranges that stand elsewhere in the corpus.

Every 200-byte string has an anchor: the smallest hash among its 32-byte
strings.  Equal strings have equal anchors, so only the runs of windows that
share a repeated anchor (``segments``) can hold repeats, and strings need only be
compared within an anchor.

Segments of many anchors are laid end to end, and on the Burrows-Wheeler
transform of such a block common prefixes are found by increasing length:
intervals of the suffix array are extended backward, breadth first, each new
interval fixing the common prefix at its right border.  Intervals start at the
28 bytes that the sort compares anyway and end at 200: borders not fixed by
then join suffixes that share 200 bytes or more.  An interval of a string that
runs into a segment's end stops there.

An anchor with very many different segments would fill one block; its windows
are counted by digest instead, which spreads and pre-aggregates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsubo.llm.byte_hash import Hasher, buffers, chunks
from tsubo.operators.lookup import attach
from tsubo.sources.staging import discard, stage

LENGTH = 200
GRAM = 32
# Long texts are cut into pieces of this many window starts; shorter ones share a chunk.
PIECE = 1 << 20
# Segments of one block of the transform.
BLOCK_BYTES = 1 << 20
# Anchors with more different segments than this are counted by window.
CROWDED = 4096

ANCHOR_FIELDS = ("k1", "k2", "start", "length", "gram", "seg")


def _anchor_runs(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, anchor position.

    ``offsets`` bound the texts in ``data``; windows do not cross them.
    """
    grams = hasher.windows(gram)
    width = length - gram + 1
    starts = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if starts <= 0:
        return none, none, none
    # low bits hold the position: ties go to the leftmost
    mask = np.uint64((1 << 22) - 1)
    keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(right[:starts], left[width - 1 : width - 1 + starts]) & mask).astype(np.int64)
    room = np.zeros(starts + 1, bool)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= length:
            room[a : b - length + 1] = True
    room = room[:starts]
    new = room.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~room[:-1]
    begins = offsets[:-1][offsets[:-1] < starts]
    new[begins[room[begins]]] = True
    last = room.copy()
    last[:-1] &= new[1:] | ~room[1:]
    first = np.flatnonzero(new)
    return first, np.flatnonzero(last), anchor[first]


def _text_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    hasher = Hasher(data)
    first, last, anchor = _anchor_runs(hasher, data, offsets, length, gram)
    return first, last + length - first, hasher.ranges(anchor, anchor + gram), hasher.ranges(first, last + length)


def _pieces(size: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of a long text whose windows together are all of its windows, each once."""
    for start in range(0, max(size - length + 1, 1), PIECE):
        yield start, min(size, start + PIECE + length - 1)


def _anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``k1, k2, start, length, gram, seg`` per run of windows with one anchor.

    A run at the seam of two pieces is given in two parts; parts are runs too.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            data, offsets = buffers(batch.column("bytes"))
            for row, end in chunks(offsets, PIECE):
                base = offsets[row]
                inner = offsets[row : end + 1] - base
                spans = [(0, int(inner[-1]))] if end - row > 1 else list(_pieces(int(inner[-1]), length))
                for a, b in spans:
                    borders = inner if end - row > 1 else np.array([0, b - a])
                    first, size, grams, segs = _text_anchors(data[base + a : base + b], borders, length, gram)
                    of = np.searchsorted(borders, first, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1[row + of]), pa.array(k2[row + of]), pa.array(first - borders[of] + a), pa.array(size), pa.array(grams.view(np.int64)), pa.array(segs.view(np.int64))],
                        list(ANCHOR_FIELDS),
                    )

    return rows.mapInArrow(work, "k1 BIGINT, k2 INT, start BIGINT, length BIGINT, gram BIGINT, seg BIGINT")


Q = 7  # symbols of nine bits in one 64-bit word


def repeated_starts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Positions that start ``length`` bytes found at another position too, none crossing ``offsets``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none
    ends = np.repeat(offsets[1:], np.diff(offsets))
    room = ends - np.arange(n)  # symbols left in the segment
    symbols = np.zeros(n + Q, np.uint64)
    symbols[:n] = data.astype(np.uint64) + np.uint64(1)
    packed = np.zeros(n, np.uint64)
    for k in range(Q):
        packed = (packed << np.uint64(9)) | np.where(room > k, symbols[k : n + k], np.uint64(0))
    bits = np.uint64(int(n).bit_length())
    index = np.arange(n, dtype=np.uint64)

    def ranked(keys: np.ndarray, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes by key, and ranks from 1 on."""
        if key_bits + int(bits) <= 64:  # key and position sort as one number
            joined = np.sort((keys << bits) | index)
            at, keys = (joined & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), joined >> bits
        else:
            at = np.argsort(keys)
            keys = keys[at]
        new = np.ones(n, np.int64)
        new[1:] = keys[1:] != keys[:-1]
        out = np.zeros(n + 1, np.uint64)
        out[at] = np.cumsum(new).astype(np.uint64)
        return at, out

    depth = 4
    order, ranks = ranked(packed >> np.uint64(9 * (Q - depth)), 9 * depth)
    while depth < length and int(ranks[order[-1]]) < n:
        after = np.zeros(n, np.uint64)
        after[:-depth] = np.where(room[:-depth] > depth, ranks[depth:n], np.uint64(0))
        order, ranks = ranked((ranks[:n] << bits) | after, 2 * int(bits))
        depth *= 2
    if depth < length:
        return none  # all suffixes differ before the length

    # common prefixes below 4 * Q, from the packed words
    base = 4 * Q
    common = np.full(n, base, np.int64)
    common[0] = 0
    level = np.zeros(n - 1, bool)
    for word in range(4):
        here = np.where(room > word * Q, packed[np.minimum(np.arange(n) + word * Q, n - 1)], np.uint64(0))[order]
        differs = here[1:] ^ here[:-1]
        fresh = (differs != 0) & ~level
        if fresh.any():
            top = np.floor(np.log2(differs[fresh].astype(np.float64))).astype(np.int64)
            top -= (np.uint64(1) << top.astype(np.uint64)) > differs[fresh]  # rounding of large values
            common[1:][fresh] = word * Q + (Q * 9 - 1 - top) // 9
            level |= fresh

    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    begin = np.zeros(n, bool)
    begin[offsets[:-1][offsets[:-1] < n]] = True
    extend = ~begin[order]  # has a symbol before it in its segment
    lf = np.where(extend, inverse[np.maximum(order - 1, 0)], -1)
    before = np.where(extend, data[np.maximum(order - 1, 0)], 0).astype(np.int64)

    # fixed[j]: the common prefix of suffixes j - 1 and j is known to be shorter than the length
    fixed = np.zeros(n + 1, bool)
    fixed[0] = fixed[n] = True
    fixed[:n][common < base] = True
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    border[:n][common < base] = True
    edges = np.flatnonzero(border)
    wanted = np.append(common, -1)[edges[1:]] == base - 1
    low, high = edges[:-1][wanted], edges[1:][wanted]
    owner = np.zeros(n + 1, np.int64)
    for _ in range(base, length):
        if not len(low):
            break
        sizes = high - low
        member = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        tag = np.repeat(np.arange(len(low)), sizes) * 257 + before[member]
        to = lf[member]
        ok = to >= 0
        to, tag = to[ok], tag[ok]
        if not len(to):
            break
        owner[to] = tag
        to = np.sort(to)
        cut = np.ones(len(to) + 1, bool)
        cut[1:-1] = (np.diff(to) != 1) | (np.diff(owner[to]) != 0)
        at = np.flatnonzero(cut)
        low, high = to[at[:-1]], to[at[1:] - 1] + 1
        fresh = ~fixed[high]
        low, high = low[fresh], high[fresh]
        fixed[high] = True
    alike = np.flatnonzero(~fixed[:n])
    found = np.zeros(n, bool)
    found[order[alike]] = found[order[alike - 1]] = True
    return np.flatnonzero(found & (room >= length))


def _runs(starts: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, first byte and end of each run of consecutive starts."""
    of = np.searchsorted(offsets, starts, side="right") - 1
    cut = np.ones(len(starts) + 1, bool)
    cut[1:-1] = (np.diff(starts) != 1) | (np.diff(of) != 0)
    at = np.flatnonzero(cut)
    first, last = starts[at[:-1]], starts[at[1:] - 1]
    of = of[at[:-1]]
    return of, first - offsets[of], last + length - offsets[of]


def _blocks(segments: DataFrame, length: int) -> DataFrame:
    """``gram, seg, from, to``: repeated byte ranges of segments that arrive anchor by anchor."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[np.ndarray] = []
        segs: list[np.ndarray] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            of, a, b = _runs(repeated_starts(data, offsets, length), offsets, length)
            return pa.RecordBatch.from_arrays([pa.array(np.array(grams, np.int64)[of]), pa.array(np.array(segs, np.int64)[of]), pa.array(a), pa.array(b)], ["gram", "seg", "from", "to"])

        for batch in parts:
            for gram, seg, text in zip(batch.column("gram").to_pylist(), batch.column("seg").to_pylist(), batch.column("bytes").to_pylist()):
                # a block ends between anchors, never within one
                if held >= BLOCK_BYTES and gram != grams[-1]:
                    yield flush()
                    grams, segs, texts, held = [], [], [], 0
                grams.append(gram)
                segs.append(seg)
                texts.append(text)
                held += len(text)
        if texts:
            yield flush()

    return segments.mapInArrow(work, "gram BIGINT, seg BIGINT, `from` BIGINT, `to` BIGINT")


def _by_window(segments: DataFrame, length: int) -> DataFrame:
    """The same ranges for segments of crowded anchors: windows counted by digest and offset."""
    windows = segments.select("gram", "seg", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.octet_length("bytes") - length)).alias("from"))
    windows = windows.select("gram", "seg", "from", F.md5(F.substring("bytes", F.col("from").cast("int") + 1, F.lit(length))).alias("digest"))
    twice = windows.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram", "digest")
    return windows.join(twice, ["gram", "digest"]).select("gram", "seg", "from", (F.col("from") + length).alias("to"))


def _finish(rows: DataFrame, kind: str) -> DataFrame:
    """Remove the ranges of each row and describe what is left."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            sizes, removed, spans, digests = [], [], [], []
            for text, ranges in zip(batch.column("bytes"), batch.column("ranges")):
                text = text.as_py()
                runs: list[list[int]] = []
                for a, b in sorted((r["from"], r["to"]) for r in ranges.as_py() or []):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in runs:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in runs))
                spans.append([{"from": a, "to": b} for a, b in runs])
                digests.append(digest.hexdigest())
            span_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span_type), pa.array(digests, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )

    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes BIGINT, n_removed BIGINT, spans ARRAY<STRUCT<`from`: BIGINT, `to`: BIGINT>>, kept_sha256 STRING")


def repeated_ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256`` per row of ``docs``.

    ``spans`` are the maximal byte ranges covered by strings of ``length`` bytes
    that start anywhere else in ``docs`` too, the same text included.  NULL is
    an empty text; texts shorter than ``length`` lose nothing.  Repeated rows
    are repeats of each other.  Other columns are not read.  Results are exact:
    texts and segments are told apart by 96 and 128 bits of hash, their bytes
    are compared.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("bytes"))
    keyed = texts.withColumns({"k1": F.xxhash64("bytes"), "k2": F.hash("bytes")})

    anchors = stage(_anchors(keyed.select("k1", "k2", "bytes"), length, gram), "anchors")
    grams = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("one"), F.max("seg").alias("two")).filter("n > 1")
    # written first, so that the join deals both sides itself and can split a hot anchor
    grams = stage(grams.select("gram", (F.col("one") == F.col("two")).alias("alike")), "repeated_grams")
    repeated = stage(anchors.join(grams, "gram"), "repeated_anchors")
    discard(anchors, grams)

    segs = repeated.filter("NOT alike").groupBy("gram", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "start", "length")).alias("at"))
    segs = stage(segs.select("gram", "seg", "n", "at.*"), "segments")
    many = segs.groupBy("gram").count().filter(F.col("count") > crowded).select("gram", F.lit(True).alias("many"))
    many = stage(many, "crowded")
    marked = attach(segs, many, ["gram"])
    cuts = marked.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length", "gram", "seg", "many")).alias("cuts"))
    # one text of each kind; copies meet before the shuffle
    kinds = keyed.groupBy("k1", "k2").agg(F.first("bytes").alias("bytes"))
    opened = kinds.join(cuts, ["k1", "k2"]).select("bytes", F.explode("cuts").alias("c"))
    opened = opened.select("c.gram", "c.seg", "c.many", F.substring("bytes", F.col("c.start").cast("int") + 1, F.col("c.length").cast("int")).alias("bytes"))

    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = opened.filter("many IS NULL").repartition(partitions, "gram").sortWithinPartitions("gram", "seg").select("gram", "seg", "bytes")
    ranges = _blocks(blocks, length)
    if not many.isEmpty():
        ranges = ranges.unionByName(_by_window(opened.filter("many"), length))
    whole = segs.filter("n > 1").select("gram", "seg", F.lit(0).cast("bigint").alias("from"), F.col("length").alias("to"))
    ranges = stage(ranges.unionByName(whole).groupBy("gram", "seg").agg(F.collect_set(F.struct("from", "to")).alias("ranges")), "ranges")
    discard(segs)

    spread = repeated.filter("NOT alike").join(ranges, ["gram", "seg"]).select("k1", "k2", "start", F.explode("ranges").alias("r"))
    spread = spread.select("k1", "k2", (F.col("start") + F.col("r.from")).alias("from"), (F.col("start") + F.col("r.to")).alias("to"))
    alike = repeated.filter("alike").select("k1", "k2", F.col("start").alias("from"), (F.col("start") + F.col("length")).alias("to"))
    per_text = stage(spread.unionByName(alike).groupBy("k1", "k2").agg(F.collect_set(F.struct("from", "to")).alias("ranges")), "text_ranges")
    discard(repeated, ranges)
    rows = keyed.join(per_text, ["k1", "k2"], "left").select("doc_id", "bytes", "ranges")
    return _finish(rows, docs.schema[doc_id].dataType.simpleString())
