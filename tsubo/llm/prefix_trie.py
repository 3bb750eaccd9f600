"""Prefix trie of conversations from sorted common-prefix lengths.

Conversations are sorted by their sequences of turn digests, so that all members
of a prefix are neighbours.  ``lcp`` of a place is the number of leading turns it
shares with the place before.  The members of the first ``d`` turns of a place are
the widest interval around it in which no ``lcp`` but the first is below ``d``:
every candidate (place, depth) finds both ends by itself, by binary search on a
sparse table of range minima.  No stack, no state from place to place.

Places are cut into blocks of ``BLOCK``.  A block's sparse table answers all
candidates whose ends lie inside.  What leaves a block depends on the block and
the depth alone: these few questions are asked once, of the table of block
minima, which is cut into blocks again if it is long.

Counts over subtrees are differences of running totals over the places.

A conversation is one record: the digests of its turns (32 characters each, no
texts) meet in one row.  Digests are 128 bits of SHA-256 of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.llm.words import whole_text, words
from tsubo.operators.lookup import attach
from tsubo.operators.ranking import numbered
from tsubo.sources.staging import stage

BLOCK = 4096
# Conversations are rebuilt on the first turns of the one that opens their family.
FAMILY, MOST_SHARED = 20, 3
DIGEST = 32
LEFT, RIGHT = 0, 1


# Conversations as sequences -------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, words`` per turn; ``place`` counts from 1 by turn (NULL first), ties by digest.

    NULL roles and texts count as empty.  Rows without a conversation id are left out.
    """
    role, text = whole_text(F.col("role")), whole_text(F.col("text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.size(words(text)).alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq`` per conversation: its turns in order, as they are."""
    each = F.array_sort(F.collect_list(F.struct("place", "digest", "words")))
    return turns(conversations).groupBy("conv_id").agg(each.alias("seq"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """``conv_id, seq``: the first h turns of the family's opening conversation, then the own turns after the first h.

    h is the checksum of the id modulo 4.  An absent or shorter opening conversation gives what it has.
    """
    opening = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    heads = seqs.filter(F.pmod("conv_id", F.lit(FAMILY)) == 0).select(F.col("conv_id").alias("_opening"), F.slice("seq", 1, MOST_SHARED).alias("_head"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    joined = seqs.withColumns({"_opening": opening, "_h": shared}).join(heads, "_opening", "left")
    head = F.slice(F.coalesce("_head", F.slice("seq", 1, 0)), F.lit(1), F.col("_h"))
    own = F.slice("seq", F.col("_h") + 1, F.greatest(F.size("seq"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("seq"))


# Searches on common-prefix lengths ------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k: minima of all ranges of 2**k values."""
    levels, step = [values], 1
    while 2 * step <= len(values):
        below = levels[-1]
        levels.append(np.minimum(below[:-step], below[step:]))
        step *= 2
    return levels


def first_below(levels: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Per question the first index from ``start`` on whose value is below ``d``, or the number of values."""
    at = start.copy()
    for k in reversed(range(len(levels))):
        fits = at < len(levels[k])
        fits[fits] = levels[k][at[fits]] >= d[fits]
        at[fits] += 1 << k
    return at


def last_below(levels: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Per question the last index up to ``start`` whose value is below ``d``, or -1."""
    at = start.copy()
    for k in reversed(range(len(levels))):
        first = at - (1 << k) + 1
        fits = first >= 0
        fits[fits] = levels[k][first[fits]] >= d[fits]
        at[fits] -= 1 << k
    return at


def _each(counts: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, each ``counts`` times, and beside them first, first + 1, ..."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + first


def _exits(values: np.ndarray, at: np.ndarray, left: int, right: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where searches that come into a block stop: ``side, d, at``.

    Rightward ones come in at depths up to ``left``, the block's own left edge; leftward ones up to ``right``.
    """
    levels, out = sparse_table(values), []
    for side, most in ((RIGHT, left), (LEFT, right)):
        d = np.arange(1, most + 1)
        found = first_below(levels, np.zeros(len(d), np.int64), d) if side == RIGHT else last_below(levels, np.full(len(d), len(values) - 1), d)
        inside = (found >= 0) & (found < len(values))
        out.append((np.full(int(inside.sum()), side), d[inside], at[found[inside]]))
    return out


_SUMMARY = "kind INT, block BIGINT, side INT, d BIGINT, at BIGINT, low BIGINT, ql BIGINT, qr BIGINT"


def _record(kind: int, block: int, side=None, d=None, at=None, low=None, ql=None, qr=None) -> pa.RecordBatch:
    n = 1 if side is None else len(side)
    columns = [np.full(n, kind, np.int32), np.full(n, block, np.int64), side, d, at, low, ql, qr]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
    names = [field.split()[0] for field in _SUMMARY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else pa.array(np.asarray(c).reshape(n), t) for c, t in zip(columns, kinds)], names)


def _summaries(rows: DataFrame, size: int) -> DataFrame:
    """Of ``at, low, ql, qr``, per block of ``size``: one row of kind 0 (its ``low, ql, qr``), its exits (kind 1), and its rows' answers (kind 2).

    ``ql`` and ``qr`` are the depths up to which searches leave a row to the left and to the right.  An answer names the nearest row
    of the block with ``low`` below d, NULL if there is none.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, low, ql, qr = (table.column(c).to_numpy() for c in ("at", "low", "ql", "qr"))
        block = int(at[0]) // size
        out = [_record(0, block, low=[low.min()], ql=[ql[0]], qr=[qr[-1]])]
        out += [_record(1, block, *found) for found in _exits(low, at, int(ql[0]), int(qr[-1]))]
        # the value of the right edge belongs to the first row of the next block
        levels, reach = sparse_table(np.append(low, qr[-1])), np.append(at, at[-1] + 1)
        for side, most in ((LEFT, ql), (RIGHT, qr)):
            row, d = _each(most, 1)
            found = last_below(levels, row - 1, d) if side == LEFT else first_below(levels, row + 1, d)
            inside = (found >= 0) & (found < len(reach))
            answer = pa.array(reach[np.where(inside, found, 0)], pa.int64(), mask=~inside)
            batch = _record(2, block, np.full(len(row), side), d, np.zeros(len(row)), low=at[row])
            out.append(batch.set_column(4, "at", answer))
        return pa.Table.from_batches(out)

    return rows.groupBy(F.floor(F.col("at") / size).alias("block")).applyInArrow(work, _SUMMARY)


def nearest_lower(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """``at, side, d, found``: the nearest row on that side with ``low`` below d, for d up to ``ql`` or ``qr``.

    To the right of the last row counts as below.  ``rows`` is ``at, low, ql, qr``.  Recurs on one row per block until one block is left.
    """
    made = stage(_summaries(rows, size), "trie_blocks")
    answers = made.filter("kind = 2").select(F.col("low").alias("at"), "block", "side", "d", F.col("at").alias("found"))
    above = made.filter("kind = 0").select(F.col("block").alias("at"), "low", "ql", "qr")
    if above.filter(F.col("at") > 0).isEmpty():
        return answers.drop("block")
    return _through(answers, outward(above, made.filter("kind = 1"), size)).drop("block")


def outward(above: DataFrame, exits: DataFrame, size: int) -> DataFrame:
    """``block, side, d, stop``: where a search that leaves a block stops; no row where it does not.

    A block has no exit to the right at d if its very first value is below d; the search then stops there.
    """
    found = nearest_lower(above, size).filter("found IS NOT NULL").select(F.col("at").alias("_from"), "side", "d", F.col("found").alias("block"))
    stops = found.join(exits.select("block", "side", "d", "at"), ["block", "side", "d"], "left")
    return stage(stops.select(F.col("_from").alias("block"), "side", "d", F.coalesce("at", F.col("block") * size).alias("stop")), "trie_stops")


def _through(answers: DataFrame, stops: DataFrame) -> DataFrame:
    return attach(answers, stops, ["block", "side", "d"]).withColumn("found", F.coalesce("found", "stop")).drop("stop")


# Members, nodes, subtrees ---------------------------------------------------


def prefix_lengths(seqs: DataFrame, size: int = BLOCK) -> DataFrame:
    """``at, conv_id, length, words, lcp, next``: conversations in order, what each shares with the one before and after (-1: none)."""
    rows = seqs.select("conv_id", F.array_join(F.transform("seq", lambda t: t["digest"]), "").alias("path"), F.transform("seq", lambda t: t["words"]).alias("words"))
    placed = numbered(stage(rows, "trie_paths"), [], [F.col("path"), F.col("conv_id")], "at").withColumns({"block": F.floor(F.col("at") / size), "own": F.lit(True)})
    # the neighbours beyond a block's edges come along
    edges = [placed.filter(F.pmod("at", F.lit(size)) == (size - 1 if step > 0 else 0)).withColumns({"block": F.col("block") + step, "own": F.lit(False), "words": F.array().cast("array<int>")}) for step in (1, -1)]

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        own = table.column("own").to_numpy()
        paths = [np.frombuffer(p.encode(), f"S{DIGEST}") for p in table.column("path").to_pylist()]
        shared = np.full(len(paths) + 1, -1, np.int64)
        for i in range(1, len(paths)):
            n = min(len(paths[i - 1]), len(paths[i]))
            differ = np.flatnonzero(paths[i - 1][:n] != paths[i][:n])
            shared[i] = differ[0] if len(differ) else n
        length = np.array([len(p) for p in paths], np.int64)
        kept = table.select(["at", "conv_id", "words"]).filter(pa.array(own))
        for name, values in (("length", length[own]), ("lcp", shared[:-1][own]), ("next", shared[1:][own])):
            kept = kept.append_column(name, pa.array(values))
        return kept

    every = placed.unionByName(edges[0]).unionByName(edges[1])
    return every.groupBy("block").applyInArrow(work, "at BIGINT, conv_id BIGINT, words ARRAY<INT>, length BIGINT, lcp BIGINT, next BIGINT")


_CANDIDATE = "at BIGINT, d BIGINT, left BIGINT, right BIGINT, up BIGINT, conv_id BIGINT, words BIGINT, ends BOOLEAN, block BIGINT"


def _candidates(places: DataFrame, size: int) -> DataFrame:
    """Every prefix of every conversation with the ends of its members' interval; NULL where they lie outside the block.

    ``up`` is the left end one turn shorter.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("at").combine_chunks()
        at, conv_id, length, lcp, after = (table.column(c).to_numpy() for c in ("at", "conv_id", "length", "lcp", "next"))
        words = table.column("words").combine_chunks()
        flat, begin = words.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(length))
        levels = sparse_table(np.append(lcp, after[-1]))
        row, d = _each(length + 1, 0)
        right, left = first_below(levels, row + 1, d), last_below(levels, row, d)
        low, open_left, open_right = int(at[0]), (left < 0) & (d > 0), (right > len(at)) & (d > 0)
        left = np.where(d == 0, 0, low + left)
        shorter = np.append(0, left[:-1])  # the candidate before is the same conversation's, one turn shorter
        open_up = np.append(False, open_left[:-1]) | (d == 0)
        word = np.append(flat, 0)[np.where(d > 0, begin[row] + d - 1, len(flat))]
        masked = ((left, open_left), (low + right - 1, open_right | (d == 0)), (shorter, open_up))
        arrays = [pa.array(at[row]), pa.array(d), *(pa.array(v, pa.int64(), mask=m) for v, m in masked)]
        arrays += [pa.array(conv_id[row]), pa.array(word.astype(np.int64)), pa.array(d == length[row]), pa.array(np.full(len(row), low // size, np.int64))]
        return pa.Table.from_arrays(arrays, [c.split()[0] for c in _CANDIDATE.split(", ")])

    return places.groupBy(F.floor(F.col("at") / size).alias("block")).applyInArrow(work, _CANDIDATE)


def member_intervals(places: DataFrame, size: int = BLOCK) -> DataFrame:
    """``at, d, left, right, up, conv_id, words, ends`` per candidate, all ends found.  ``places`` is a written table."""
    last = places.count() - 1
    found = stage(_candidates(places, size), "trie_candidates")
    edges = stage(_edges(places, size), "trie_edges")
    above = edges.filter("kind = 0").select(F.col("block").alias("at"), "low", "ql", "qr")
    stops = outward(above, edges.filter("kind = 1"), size)
    ends = stops.groupBy("block", "d").agg(F.max(F.when(F.col("side") == LEFT, F.col("stop"))).alias("_l"), F.max(F.when(F.col("side") == RIGHT, F.col("stop") - 1)).alias("_r"))
    ends = stage(ends, "trie_ends")
    whole = attach(found, ends, ["block", "d"])
    whole = attach(whole.withColumn("_d", F.col("d") - 1), ends.select("block", F.col("d").alias("_d"), F.col("_l").alias("_u")), ["block", "_d"])
    return whole.select(
        "at", "d", F.coalesce("left", "_l").alias("left"), F.least(F.coalesce("right", F.when(F.col("d") > 0, F.col("_r"))), F.lit(last)).alias("right"),
        F.when(F.col("d") == 1, 0).otherwise(F.coalesce("up", "_u")).alias("up"), "conv_id", "words", "ends",
    )


def _edges(places: DataFrame, size: int) -> DataFrame:
    """Summary row and exits of every block of places."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, lcp, after = (table.column(c).to_numpy() for c in ("at", "lcp", "next"))
        block, ql, qr = int(at[0]) // size, max(int(lcp[0]), 0), max(int(after[-1]), 0)
        out = [_record(0, block, low=[lcp.min()], ql=[ql], qr=[qr])]
        return pa.Table.from_batches(out + [_record(1, block, *found) for found in _exits(lcp, at, ql, qr)])

    return places.select("at", "lcp", "next").groupBy(F.floor(F.col("at") / size).alias("block")).applyInArrow(work, _SUMMARY)


def running_totals(rows: DataFrame, columns: list[str], size: int = BLOCK) -> DataFrame:
    """Sums of ``columns`` over all rows up to each (``at``, unique), by blocks and recursively over the blocks' sums."""
    block = F.floor(F.col("at") / size)
    inside = rows.withColumn("block", block)
    upto = Window.partitionBy("block").orderBy("at")
    sums = stage(inside.groupBy("block").agg(*(F.sum(c).alias(c) for c in columns)), "trie_sums")
    inside = inside.withColumns({c: F.sum(c).over(upto) for c in columns})
    if sums.filter(F.col("block") > 0).isEmpty():
        return inside.drop("block")
    before = running_totals(sums.withColumnRenamed("block", "at"), columns, size)
    before = before.select((F.col("at") + 1).alias("block"), *(F.col(c).alias(f"_{c}") for c in columns))
    return attach(inside, stage(before, "trie_totals"), ["block"]).select("at", *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns))


def id_digests(members: DataFrame) -> DataFrame:
    """``left, d, ends_sha256``: SHA-256 of the ids of each (left, d), decimal, ascending, comma-joined.

    Ids are fed to the hash as they come, sorted; no list of them is held.  A hash is sequential by nature, so the
    ids (not the texts) of conversations that are all equal pass one task, however many there are.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in parts:
            left, d, ids = (batch.column(c).to_numpy() for c in ("left", "d", "conv_id"))
            if not len(left):
                continue
            begin = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (d[1:] != d[:-1])))
            done = []
            for a, b in zip(begin, np.append(begin[1:], len(left))):
                text = ",".join(map(str, ids[a:b].tolist())).encode()
                if key == (left[a], d[a]):
                    state.update(b"," + text)
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (left[a], d[a]), hashlib.sha256(text)
            yield _digest_batch(done)
        if key is not None:
            yield _digest_batch([(*key, state.hexdigest())])

    ordered = members.select("left", "d", "conv_id").repartition("left", "d").sortWithinPartitions("left", "d", "conv_id")
    return ordered.mapInArrow(work, "left BIGINT, d BIGINT, ends_sha256 STRING")


def _digest_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array([*map(int, columns[0])], pa.int64()), pa.array([*map(int, columns[1])], pa.int64()), pa.array(columns[2], pa.string())], ["left", "d", "ends_sha256"])


def trie(seqs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Nodes of the trie of ``conv_id, seq`` (one row per conversation; ``seq`` of structs with ``digest`` and ``words``).

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``
    and ``left, right``, the members' places in the order of ``prefix_lengths``.  The root has depth 0 and no parent.
    A conversation without turns is a member of the root alone.  No conversations, no nodes.
    """
    places = stage(prefix_lengths(seqs, size), "trie_places")
    members = stage(member_intervals(places, size), "trie_members")
    own = F.col("at") == F.col("left")
    nodes = members.groupBy("left", "d").agg(
        F.max("right").alias("right"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max(F.when(own, F.col("up"))).alias("up"),
    )
    nodes = stage(nodes.withColumns({"n_convs": F.col("right") - F.col("left") + 1, "above": F.col("d") - 1}), "trie_nodes")
    children = nodes.filter("d > 0").groupBy(F.col("up").alias("left"), F.col("above").alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["left", "d"], "left").na.fill(0, ["n_children"])
    saving = (F.col("n_convs") - 1) * F.col("words")
    deeper = Window.partitionBy("left").orderBy(F.desc("d"))
    nodes = stage(nodes.withColumns({"saved": saving, "saved_here": F.sum(saving).over(deeper), "leaf": (F.col("n_children") == 0).cast("bigint")}), "trie_nodes")

    started = nodes.groupBy(F.col("left").alias("at")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    totals = places.select("at").join(started, "at", "left").na.fill(0, ["saved", "leaf"])
    totals = stage(running_totals(stage(totals, "trie_starts"), ["saved", "leaf"], size), "trie_totals")
    at_left = totals.select(F.col("at").alias("left"), F.col("saved").alias("saved_l"), F.col("leaf").alias("leaf_l"))
    at_right = totals.select(F.col("at").alias("right"), F.col("saved").alias("saved_r"), F.col("leaf").alias("leaf_r"))
    leaf_here = F.max("leaf").over(Window.partitionBy("left"))
    counted = nodes.withColumn("leaf_here", leaf_here).join(at_left, "left").join(at_right, "right")
    counted = counted.withColumns({
        "n_leaves": F.col("leaf_r") - F.col("leaf_l") + F.col("leaf_here"),
        "saved_tokens": F.col("saved_r") - F.col("saved_l") + F.col("saved_here"),
    })
    parents = nodes.select(F.col("left").alias("up"), F.col("d").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    named = attach(stage(counted.drop("words", "saved", "leaf"), "trie_counted"), parents, ["up", "above"])
    named = named.join(id_digests(members.filter("ends")), ["left", "d"], "left")
    digest = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return named.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"), "left", "right")


def shared_prefixes(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (``conv_id, turn, role, text``; other columns are not read)."""
    seqs = stage(sequences(conversations), "trie_sequences")
    return trie(rebuilt(seqs), size)
