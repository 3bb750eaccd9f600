"""Merkle manifest of a table: one root per key, one over all, and a proof per row.

Leaves are hashes of whole rows.  Per key the leaves ascend by id; every
``FAN`` consecutive nodes (the last run may be shorter, even one) are hashed
into their parent until one node remains, the key's subroot.  The subroots,
ordered by key, are folded into the root in the same way.

A level is one table of nodes (key, ``at``, ``h``).  Lag and lead columns at the
fixed offsets 1 to 7 give each node its siblings; those outside its run are
masked by its slot (place in the run) and the run's length.  The rows of slot 0
hash the parents, which are the next level.  A window is one run, so none holds
more than ``FAN`` nodes however many rows a key has.  Each level is an eighth of
the one below; on the way back from the root every node is handed the sibling
hashes from its parent to the root, so the rows join one table.

Odd input: NULL fields count as ``-``; rows without an id come first; rows that
repeat an id are leaves of their own, ordered by their hash (equal rows in any
order, which changes nothing but which of them has which proof); a NULL key is a
key; an empty table has no root and gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.llm.words import ascii_lower
from tsubo.operators.lookup import attach
from tsubo.operators.ranking import numbered
from tsubo.sources.staging import stage

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The loop over levels ends when no key has two nodes left; 8 ** 21 rows do not fit a BIGINT.
MOST_LEVELS = 21


def field_text(value: Column) -> Column:
    """``-`` for NULL, else the value's UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*(field_text(v) for v in values)), 256)


def with_siblings(nodes: DataFrame, group: list[str]) -> DataFrame:
    """``before`` and ``after``: the hashes of a node's siblings in its run, concatenated in order."""
    run = Window.partitionBy(*group, F.floor(F.col("at") / FAN))
    offsets = range(1, FAN)
    lags = {f"_lag{k}": F.lag("h", k).over(run.orderBy("at")) for k in offsets}
    leads = {f"_lead{k}": F.lead("h", k).over(run.orderBy("at")) for k in offsets}
    slot = F.col("at") % FAN
    before = F.concat(*(F.when(slot >= k, F.col(f"_lag{k}")).otherwise("") for k in reversed(offsets)))
    after = F.concat(*(F.when(slot + k < F.col("_length"), F.col(f"_lead{k}")).otherwise("") for k in offsets))
    seen = nodes.withColumns({**lags, **leads, "_length": F.count(F.lit(1)).over(run)})
    return seen.withColumns({"before": before, "after": after}).drop("_length", *lags, *leads)


def _lone() -> Column:
    """The only node of its group; a lone last run of several has a place beyond 0."""
    return (F.col("at") == 0) & (F.col("after") == "")


class Tree(NamedTuple):
    levels: list[DataFrame]  # nodes with siblings, leaves first
    tops: DataFrame  # group, h: the node that remains of each group


def build(leaves: DataFrame, group: list[str]) -> Tree:
    """The trees over ``leaves`` (``*group, at, h`` and columns to keep), one per group; each level is written once."""
    levels, tops, nodes = [], [], leaves
    for _ in range(MOST_LEVELS):
        level = stage(with_siblings(nodes, group), "merkle_level")
        levels.append(level)
        tops.append(level.filter(_lone()).select(*group, "h"))
        if level.filter(F.col("at") == 1).isEmpty():
            break
        first = level.filter((F.col("at") % FAN == 0) & ~_lone())
        nodes = first.select(*group, F.floor(F.col("at") / FAN).alias("at"), F.sha2(F.concat("h", "after"), 256).alias("h"))
    return Tree(levels, reduce(DataFrame.unionByName, tops))


def paths(tree: Tree, group: list[str]) -> DataFrame:
    """The leaves with their ``path`` to the group's top: per level ``before:after;``."""
    upper: DataFrame | None = None
    for level in reversed(tree.levels):
        step = F.when(_lone(), "").otherwise(F.concat("before", F.lit(":"), "after", F.lit(";")))
        rows = level.withColumns({"path": step, "_up": F.floor(F.col("at") / FAN)}).drop("before", "after")
        if upper is not None:
            rest = upper.select(*group, F.col("at").alias("_up"), F.col("path").alias("_rest"))
            rows = attach(rows, rest, [*group, "_up"]).withColumn("path", F.concat("path", F.coalesce("_rest", F.lit("")))).drop("_rest")
        # written once: the level below measures and joins it
        upper = rows.drop("_up") if level is tree.levels[0] else stage(rows.drop("_up"), "merkle_paths")
    return upper


def fold(h: Column, path: Column) -> Column:
    """The root that follows from a leaf's hash and its path."""
    steps = F.filter(F.split(path, ";"), lambda step: step != "")
    return F.aggregate(steps, h, lambda now, step: F.sha2(F.concat(F.substring_index(step, ":", 1), now, F.substring_index(step, ":", -1)), 256))


def manifest(rows: DataFrame, leaf: Column, changed: Column, row_id: str = "doc_id", key: str = "lang") -> DataFrame:
    """Per row of ``rows``: ``row_id, key, leaf, changed, at, subroot, root, path``.

    ``leaf`` is the hash of the row as registered, ``changed`` as it is found now;
    both travel, whole rows are read once.  ``at`` is the leaf's place in its key.
    """
    hashed = rows.select(F.col(row_id).alias("row_id"), F.col(key).alias("key"), leaf.alias("h"), changed.alias("changed"))
    hashed = stage(hashed.withColumn("_tie", F.monotonically_increasing_id()), "merkle_leaves")
    order = [F.col("row_id").asc_nulls_first(), F.col("h"), F.col("_tie")]
    trees = build(numbered(hashed, ["key"], order, "at").drop("_tie"), ["key"])
    tops = stage(trees.tops, "merkle_subroots")
    above = build(numbered(tops, [], [F.col("key").asc_nulls_first()], "at"), [])
    root = above.tops.first()
    ends = stage(paths(above, []).select("key", F.col("h").alias("subroot"), F.col("path").alias("_rest")), "merkle_ends")
    found = attach(paths(trees, ["key"]), ends, ["key"])
    return found.select(
        F.col("row_id").alias(row_id), F.col("key").alias(key), F.col("h").alias("leaf"), "changed", "at", "subroot",
        F.lit(root["h"] if root else None).cast("string").alias("root"), F.concat("path", "_rest").alias("path"),
    )


def tampered(doc_id: Column) -> Column:
    """Rows whose text is changed to try the manifest: those whose id's checksum 3 divides; not those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def document_proofs(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per document, texts changed where ``tampered``."""
    fields = [F.col(c) for c in FIELDS]
    leaf = leaf_hash(*fields)
    text = ascii_lower(F.col("text"))
    changed = F.when(tampered(F.col("doc_id")) & (text != F.col("text")), leaf_hash(*fields[:-1], text))
    found = manifest(docs, leaf, changed).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    proof = F.sha2(F.translate("path", ":;", ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
