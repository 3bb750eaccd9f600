"""Quotation linking: who replies to whom, from quoted lines, and conversations without the quotes.

A line's quote level is its number of leading ``>``.  Quoted lines are
normalised and hashed, and each is joined to the latest earlier message of its
conversation that holds the line unquoted.  A message replies to the one that
most of its first-level quoted lines come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.sources.staging import stage

MARKS = r"^[ \t]*(?:>[ \t]?)+"
ATTRIBUTION = r"wrote:\s*$"
# Turns are looked up in ranges of this size, so that a line repeated all over a long conversation is spread.
TURNS = 1000
MOST_ROUNDS = 40


def parsed_lines(text: Column) -> Column:
    """``level`` and ``content`` of each line; NULL and empty texts have none."""
    lines = F.split(F.when(text != "", text), "\n", -1)

    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(F.regexp_count(marks, F.lit(">")).alias("level"), F.substring(line, F.length(marks) + 1, F.length(line)).alias("content"))

    return F.coalesce(F.transform(lines, one), F.array().cast("array<struct<level:int,content:string>>"))


def normal(content: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(content, r"\s+", " ")))


def without_quotes(lines: Column) -> Column:
    """The unquoted lines, less those that announce a quote, trimmed at both ends."""

    def own(line: Column, i: Column) -> Column:
        announces = line["content"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
        return (line["level"] == 0) & ~announces

    joined = F.array_join(F.transform(F.filter(lines, own), lambda line: line["content"]), "\n")
    return F.regexp_replace(joined, r"^\s+|\s+$", "")


def line_sources(lines: DataFrame, turns: int = TURNS) -> DataFrame:
    """``conv_id, turn, level, h, n, source`` per quoted line of a message; ``source`` is a turn or NULL.

    ``lines`` has ``conv_id, turn, level, h`` per line.  Instead of joining every
    quote with every earlier copy, the latest copy is carried along in turn order:
    within ranges of turns first, then from range to range.
    """
    bucket = F.floor(F.col("turn") / turns)
    original = lines.filter("level = 0").select("conv_id", "h", "turn").distinct().withColumns({"level": F.lit(0), "n": F.lit(0).cast("bigint"), "copy": F.col("turn")})
    quoted = lines.filter("level > 0").groupBy("conv_id", "h", "turn", "level").agg(F.count(F.lit(1)).alias("n")).withColumn("copy", F.lit(None).cast("bigint"))
    # originals matter only where the line is quoted
    wanted = quoted.select("conv_id", "h").distinct()
    both = original.join(wanted, ["conv_id", "h"], "left_semi").unionByName(quoted).withColumn("range", bucket)
    both = stage(both, "lines")
    earlier = Window.partitionBy("conv_id", "h", "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("copy").over(earlier)).filter("level > 0")
    ranges = both.groupBy("conv_id", "h", "range").agg(F.max("copy").alias("copy"))
    before = Window.partitionBy("conv_id", "h").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    far = ranges.select("conv_id", "h", "range", F.max("copy").over(before).alias("far"))
    return near.join(far, ["conv_id", "h", "range"]).select("conv_id", "turn", "level", "h", "n", F.coalesce("near", "far").alias("source"))


def _threads(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, thread``: the first message of each reply chain, by doubling pointers."""
    chain = stage(parents.select("conv_id", "turn", F.col("parent").alias("thread")), "threads")
    for _ in range(MOST_ROUNDS):
        up = chain.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        joined = stage(chain.join(up, ["conv_id", "thread"], "left"), "threads")
        if joined.filter("above IS NOT NULL").isEmpty():
            return chain
        chain = joined.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"))
    raise RuntimeError(f"reply chains longer than 2 ** {MOST_ROUNDS}")


def link(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, parent, thread, n_quoted, n_linked`` per row of ``messages``.

    ``text`` has no quotes; ``parent`` is the turn replied to (of equally quoted
    ones the latest) or NULL; ``thread`` is the first turn of the reply chain.
    Ordered by ``thread, turn``, every message follows the one it replies to.
    ``n_quoted`` counts quoted lines with content, ``n_linked`` those whose
    original was found.  NULL text is empty.  Rows without ``conv_id`` or ``turn``
    are kept and linked with nothing; rows that share both are one message for
    linking.  Other columns are not read.
    """
    rows = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", parsed_lines(F.col("text")).alias("lines"))
    each = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode_outer("lines").alias("line"))
    each = each.select("conv_id", "turn", "line.level", normal(F.col("line.content")).alias("content")).filter("content != ''")
    sources = stage(line_sources(each.select("conv_id", "turn", "level", F.md5("content").alias("h"))), "sources")
    votes = sources.filter("level = 1 AND source IS NOT NULL").groupBy("conv_id", "turn", "source").agg(F.sum("n").alias("n"))
    parents = votes.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "source")).alias("best")).select("conv_id", "turn", F.col("best.source").alias("parent"))
    parents = stage(parents, "parents")
    counts = sources.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("source").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"))
    found = counts.join(parents, ["conv_id", "turn"], "left").join(_threads(parents), ["conv_id", "turn"], "left")
    out = rows.select("conv_id", "turn", "role", without_quotes(F.col("lines")).alias("text")).join(stage(found, "found"), ["conv_id", "turn"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select("conv_id", "turn", "role", "text", "parent", F.coalesce("thread", "turn").alias("thread"), F.coalesce("n_quoted", zero).alias("n_quoted"), F.coalesce("n_linked", zero).alias("n_linked"))


def quoting(messages: DataFrame) -> DataFrame:
    """The given messages as mail would show them: each quotes the first two lines of the one two turns before, and that one's quote.

    ``conversations`` holds no quotes; this derives some from all of its rows.
    """
    lines = F.slice(F.split("text", "\n", -1), 1, 2)
    first = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    first = first.select("conv_id", "turn", lines.alias("lines"))
    near = first.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("lines").alias("one"))
    far = first.select("conv_id", (F.col("turn") + 4).alias("turn"), F.col("lines").alias("two"))
    both = messages.join(near, ["conv_id", "turn"], "left").join(far, ["conv_id", "turn"], "left")
    quote = F.concat(
        F.coalesce(F.transform("two", lambda x: F.concat(F.lit(">> "), x)), F.array().cast("array<string>")),
        F.coalesce(F.transform("one", lambda x: F.concat(F.lit("> "), x)), F.array().cast("array<string>")),
        F.array("text"),
    )
    return both.select("conv_id", "turn", "role", F.array_join(quote, "\n").alias("text"))
