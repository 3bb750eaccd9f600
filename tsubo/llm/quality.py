"""Quality rules as a ledger of bits.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per failed rule; what a policy keeps, and what leaving out a rule
would change, are then bit operations on that column, without the text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.llm.words import whole_text, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Bit number -> (name, failing condition).  Bits are never given to another rule.
RULES: dict[int, tuple[str, str]] = {
    0: ("too_few_words", "n_words < 50"),
    1: ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    2: ("symbols", "10 * n_symbols > 3 * n_words"),
    3: ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    4: ("short_words", "word_chars < 2 * n_words"),
    5: ("long_words", "word_chars > 20 * n_words"),
}
# Version -> bits that reject a document.
POLICIES: dict[int, int] = {1: 0b000011, 2: 0b111111}
BASE, CURRENT = 1, 2

SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"


def _covered(tokens: Column, order: Column, mask: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    ``order`` holds one number per window, sorted: hash in the high bits, start
    in the bits of ``mask``.  Neighbours with one hash are compared word by word.
    """

    def same(one: Column, two: Column) -> Column:
        a, b = one.bitwiseAND(mask).cast("int"), two.bitwiseAND(mask).cast("int")
        return (one.bitwiseXOR(two) <= mask) & (one.bitwiseXOR(two) >= 0) & (
            (F.get(tokens, a) == F.get(tokens, b)) & (F.get(tokens, a + 1) == F.get(tokens, b + 1)) & (F.get(tokens, a + 2) == F.get(tokens, b + 2))
        )

    no = F.lit(False)
    twice = F.filter(order, lambda x, i: F.coalesce(same(x, F.get(order, i - 1)), no) | F.coalesce(same(x, F.get(order, i + 1)), no))
    starts = F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))
    step = F.aggregate(
        starts,
        F.struct(F.lit(-3).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(3).cast("bigint"), at - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(order) > 1, step).otherwise(F.lit(0).cast("bigint"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) and the measurements of its whole text.

    A NULL or empty text, or one of blanks alone, measures 0 everywhere.  The
    input row is kept as one struct, so its columns may have any names.  One
    narrow pass, no shuffle; each window of three words is one BIGINT.
    """
    whole = whole_text(F.col(text))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(HAS_WORD))
    parts = docs.select(F.struct("*").alias("row"), words(F.col(text)).alias("tokens"), lines.alias("lines"), F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"))
    parts = parts.withColumn("mask", F.expr("shiftleft(1L, length(bin(size(tokens)))) - 1"))
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("tokens") - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get("tokens", i), F.get("tokens", i + 1), F.get("tokens", i + 2)).bitwiseAND(F.bitwise_not(F.col("mask"))).bitwiseOR(i.cast("bigint")),
    )
    parts = parts.withColumn("windows", windows).withColumn("order", F.sort_array("windows")).drop("windows")
    numbers = F.struct(
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("tokens"), F.col("order"), F.col("mask")).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )
    # opening an array of one keeps a later filter from being moved below, where the
    # word array would be computed again for every element
    return parts.select("row", F.explode_outer(F.array(numbers)).alias("m")).select("row", "m.*")


def ledger(docs: DataFrame, text: str = "text", rules: Mapping[int, tuple[str, str]] = RULES) -> DataFrame:
    """``row``, the measurements and ``failed``: bit b is set where rule b fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, condition) in rules.items()]
    failed = sum(bits[1:], bits[0]).cast("bigint") if bits else F.lit(0).cast("bigint")
    return measure(docs, text).withColumn("failed", failed)


def passes(mask: int) -> Column:
    """Whether a ledger row fails none of the rules in ``mask``."""
    return F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")) == 0


def keep(docs: DataFrame, text: str = "text", version: int = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy version keeps, columns unchanged."""
    return ledger(docs, text).filter(passes(POLICIES[version])).select("row.*")


def apply_policies(entries: DataFrame, policies: Mapping[int, int] = POLICIES) -> DataFrame:
    """Per policy version: documents kept and rejected, from ledger rows alone."""
    one = entries.groupBy("failed").count()
    sums = [F.coalesce(F.sum(F.when(passes(mask), F.col("count"))), F.lit(0)).alias(f"kept_{v}") for v, mask in policies.items()]
    total = one.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), *sums)
    return total.select(F.explode(F.array(*(F.struct(F.lit(v).alias("version"), F.lit(mask).cast("bigint").alias("mask"), F.col(f"kept_{v}").alias("kept"), (F.col("n") - F.col(f"kept_{v}")).alias("rejected")) for v, mask in policies.items()))).alias("p")).select("p.*")


def ablation(entries: DataFrame, version: int = CURRENT, rules: Mapping[int, tuple[str, str]] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and that fail nothing else of the policy.

    The second number is what the policy would regain without the rule.  At
    most one row for each combination of failed rules is shuffled.
    """
    mask = POLICIES[version]
    counts = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")).alias("failed")).count()
    each = [
        F.struct(
            F.lit(bit).alias("bit"),
            F.lit(name).alias("rule"),
            F.when(F.col("failed").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0, F.col("count")).otherwise(F.lit(0)).alias("fails"),
            F.when(F.col("failed") == (1 << bit), F.col("count")).otherwise(F.lit(0)).alias("fails_alone"),
        )
        for bit, (name, _) in rules.items()
        if mask >> bit & 1
    ]
    return counts.select(F.explode(F.array(*each)).alias("r")).groupBy("r.bit", "r.rule").agg(F.sum("r.fails").alias("fails"), F.sum("r.fails_alone").alias("fails_alone"))
