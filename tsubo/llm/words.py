"""Words and word shingles as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(text: Column) -> Column:
    """The text itself; NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(whole_text(text), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is.

    ``lower`` is used where the text is plain ASCII; elsewhere only A-Z are translated.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shingle_text(tokens: Column, start: Column, width: int) -> Column:
    return F.concat_ws(" ", *(F.get(tokens, start + i) for i in range(width)))


def shingle_hash(tokens: Column, start: Column, width: int) -> Column:
    return F.xxhash64(*(F.get(tokens, start + i) for i in range(width)))


def over_shingles(tokens: Column, width: int, value) -> Column:
    """``value(tokens, start, width)`` of every window of ``width`` words.

    A shorter, non-empty sequence gives one value, of the whole sequence; no words give none.
    """
    last = F.size(tokens) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: value(tokens, i, width))).otherwise(
        F.when(F.size(tokens) > 0, F.array(value(tokens, F.lit(0), width))).otherwise(F.array().cast("array<string>") if value is shingle_text else F.array().cast("array<bigint>"))
    )
