"""Spans (``kind, start, end``) of a text as columns.  Positions are code points, the end is exclusive."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: Iterable[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)
