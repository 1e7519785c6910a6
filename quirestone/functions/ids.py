"""Stable ids from their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix_`` and 12 hex digits of sha1 of the parts joined with ``||``; null parts count as empty."""
    text = F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(text.cast("binary")), 1, 12))
