"""Keyed upsert (INSERT ... ON CONFLICT DO UPDATE) as a full outer join.

For every key: present in the update -> the update's values, ``updated_at``
set to now, ``created_at`` kept from the existing row when there is one;
absent from the update -> the existing row unchanged (no delete). Running the
same update twice gives the same business values (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = ("created_at", "updated_at")


def upsert(
    existing: DataFrame | None,
    updates: DataFrame,
    key: str | Sequence[str],
    now: Column | None = None,
    mark: str | None = None,
) -> DataFrame:
    """``mark``: name of a column to add, ``kept``, ``renewed`` or ``inserted``."""
    keys = [key] if isinstance(key, str) else list(key)
    now = now if now is not None else F.current_timestamp()
    business = [c for c in updates.columns if c not in AUDIT]
    fresh = updates.select(*business)
    if existing is None:
        out = fresh.withColumn("created_at", now).withColumn("updated_at", now)
        return out.withColumn(mark, F.lit("inserted")) if mark else out
    old = existing.select(*business, *AUDIT).alias("o")
    new = fresh.withColumn("_hit", F.lit(True)).alias("n")
    j = old.join(new, keys, "full_outer")
    hit = F.coalesce(F.col("n._hit"), F.lit(False))
    cols = [F.col(k) for k in keys]
    cols += [F.when(hit, F.col(f"n.`{c}`")).otherwise(F.col(f"o.`{c}`")).alias(c) for c in business if c not in keys]
    cols += [
        F.coalesce(F.col("o.created_at"), now).alias("created_at"),
        F.when(hit, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    ]
    marks = []
    if mark:
        state = F.when(~hit, "kept").when(F.col("o.created_at").isNull(), "inserted").otherwise("renewed")
        marks = [mark]
        cols.append(state.alias(mark))
    return j.select(*cols).select(*business, *AUDIT, *marks)
