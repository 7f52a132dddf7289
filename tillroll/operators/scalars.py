"""Attaching global values (a one-row aggregate) to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame — a global aggregate such as a
    reference date, quintile edges, a total or histogram bounds — to every row.

    Only ever called with a frame that is one row by construction (a
    ``groupBy()``-less aggregate), so the broadcast side has a proven size of
    one row and the join is a nested loop over that single row: no pairs are
    produced. Referencing the values as columns keeps the plan linear in size
    (a scalar subquery would be copied into every expression that uses it).
    """
    return df.crossJoin(F.broadcast(one_row))
