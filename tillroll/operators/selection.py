"""Exact order statistics of several orderings at once, without sorting them.

Two actions over a table, however many orderings and ranks are asked for:

1. One aggregate takes the row count of every ordering and a quantile sketch of
   it (``percentile_approx``: mergeable, bounded by ``ACCURACY``). The sketch's
   rank error is n / ACCURACY at most, so two of its values bracket each wanted
   rank for certain.
2. A second aggregate counts the rows between the brackets, and the few rows inside
   by value; a running sum along each ordering gives the wanted ranks.

No range shuffle, no written table, no row outside a bracket moves; what comes to
the driver is one row of sketch values and one row for each wanted rank.

Ties are broken by a key where one is given. So that a value held by most rows
does not make its bracket as large, the sketch then sees a double that follows the
order of (value, key): the value scaled to a whole number plus a fraction that
follows the key. It only has to be monotone; the rows inside are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch: its rank error is a share 1 / ACCURACY of the rows.
ACCURACY = 4000
EXACT = "decimal(38,4)"
_FLOATING = ("double", "float")


@dataclass(frozen=True)
class Ordering:
    """Rows with a value, by value and then by key (None: equal values are one).

    ``ranks`` gives the wanted 0-based ranks of n rows, ``near`` the shares of the
    rows that they are close to."""

    value: str
    key: str | None
    ranks: Callable[[int], set[int]]
    near: tuple[float, ...]


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _follows(o: Ordering, types: dict[str, str]) -> str:
    """SQL of a double that never falls along (value, key)."""
    value, value_type = _quoted(o.value), types[o.value]
    if o.key is None or value_type in _FLOATING:
        return f"cast({value} AS double)"
    scale = int(value_type.rstrip(")").split(",")[1]) if value_type.startswith("decimal") else 0
    whole, key, key_type = f"rint(cast({value} AS double) * 1e{scale}D)", _quoted(o.key), types[o.key]
    if key_type == "string":  # the first six bytes, as Spark orders strings
        first = f"rpad(hex(substring(encode({key}, 'UTF-8'), 1, 6)), 12, '0')"
        return f"{whole} + cast(conv({first}, 16, 10) AS double) / {2**48}.0D"
    number = f"cast({key} AS double)"
    most = "130D" if key_type in ("tinyint", "smallint", "int", "bigint") else "2100D"  # over twice any logarithm
    return f"{whole} + 0.5D + signum({number}) * log2(abs({number}) + 1D) / {most}"


def _grid(near: Sequence[float]) -> list[float]:
    """Shares at which a sketch is asked: each wanted one with steps of growing width about it."""
    steps = [2.0 / ACCURACY * 4**i for i in range(6)]
    return sorted({0.0, 1.0, *(p for f in near for s in steps for p in (f - s, f + s) if 0.0 < p < 1.0)})


def _bracket(rank: int, n: int, grid: list[float], values: list[float]) -> tuple[float, float]:
    """Sketch values that hold the rank between them for certain (infinite: open)."""
    error = 1.0 / ACCURACY
    below = [v for p, v in zip(grid, values) if p <= (rank - 1) / n - error]
    above = [v for p, v in zip(grid, values) if p >= (rank + 2) / n + error]
    return (below[-1] if below else -math.inf), (above[0] if above else math.inf)


def order_statistics(df: DataFrame, orderings: Sequence[Ordering]) -> list[tuple[int, dict[int, tuple[Any, Any]]]]:
    """For each ordering its row count and {rank: (value, key)}; a decimal or whole
    value comes as a decimal, a floating one as a float."""
    types = dict(df.dtypes)
    follows = [_follows(o, types) for o in orderings]
    grids = [_grid(o.near) for o in orderings]
    sketch = df.selectExpr(
        *(f"count({_quoted(o.value)}) AS n{i}" for i, o in enumerate(orderings)),
        *(f"percentile_approx({x}, array({', '.join(f'{p!r}D' for p in g)}), {ACCURACY}) AS q{i}" for i, (x, g) in enumerate(zip(follows, grids))),
    ).first()
    out: list[tuple[int, dict[int, tuple[Any, Any]]]] = [(sketch[f"n{i}"], {}) for i in range(len(orderings))]
    wanted = [o.ranks(n) if n else set() for o, (n, _) in zip(orderings, out)]
    around = [
        _apart([_bracket(r, n, grids[i], sketch[f"q{i}"]) for r in ranks]) for i, (ranks, (n, _)) in enumerate(zip(wanted, out))
    ]
    _pick(df, orderings, follows, types, wanted, around, out)
    missing = [ranks - set(found) for ranks, (_, found) in zip(wanted, out)]
    # only if a sketch broke its bound: the whole ordering is the bracket
    _pick(df, orderings, follows, types, missing, [[(-math.inf, math.inf)] if m else [] for m in missing], out)
    return out


def _apart(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The brackets in order, those that meet as one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _zone(x: str, brackets: list[tuple[float, float]]) -> str:
    """SQL of where x lies: 2 j + 1 in bracket j, an even number before or after it."""
    cases = []
    for j, (low, high) in enumerate(brackets):
        if low != -math.inf:
            cases.append(f"WHEN {x} < {low!r}D THEN {2 * j}")
        cases.append(f"WHEN {x} <= {high!r}D THEN {2 * j + 1}" if high != math.inf else f"WHEN {x} IS NOT NULL THEN {2 * j + 1}")
    return f"CASE {' '.join(cases)} WHEN {x} IS NOT NULL THEN {2 * len(brackets)} END"


def _pick(df, orderings, follows, types, wanted, around, out) -> None:
    """Count rows by zone, those in a bracket by (value, key) too: one aggregate, whose
    running sum along each ordering gives every rank in a bracket."""
    used = [i for i, ranks in enumerate(wanted) if ranks]
    if not used:
        return
    key_type = next((types[o.key] for o in orderings if o.key is not None), "string")
    named = [_quoted(c) for c in dict.fromkeys(c for i in used for c in (orderings[i].value, orderings[i].key) if c is not None)]
    entries, holds = [], []
    for i in used:
        o, inside = orderings[i], f"_z{i} % 2 = 1"
        value = f"CASE WHEN {inside} THEN {_quoted(o.value)} END"
        exact, real = ("NULL", value) if types[o.value] in _FLOATING else (value, "NULL")
        key = "NULL" if o.key is None else f"CASE WHEN {inside} THEN {_quoted(o.key)} END"
        entries.append(
            f"named_struct('idx', {i}, 'zone', _z{i}, 'exact', cast({exact} AS {EXACT}), 'real', cast({real} AS double), 'key', cast({key} AS {key_type}))"
        )
        holds += [f"(idx = {i} AND upto > {r} AND upto - n <= {r})" for r in sorted(wanted[i])]
    order = ["zone", "exact", "real", "key"]
    counted = (
        df.selectExpr(*named, *(f"{follows[i]} AS _x{i}" for i in used))
        .selectExpr(*named, *(f"{_zone(f'_x{i}', around[i])} AS _z{i}" for i in used))
        .selectExpr(f"inline(array({', '.join(entries)}))")
        .where("zone IS NOT NULL")
        .groupBy("idx", *order)  # equal rows meet before they move
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("idx").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    for r in counted.withColumn("upto", upto).where(f"zone % 2 = 1 AND ({' OR '.join(holds)})").collect():
        value = r["exact"] if r["exact"] is not None else r["real"]
        for rank in wanted[r["idx"]]:
            if r["upto"] - r["n"] <= rank < r["upto"]:
                out[r["idx"]][1][rank] = (value, r["key"])


def linear_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[tuple[int, list[float] | None]]:
    """Row count and exact linear quantiles (position (n - 1) p, interpolated between
    neighbours) of each column; None for a column without values."""

    def ranks(n: int) -> set[int]:
        return {f((n - 1) * p) for p in map(float, probs) for f in (math.floor, math.ceil)}

    out = []
    for n, rows in order_statistics(df, [Ordering(c, None, ranks, tuple(map(float, probs))) for c in columns]):
        edges = []
        for p in map(float, probs) if n else ():
            place = float(n - 1) * p
            low, high = float(rows[math.floor(place)][0]), float(rows[math.ceil(place)][0])
            edges.append(low + (place - math.floor(place)) * (high - low))
        out.append((n, edges or None))
    return out
