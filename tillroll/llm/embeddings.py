"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Every vector is normalised and quantised to int8 with a scale of its own; the
exact length of its quantisation error is kept. For any two vectors the cosine
differs from the scaled integer product by at most
``e_a * |q_b| + |q_a| * e_b + e_a * e_b``, so a tile of integer products shows
which pairs can reach the threshold, and only those are recomputed in double
precision. No pair at or above the threshold is lost.

Equal vectors of a label are one class with a count. Classes of a label are
dealt into blocks of bounded size and every pair of blocks is a task of its own;
a label with a third of all rows only has more blocks. Blocks hold neighbours
along a direction, and two blocks whose projections on it are further apart than
the threshold allows are never joined. A tile returns counts for each vector and
the edges of a spanning forest of its links, never all its pairs.

Defined results: vectors that are null, zero or hold null or non-finite
components, null labels, and vectors of different lengths link with nothing; a
row is a row: rows that repeat an id count as vectors of their own, and are one
node of the components; a null id never joins a component (null component, kept);
an empty table gives no rows; columns other than vec_id, embedding and label are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components, forest
from tillroll.llm.scratch import Scratch, table

#: Vectors in a block, about: a task multiplies two blocks, TILE columns at a time.
BLOCK = 4096
TILE = 1024
#: Room for rounding of the bounds themselves, in cosine.
ROUNDING = 1e-9


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, length of the coded vector and of the error, of each row."""
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(u - back, axis=1)


def candidates(a, b, threshold: float):
    """Indices of all pairs of quantised rows whose cosine may be ``threshold`` or more."""
    (qa, sa, la, ea), (qb, sb, lb, eb) = a, b
    exact = np.float32 if 127 * 127 * qa.shape[1] < 2**24 else np.float64  # products of int8 stay exact
    product = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64)
    product *= sa[:, None]
    product *= sb[None, :]
    product += ea[:, None] * (lb + eb)[None, :]
    product += la[:, None] * eb[None, :]
    return np.nonzero(product >= threshold - ROUNDING)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision."""
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def _matrix(cells, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.float64).reshape(-1, dim)


def _classes_of(batches):
    """Usable vectors as bytes of doubles (float values are exact in them)."""
    for b in batches:
        cells, ids, labels, dims = [], [], [], []
        for i, v, label in zip(b.column("id").to_pylist(), b.column("embedding").to_pylist(), b.column("label").to_pylist()):
            cell, dim = None, 0
            if v and label is not None:
                x = np.array([np.nan if c is None else c for c in v], dtype=np.float64)
                if np.isfinite(x).all() and x.any():
                    cell, dim = (x + 0.0).tobytes(), len(x)
            cells.append(cell)
            ids.append(i)
            labels.append(label)
            dims.append(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(dims, pa.int32()), pa.array(cells, pa.binary())],
            ["id", "label", "dim", "cell"],
        )


def _direction(dim: int) -> np.ndarray:
    d = np.random.Generator(np.random.PCG64(dim)).standard_normal(dim)
    return d / np.linalg.norm(d)


def _project(batches):
    """Place of each normalised vector along its dimension's fixed direction."""
    for b in batches:
        at = []
        for dim, cell in zip(b.column("dim").to_pylist(), b.column("cell").to_pylist()):
            v = np.frombuffer(cell, dtype=np.float64)
            v = v / np.abs(v).max()
            at.append(float(v @ _direction(dim) / np.linalg.norm(v)))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.float64())], [*b.schema.names, "at"])


def _tile(threshold: float):
    def run(key, rows):
        _, dim, i, j = key[0], key[1], key[2], key[3]
        left = rows[rows["block"] == i].sort_values("class")
        right = left if i == j else rows[rows["block"] == j].sort_values("class")
        empty = pd.DataFrame({"class": [], "links": [], "to": []}).astype("int64")
        if not len(left) or not len(right):
            return empty
        x, y = _matrix(left["cell"], dim), _matrix(right["cell"], dim)
        # squares stay in range; a power of two changes no cosine
        x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (x, y))
        qx, qy = quantise(x), quantise(y)
        mx, my = left["many"].to_numpy(), right["many"].to_numpy()
        nx, ny = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        offset = 0 if i == j else len(x)
        root = np.arange(len(x) if i == j else len(x) + len(y))
        for c in range(0, len(y), TILE):
            p, q = candidates(qx, tuple(z[c : c + TILE] for z in qy), threshold)
            q = q + c
            if i == j:
                upper = p < q
                p, q = p[upper], q[upper]
            at = 0
            while at < len(p):  # in double precision, a bounded number at a time
                pp, qq = p[at : at + 65536], q[at : at + 65536]
                hit = cosines(x[pp], y[qq]) >= threshold
                pp, qq = pp[hit], qq[hit]
                nx += np.bincount(pp, weights=my[qq], minlength=len(x)).astype(np.int64)
                ny += np.bincount(qq, weights=mx[pp], minlength=len(y)).astype(np.int64)
                root = forest(len(root), np.concatenate([pp, np.arange(len(root))]), np.concatenate([qq + offset, root]))
                at += 65536
        if i == j:
            nx += ny
            ids, counts = left["class"].to_numpy(), nx
        else:
            ids = np.concatenate([left["class"].to_numpy(), right["class"].to_numpy()])
            counts = np.concatenate([nx, ny])
        touched = counts > 0
        return pd.DataFrame({"class": ids[touched], "links": counts[touched], "to": ids[root][touched]})

    return run


def near_vectors(vectors: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id,
    embedding, label); ``threshold`` is a cosine in (0, 1]."""
    rows = scratch.keep(
        vectors.select(
            F.col("vec_id").cast("long").alias("id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.col("label").cast("string").alias("label"),
        ).mapInArrow(_classes_of, "id long, label string, dim int, cell binary")
    )
    key = ["label", "dim", "cell"]
    some = rows.where("cell IS NOT NULL")
    numbered = scratch.keep(
        some.groupBy(*key).agg(F.count("*").alias("many"), F.min("id").alias("least")).withColumn("class", F.monotonically_increasing_id())
    )
    # blocks: neighbours along a direction, about BLOCK classes each, by quantiles of each label
    placed = scratch.keep(numbered.mapInArrow(_project, "label string, dim int, cell binary, many long, least long, class long, at double"))
    sizes = placed.groupBy("label", "dim").agg(F.count("*").alias("n"), F.percentile_approx("at", F.lit([k / 256 for k in range(1, 256)]), F.lit(4096)).alias("cuts"))
    # a block is a run of quantile cells, or a keyed share of one where a cell holds more than a block
    per = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1))
    sized = F.broadcast(sizes) if sizes.count() <= 10_000 else sizes  # 2 KB a label
    cell = F.expr("size(filter(cuts, c -> c < at))")
    blocks = scratch.keep(
        placed.join(sized, ["label", "dim"])
        .withColumn("_cell", cell)
        .withColumn("_shares", F.greatest(F.ceil(F.col("n") / (256 * BLOCK)), F.lit(1)))
        .withColumn("_run", F.floor(F.col("_cell") * F.least(per, F.lit(256)) / 256))
        .withColumn("block", (F.col("_run") * F.col("_shares") + F.pmod(F.xxhash64("class"), F.col("_shares"))).cast("int"))
        .select("label", "dim", "cell", "many", "class", "block", "at")
    )
    spans = blocks.groupBy("label", "dim", "block").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    # unit vectors at this cosine are at most this far apart, and so are their projections
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    a, b = spans.alias("a"), spans.alias("b")
    pairs = a.join(b, ["label", "dim"]).where(
        (F.col("a.block") <= F.col("b.block"))
        & (F.col("a.low") - F.col("b.high") <= reach)
        & (F.col("b.low") - F.col("a.high") <= reach)
    ).select("label", "dim", F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    sides = pairs.select("label", "dim", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    tiles = blocks.drop("at").join(sides, ["label", "dim", "block"])
    linked = scratch.keep(
        tiles.groupBy("label", "dim", "i", "j").applyInPandas(_tile(threshold), "class long, links long, to long")
    )
    ids = numbered.select("class", "least")
    edges = (
        linked.where("`class` <> to")
        .join(ids, "class")
        .join(ids.select(F.col("class").alias("to"), F.col("least").alias("b")), "to")
        .select(F.col("least").alias("a"), "b")
    )
    member = some.join(numbered, key).select("id", "class", "many", "least")
    twice = member.select("id", "least").where("id IS NOT NULL").distinct()
    twice = twice.join(twice.groupBy("id").agg(F.min("least").alias("a"), F.count("*").alias("c")).where("c > 1"), "id")
    found = scratch.keep(components(edges.union(twice.select("a", F.col("least").alias("b"))), scratch))
    per_class = linked.groupBy("class").agg(F.sum("links").alias("links"))
    known = numbered.join(per_class, "class", "left").join(found.withColumnRenamed("node", "least"), "least", "left").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "least").alias("component")
    )
    component = F.coalesce("component", "id")
    return rows.join(known, key, "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op2_int8_near_dedup(spark, sf_dir: str, threshold: float = 0.98) -> DataFrame:
    """Near duplicates of ``embeddings`` within a label at ``threshold`` cosine."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold, Scratch(spark, "op2"))


#: The same rows in DuckDB, pair by pair in double precision.
OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT vec_id AS node, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN m ON m.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
