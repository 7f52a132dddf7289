"""Exact top-k inner products by block-at-a-time pruning.

Components are taken as integers, floor(scale * x), and a vector is a document
whose terms are its components, positive and negative halves apart. Documents are
put in an order that keeps like ones together (nearest of a few sampled centers,
then the distance to it) and cut into blocks. A block has a forward index (its
codes as a matrix) and a maximum for each term, so for any query the sum over its
terms of weight times maximum bounds every score in the block. Each query takes
the blocks in the order of their bounds and scores them through the forward index
until a bound falls below its kth score so far; nothing above the kth is lost.

On Spark: equal vectors are one class with its k + 1 least ids (more cannot be
asked for), so copies cost nothing however many there are. A query is a class too,
answered once with k + 1 candidates and read by all its rows, each without itself.
Queries start with the kth score of the block they lie in. Chunks of queries meet
block summaries first (bounds only), and only the blocks that some query of a
chunk still needs are sent to it, in parts of ``PART`` blocks, a task each; parts
give k + 1 candidates a query, and these merge with a limited window.

The centers are fitted on a bounded sample (``CENTERS`` classes); they only set
the order, every row is indexed and the result is exact whatever they are. Where
the data have no structure the bounds prune nothing, and the work is the product
of the query set and all rows, in blocks.

Defined results: null ids and vectors that are null or hold null or non-finite
components take no part; vectors meet those of their own length only, empty ones
included (score 0); repeats of an id and vector are one row; an id with several
vectors is a row for each, as query and as candidate, and a query leaves out only
its own row; ties go to the smaller id (rows of one id in any order); a query alone
has no rows; an empty table gives none; other columns are not read. A score that
does not fit a long fails.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table

#: Classes that are sampled as centers of the order, for each length of vectors.
CENTERS = 256
#: Classes in a block; blocks in a part; queries in a chunk; summaries in a shard.
BLOCK, PART, CHUNK, SHARD = 256, 256, 4096, 4096


_TYPES = ("<i1", "<i2", "<i4", "<f8")


def pack(x: np.ndarray) -> bytes:
    """Integers in the narrowest type that holds them all; equal ones have equal bytes."""
    most = np.abs(x).max(initial=0)
    kind = sum(most >= 2**b for b in (7, 15, 31))
    return bytes([kind]) + x.astype(_TYPES[kind]).tobytes()


def unpack(cell: bytes, dim: int, n: int = 1) -> np.ndarray:
    """The ``n`` rows of ``dim`` integers that were packed, as doubles."""
    return np.frombuffer(cell, _TYPES[cell[0]], offset=1).astype(np.float64).reshape(n, dim)


def codes_of(column, scale: int) -> tuple[list[int], list[bytes | None]]:
    """Length and packed floor(scale * x) of each usable vector, else None."""
    flat, offsets = _flat(column)
    fine = np.isfinite(flat)
    values = np.floor(np.where(fine, flat, 0.0) * scale) + 0.0
    bad = np.concatenate([[0], np.cumsum(~(fine & np.isfinite(values)))])
    null = column.is_null().to_numpy(zero_copy_only=False)
    return np.diff(offsets).tolist(), [
        None if null[i] or bad[e] > bad[s] else pack(values[s:e])
        for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    ]


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Components of a list column (null ones as NaN) and the offsets of its rows."""
    sizes = np.array(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _coded(scale: int):
    def run(batches):
        for b in batches:
            dims, cells = codes_of(b.column("embedding"), scale)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(dims, pa.int32()), pa.array(cells, pa.binary())], ["id", "dim", "cell"])

    return run


def matrix(cells, dim: int) -> np.ndarray:
    """Packed vectors as the rows of a matrix of doubles."""
    return np.concatenate([unpack(c, dim) for c in cells]) if len(cells) else np.zeros((0, dim))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of rows of integers, exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if most < 2**24:
        return (x.astype(np.float32) @ y.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (x @ y.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in x], dtype=object) @ np.array([[int(v) for v in r] for r in y], dtype=object).T
    if any(not -(2**63) <= v < 2**63 for v in exact.ravel()):
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def maxima(x: np.ndarray) -> np.ndarray:
    """Maximum of each term of a block: of its components, then of their negatives."""
    return np.concatenate([x.max(axis=0), -x.min(axis=0)])


def bounds(queries: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """Sums over a query's terms of weight times maximum, for each block, rounded up
    where sums of doubles are not exact."""
    terms = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1)
    out = terms @ tops.T
    most = np.abs(terms).max(initial=0) * np.abs(tops).max(initial=0) * max(1, terms.shape[1])
    return out if most < 2**53 else out + (np.abs(terms) @ np.abs(tops).T) * 2.0**-40


class Best:
    """The best candidates so far of each query of a chunk: score downward, then id, then class."""

    def __init__(self, floor: np.ndarray, keep: int):
        self.floor, self.keep = floor.astype(np.float64), keep  # a score below it cannot be among the best
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in floor]

    def add(self, rows, scores, ids, classes) -> None:
        """``scores`` (rows x members of a block); ``ids`` the members' ids (ascending tuples)."""
        at, member = np.nonzero(scores >= self.floor[rows][:, None])
        if not len(at):
            return
        value = scores[at, member]
        edge = np.flatnonzero(np.diff(at, prepend=-1))
        for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(at)]):
            q = int(rows[at[s]])
            new, own = value[s:e], member[s:e]
            if e - s > self.keep:  # ties with the last one stay
                least = np.partition(new, len(new) - self.keep)[len(new) - self.keep]
                own, new = own[new >= least], new[new >= least]
            got = self.found[q] + [(-int(v), i, int(classes[m])) for v, m in zip(new, own) for i in ids[m]]
            got.sort()
            self.found[q] = got = got[: self.keep]
            if len(got) == self.keep:
                self.floor[q] = max(self.floor[q], -got[-1][0])


def search(queries: np.ndarray, floor: np.ndarray, blocks: list, keep: int) -> Best:
    """Best of ``blocks`` (codes, maxima, ids, classes) for each query, every query
    in the order of its own bounds, twice as many blocks a round as in the one before."""
    best = Best(floor, keep)
    if not blocks:
        return best
    bound = bounds(queries, np.stack([b[1] for b in blocks]))
    order = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    at, run = 0, 1
    while at < len(blocks):
        open_ = np.flatnonzero(bound[:, at] >= best.floor)  # the others are done
        if not len(open_):
            break
        chosen, limit = order[open_, at : at + run], bound[open_, at : at + run]
        for k in np.unique(chosen).tolist():
            rows = open_[((chosen == k) & (limit >= best.floor[open_][:, None])).any(axis=1)]
            if len(rows):
                codes, _, ids, classes = blocks[k]
                best.add(rows, products(queries[rows], codes), ids, classes)
        at, run = at + run, run * 2
    return best


def _centers(sample: list[tuple[int, bytes]]) -> dict[int, np.ndarray]:
    out: dict[int, list[bytes]] = {}
    for dim, cell in sample:
        out.setdefault(dim, []).append(cell)
    return {dim: matrix(cells, dim) for dim, cells in out.items()}


def _placed(centers: dict[int, np.ndarray]):
    def run(batches):
        for b in batches:
            cells, dims = b.column("cell").to_pylist(), np.array(b.column("dim"))
            near, away = np.zeros(len(cells), dtype=np.int32), np.zeros(len(cells))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                if dim in centers:
                    x, c = matrix([cells[i] for i in own], dim), centers[dim]
                    gap = (c * c).sum(axis=1) / 2 - x @ c.T
                    near[own] = gap.argmin(axis=1)
                    away[own] = gap.min(axis=1) + (x * x).sum(axis=1) / 2
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(away)], [*b.schema.names, "near", "away"])

    return run


_BLOCKS = "block long, dim int, tops binary, classes binary, asked binary, floors binary, cells binary, ids array<array<long>>"


def _blocked(block: int, keep: int):
    """Blocks of the sorted rows of a partition; queries get the kth score inside their block."""

    def run(batches):
        number, held, dim = TaskContext.get().partitionId() << 32, [], None

        def make(rows):
            x = matrix([r["cell"] for r in rows], dim)
            classes = np.array([r["class"] for r in rows], dtype="<i8")
            asked = np.array([r["asked"] for r in rows], dtype=bool)
            best = search(x[asked], np.full(asked.sum(), -np.inf), [(x, maxima(x), [r["ids"] for r in rows], classes)], keep)
            return {
                "block": number, "dim": dim, "tops": pack(maxima(x)), "classes": classes.tobytes(),
                "asked": asked.astype("u1").tobytes(), "floors": best.floor.astype("<f8").tobytes(),
                "cells": pack(x), "ids": [r["ids"] for r in rows],
            }

        schema = pa.schema(
            [("block", pa.int64()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("tops", "classes", "asked", "floors", "cells")), ("ids", pa.list_(pa.list_(pa.int64())))]
        )
        for b in batches:
            for row in b.select(["dim", "cell", "class", "asked", "ids"]).to_pylist():
                if held and (len(held) == block or row["dim"] != dim):
                    yield pa.RecordBatch.from_pylist([make(held)], schema)
                    number, held = number + 1, []
                dim = row["dim"]
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist([make(held)], schema)

    return run


def _needed(part: int):
    """Blocks that some query of a chunk needs, best bounds first, dealt into parts."""

    def run(chunk: pa.Table, summaries: pa.Table) -> pa.Table:
        none = pa.table({"chunk": pa.array([], pa.string()), "part": pa.array([], pa.int64()), "block": pa.array([], pa.int64())})
        if not chunk.num_rows or not summaries.num_rows:
            return none
        dim = chunk.column("dim")[0].as_py()
        x, floor = _queries(chunk)
        bound = bounds(x, matrix(summaries.column("tops").to_pylist(), 2 * dim))
        wanted = np.flatnonzero((bound >= floor[:, None]).any(axis=0))
        wanted = wanted[np.argsort(-bound.max(axis=0)[wanted], kind="stable")]
        shard = summaries.column("to_shard")[0].as_py()
        parts = -(-max(len(wanted), 1) // part)
        return pa.table({
            "chunk": pa.array([chunk.column("chunk")[0].as_py()] * len(wanted), pa.string()),
            "part": pa.array((shard << 20) + np.arange(len(wanted)) % parts, pa.int64()),  # each part begins with good ones
            "block": summaries.column("found").take(pa.array(wanted)).combine_chunks(),
        })

    return run


def _queries(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    dim = chunk.column("dim")[0].as_py()
    x, floor = [], []
    for asked, floors, cells in zip(*(chunk.column(c).to_pylist() for c in ("asked", "floors", "cells"))):
        own = np.frombuffer(asked, "u1").astype(bool)
        x.append(unpack(cells, dim, len(own))[own])
        floor.append(np.frombuffer(floors, "<f8"))
    return np.concatenate(x), np.concatenate(floor)


def _searched(keep: int):
    def run(chunk: pa.Table, blocks: pa.Table) -> pa.Table:
        dim = chunk.column("dim")[0].as_py()
        x, floor = _queries(chunk)
        asked = np.concatenate(
            [np.frombuffer(c, "<i8")[np.frombuffer(a, "u1").astype(bool)] for c, a in zip(chunk.column("classes").to_pylist(), chunk.column("asked").to_pylist())]
        )
        parts = []
        for tops, classes, cells, ids in zip(*(blocks.column(c).to_pylist() for c in ("sent_tops", "sent", "sent_cells", "ids"))):
            classes = np.frombuffer(classes, "<i8")
            parts.append((unpack(cells, dim, len(classes)), unpack(tops, 2 * dim)[0], ids, classes))
        best = search(x, floor, parts, keep)
        rows = [(int(q), -s, i, c) for q, found in zip(asked, best.found) for s, i, c in found]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query", "score", "id", "class"), columns)})

    return run


def top_vectors(vectors: DataFrame, k: int, scratch: Scratch, scale: int = 64, every: int = 20, block: int = BLOCK, part: int = PART, chunk: int = CHUNK, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` highest integer inner products of
    each row of ``vectors`` (vec_id, embedding) whose id ``every`` divides."""
    spark, keep = vectors.sparkSession, k + 1
    rows = scratch.keep(
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .mapInArrow(_coded(scale), "id long, dim int, cell binary")
        .where("cell IS NOT NULL")
        .distinct()
    )
    # classes: the k + 1 least ids of equal vectors (limited before they meet), and whether a query is one
    nth = F.row_number().over(Window.partitionBy("dim", "cell").orderBy("id"))
    members = rows.withColumn("nth", nth).where(F.col("nth") <= keep).groupBy("dim", "cell").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    queries = rows.where(F.col("id") % every == 0)
    asked = queries.select("dim", "cell").distinct().withColumn("asked", F.lit(True))
    classes = scratch.keep(
        members.join(asked, ["dim", "cell"], "left").select(
            F.monotonically_increasing_id().alias("class"), "dim", "cell", "ids", F.coalesce("asked", F.lit(False)).alias("asked")
        )
    )
    # a bounded sample, by digest of the codes
    sample = classes.select("dim", "cell").orderBy(F.xxhash64("cell"), "cell").limit(CENTERS).collect()
    placed = classes.mapInArrow(_placed(_centers([tuple(r) for r in sample])), "class long, dim int, cell binary, ids array<long>, asked boolean, near int, away double")
    blocks = scratch.keep(
        placed.repartitionByRange("dim", "near", "away", "class").sortWithinPartitions("dim", "near", "away", "class").mapInArrow(_blocked(block, keep), _BLOCKS)
    )
    # chunks of queries and shards of summaries, of one length of vectors each
    n_asked = F.expr("length(replace(hex(asked), '00', '')) div 2").cast("long")
    # as many runs of blocks as it takes to number chunks of queries in bounded windows
    runs = max(1, queries.count() // (16 * chunk))
    run = ["dim", "run"]
    sized = blocks.select("block", "dim", n_asked.alias("n_asked"), F.pmod(F.shiftright("block", 32), F.lit(runs)).alias("run"))
    before = Window.partitionBy(*run).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = F.greatest(F.ceil(F.count("*").over(Window.partitionBy(*run)) * runs / shard), F.lit(1))
    dealt = scratch.keep(
        sized.select(
            "block", "dim", "n_asked",
            F.concat_ws(":", "dim", "run", F.floor(F.coalesce(F.sum("n_asked").over(before), F.lit(0)) / chunk)).alias("chunk"),
            F.pmod(F.xxhash64("block"), shards).alias("shard"),
        )
    )
    asking = blocks.drop("tops", "ids").join(dealt.where("n_asked > 0").select("block", "chunk"), "block").drop("block")
    cells = dealt.where("n_asked > 0").select("dim", "chunk").distinct().join(dealt.select("dim", "shard").distinct(), "dim")
    to_cells = cells.select(F.col("dim").alias("of_dim"), F.col("shard").alias("to_shard"), F.col("chunk").alias("to_chunk"))
    summaries = (
        blocks.select(F.col("block").alias("found"), "tops")
        .join(dealt.select(F.col("block").alias("found"), F.col("dim").alias("of_dim"), F.col("shard").alias("to_shard")), "found")
        .join(to_cells, ["of_dim", "to_shard"])
        .select("to_chunk", "to_shard", "found", "tops")
    )
    needed = scratch.keep(
        asking.join(cells.select("chunk", "shard"), "chunk")
        .groupBy("chunk", "shard")
        .cogroup(summaries.groupBy("to_chunk", "to_shard"))
        .applyInArrow(_needed(part), "chunk string, part long, block long")
    )
    sent = needed.select(F.col("chunk").alias("to_chunk"), F.col("part").alias("to_part"), "block").join(
        blocks.select("block", "tops", "classes", "cells", "ids"), "block"
    ).select("to_chunk", "to_part", F.col("tops").alias("sent_tops"), F.col("classes").alias("sent"), F.col("cells").alias("sent_cells"), "ids")
    found = (
        asking.join(needed.select("chunk", "part").distinct(), "chunk")
        .groupBy("chunk", "part")
        .cogroup(sent.groupBy("to_chunk", "to_part"))
        .applyInArrow(_searched(keep), "query long, score long, id long, class long")
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id", "class")
    best = found.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= keep)
    answers = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "score", "id", "class"))).alias("best"))
    asking_rows = queries.join(classes.where("asked").select("dim", "cell", F.col("class").alias("query")), ["dim", "cell"]).select(F.col("id").alias("query_id"), "query")
    own = asking_rows.join(answers, "query").withColumn(
        "best", F.expr(f"slice(filter(best, b -> NOT (b.id = query_id AND b.class = query)), 1, {int(k)})")
    )
    return own.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score")
    )


def op12_exact_topk_search(spark, sf_dir: str, k: int = 20) -> DataFrame:
    """The ``k`` highest integer inner products of every twentieth vector of ``embeddings`` with all others."""
    return top_vectors(table(spark, sf_dir, "embeddings"), k, Scratch(spark, "op12"))


#: The same rows in DuckDB, every pair scored.
OP12_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.c) = len(q.c) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
