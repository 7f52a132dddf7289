"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

The input is numbered in blocks of consecutive rows. The matrix of block-to-
shard row counts is drawn exactly as a uniform permutation of all rows would
give it (a multivariate hypergeometric draw for each block from what the shards
still lack; Sanders 1998, Gustedt 2008). Each block is then permuted locally and
dealt out by its row of the matrix, the rows are exchanged, and each shard is
permuted again. Shard sizes are fixed before any draw, so they are exact and at
most one row apart.

The second permutation sorts by a keyed hash in sub-blocks whose offsets come
from counts, so that neither a block nor a shard must fit in one task.

Defined results: null text counts as empty; a row is a row (repeated rows and
repeated or null ids get places of their own); an empty table gives no rows;
columns other than id and text are neither read nor returned.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table

#: Rows of a block, as a power of two: the driver's matrix has a row per block.
BLOCK_BITS = 16


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` of ``good + bad``. Beyond numpy's populations
    the distribution is inverted outwards from its mode."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    lo, hi = max(0, drawn - bad), min(good, drawn)
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), lo), hi)
    p = math.exp(_log_choose(good, mode) + _log_choose(bad, drawn - mode) - _log_choose(good + bad, drawn))
    left = rng.random() - p
    a = b = mode
    pa = pb = p
    while left > 0 and (a > lo or b < hi):
        if b < hi:
            pb *= (good - b) * (drawn - b) / ((b + 1) * (bad - drawn + b + 1))
            b += 1
            left -= pb
            if left <= 0:
                return b
        if a > lo:
            pa *= a * (bad - drawn + a) / ((good - a + 1) * (drawn - a + 1))
            a -= 1
            left -= pa
            if left <= 0:
                return a
    return mode


def communication_matrix(rows: list[int], sizes: list[int], rng: np.random.Generator) -> list[list[int]]:
    """Counts from each block (of ``rows``) to each shard (of ``sizes``), drawn
    as a uniform permutation gives them; row sums and column sums are exact."""
    lack = list(sizes)
    out = []
    for n in rows:
        total, counts = sum(lack), []
        for s, have in enumerate(lack):
            total -= have
            got = hypergeometric(rng, have, total, n) if s < len(lack) - 1 else n
            counts.append(got)
            n -= got
        lack = [a - b for a, b in zip(lack, counts)]
        out.append(counts)
    return out


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int, scratch: Scratch) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each
    shard). ``rows`` should be narrow: it is written and exchanged."""
    spark = rows.sparkSession
    # the numbering is written once, so later steps and retries see the same blocks
    numbered = scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_block", F.shiftright("_row", BLOCK_BITS))
    blocks = numbered.groupBy("_block").count().orderBy("_block").collect()
    total = sum(b["count"] for b in blocks)
    rng = np.random.Generator(np.random.PCG64(seed))
    extra = set(rng.permutation(shards)[: total % shards].tolist())
    sizes = [total // shards + (s in extra) for s in range(shards)]
    matrix = communication_matrix([b["count"] for b in blocks], sizes, rng)
    ends = spark.createDataFrame(
        [(b["_block"], np.cumsum(m).tolist()) for b, m in zip(blocks, matrix)], "_block long, _ends array<long>"
    )
    place = F.row_number().over(Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed), "_row"), "_row")) - 1
    parts = max(1, math.ceil(total / shards / (1 << BLOCK_BITS)))
    key = F.xxhash64(F.lit(seed + 1), "_row")
    dealt = scratch.keep(
        numbered.withColumn("_place", place)
        .join(ends, "_block")
        .withColumn("shard", F.expr("size(filter(_ends, e -> e <= _place))").cast("int"))
        .withColumn("_part", F.pmod(key, F.lit(parts)).cast("int"))
        .drop("_block", "_place", "_ends")
    )
    counts = dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    again = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(F.xxhash64(F.lit(seed + 2), "_row"), "_row"))
    return (
        dealt.withColumn("_rank", again.cast("long"))
        .join(offsets, ["shard", "_part"])
        .withColumn("slot", F.col("_offset") + F.col("_rank") - 1)
        .drop("_row", "_part", "_rank", "_offset")
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1) and text_crc32 of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def op10_hypergeometric_sharding(spark, sf_dir: str, shards: int = 16, seed: int = 20240917) -> DataFrame:
    """All documents in ``shards`` shards by the ``rows`` law (module docstring)."""
    scratch = Scratch(spark, "op10")
    placed = shuffle_into_shards(measured(table(spark, sf_dir, "documents")), shards, seed, scratch)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
