"""Near-duplicate documents by SetSketch registers (Ertl 2021).

A register is the exponentially spaced, truncated minimum of a keyed hash over a
document's shingles: floor(1 - log_b(min)), kept in [0, q + 1]. Registers merge by
maximum, and with a base near 1 two documents agree in a register with about the
probability of their Jaccard similarity, so bands of registers are bucket keys.
Pairs are estimated jointly by likelihood (registers that are larger, smaller or
equal, and both set sizes), and what may reach the threshold is verified on the
full shingle sets of the whole texts.

No bucket is expanded into pairs. Documents with equal sets are one class. First
every class of a bucket is compared with the bucket's center, the member that
stands in the most crowded buckets. Where the verified links leave a center's
group with more than one component, each member is described by its exact
difference to the center; tiles of such differences give the exact similarity of
any two members, and only the edges of a spanning forest leave a tile. So no
link between components is lost, and a group of copies costs its size.

Defined results: null or empty text and text without words has no shingles and
links with nothing; rows that repeat an id are one node that links by any of
their texts, each row is returned; a null id is never linked (its component is
null, it is kept); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components, forest
from tillroll.llm.scratch import Scratch, table
from tillroll.llm.texts import mix, shingle_sets, slices

#: Bands of registers: at similarity 0.8 all bands miss with probability
#: (1 - 0.8**ROWS)**BANDS, 3e-6.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
#: A pair is given up where the likelihood at its best is over exp(this) times that at the threshold.
DOUBT = 12.0
#: Members of a group in a block of a tile, and element meetings counted at a time.
BLOCK, MEETINGS = 512, 1 << 21
#: What a member of a group keeps beside its differences.
GROUPED = ["y", "y_d1", "id", "minor", "minor_blocks", "major_blocks"]

_RNG = np.random.Generator(np.random.PCG64(8101))
_XOR = _RNG.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_ODD = _RNG.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 2**63, BANDS, dtype=np.uint64)


def registers(run: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, REGISTERS) 16-bit registers of sets given as runs of hashes."""
    out = np.empty((len(starts), REGISTERS), dtype=np.uint16)
    work = np.empty_like(run)
    for i in range(REGISTERS):
        np.bitwise_xor(run, _XOR[i], out=work)
        np.multiply(work, _ODD[i], out=work)
        least = np.minimum.reduceat(work, starts).astype(np.float64)
        x = -np.log1p(-(least + 1.0) / 2.0**64 * (1 - 1e-15)) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT + 1)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def set_digests(run: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that do not depend on order."""
    one = np.add.reduceat(mix(run ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    two = np.add.reduceat(mix(run + np.uint64(0x6C62272E07BB0142)), starts)
    return mix(one).view(np.int64), mix(two).view(np.int64)


def _log_likelihood(j, u, v, more, less, same):
    def p(x):
        return np.clip(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    a, b = p(u - v * j), p(v - u * j)
    return more * np.log(a) + less * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1))


def may_reach(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, threshold: float):
    """(estimate of the Jaccard similarity, whether it may be the threshold or more)
    of each pair, jointly from registers and set sizes by maximum likelihood."""
    more, less = (x > y).sum(1), (x < y).sum(1)
    same = x.shape[1] - more - less
    u = nx / (nx + ny)
    v = 1 - u
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    most = hi.copy()
    for _ in range(50):  # the likelihood has one maximum
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = _log_likelihood(a, u, v, more, less, same) > _log_likelihood(b, u, v, more, less, same)
        lo, hi = np.where(left, lo, a), np.where(left, b, hi)
    best = (lo + hi) / 2
    at = np.minimum(threshold, most)
    doubt = _log_likelihood(best, u, v, more, less, same) - _log_likelihood(at, u, v, more, less, same)
    return best, (best >= threshold) | (doubt <= DOUBT)


def _runs(at: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)


def _sketch(k: int):
    def run(batches):
        for b in batches:
            ids, text = b.column("doc_id"), b.column("text")
            for a, z in slices(text):
                n = z - a
                sets, at = shingle_sets(text.slice(a, n), k)
                starts = _runs(at)
                rows = at[starts]
                size, d1, d2 = (np.zeros(n, dtype=np.int64) for _ in range(3))
                regs = [None] * n
                if len(starts):
                    size[rows] = np.diff(np.append(starts, len(sets)))
                    d1[rows], d2[rows] = set_digests(sets, starts)
                    for r, x in zip(rows.tolist(), registers(sets, starts)):
                        regs[r] = x.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, n), pa.array(size), pa.array(d1), pa.array(d2), pa.array(regs, pa.binary())],
                    ["doc_id", "n", "d1", "d2", "regs"],
                )

    return run


def _bands(batches):
    for b in batches:
        n = b.num_rows
        regs = np.frombuffer(b"".join(b.column("regs").to_pylist()), dtype=np.uint16).reshape(n, BANDS, ROWS)
        key = np.broadcast_to(_BAND, (n, BANDS)).copy()
        for r in range(ROWS):
            key = mix(key + regs[:, :, r].astype(np.uint64))
        take = pa.array(np.repeat(np.arange(n), BANDS))
        cols = [b.column(c).take(take) for c in ("id", "d1", "n")]
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), *cols], ["bucket", "id", "d1", "n"])


def _likely(threshold: float):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                for c in ("regs", "y_regs")
            )
            nx, ny = (b.column(c).to_numpy().astype(np.float64) for c in ("n", "y_n"))
            _, ok = may_reach(x, y, nx, ny, threshold)
            yield b.filter(pa.array(ok)).select(["id", "d1", "y", "y_d1"])

    return run


def _set_pairs(batch, k: int):
    """(row, set, other set) of each pair of texts whose digests are as expected;
    a repeated id may have other texts."""
    sides = []
    for text, digest in (("text", "d1"), ("y_text", "y_d1")):
        sets, at = shingle_sets(batch.column(text), k)
        starts = _runs(at)
        own = np.zeros(batch.num_rows, dtype=np.int64)
        if len(starts):
            own[at[starts]] = set_digests(sets, starts)[0]
        sides.append((sets, np.searchsorted(at, np.arange(batch.num_rows + 1)), own == batch.column(digest).to_numpy()))
    (s, se, sok), (t, te, tok) = sides
    for i in np.flatnonzero(sok & tok).tolist():
        yield i, s[se[i] : se[i + 1]], t[te[i] : te[i + 1]]


def _verify(k: int, percent: int):
    def run(batches):
        for b in batches:
            for a, z in slices(b.column("text"), 2 << 20):
                part = b.slice(a, z - a)
                keep = np.zeros(part.num_rows, dtype=bool)
                for i, p, q in _set_pairs(part, k):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(p) + len(q) - both)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").filter(pa.array(keep)), part.column("y").filter(pa.array(keep))], ["a", "b"]
                )

    return run


def _differences(k: int):
    def run(batches):
        for b in batches:
            for a, z in slices(b.column("text"), 2 << 20):
                part = b.slice(a, z - a)
                found = [(i, len(p), np.setxor1d(p, q, assume_unique=True).view(np.int64)) for i, p, q in _set_pairs(part, k)]
                at = pa.array([i for i, _, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(at) for c in GROUPED),
                        pa.array([n for _, n, _ in found], pa.int64()),
                        pa.array([d for _, _, d in found], pa.list_(pa.int64())),
                    ],
                    [*GROUPED, "n", "diff"],
                )

    return run


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``."""
    out = np.zeros(len(a) * len(b), dtype=np.int64)
    (ea, ra), (eb, rb) = ((np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (a, b))
    order = np.argsort(eb, kind="stable")
    eb, rb = eb[order], rb[order]
    low, high = np.searchsorted(eb, ea, "left"), np.searchsorted(eb, ea, "right")
    held = high - low
    ends = np.cumsum(held)
    at = 0
    while at < len(ea):  # a bounded number of meetings at a time
        done = ends[at - 1] if at else 0
        last = max(at + 1, int(np.searchsorted(ends, done + MEETINGS, "right")))
        n = held[at:last]
        first = np.repeat(low[at:last] - (ends[at:last] - n - done), n)
        places = first + np.arange(int(n.sum()))
        out += np.bincount(np.repeat(ra[at:last], n) * len(b) + rb[places], minlength=len(out))
        at = last
    return out.reshape(len(a), len(b))


def _tile(percent: int):
    def run(key, rows):
        left = rows[rows["minor"] & (rows["block"] == key[2])]
        right = left if key[3] == key[2] else rows[~(rows["minor"] & (rows["block"] == key[2]))]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        dx, dy = list(left["diff"]), list(right["diff"])
        both = overlaps(dx, dy)
        n = left["n"].to_numpy()[:, None] + right["n"].to_numpy()[None, :]
        apart = np.array([len(d) for d in dx])[:, None] + np.array([len(d) for d in dy])[None, :] - 2 * both
        common = (n - apart) // 2
        p, q = np.nonzero(100 * common >= percent * (n - common))
        ids = np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
        root = forest(len(ids), p, q + len(left))
        out = pd.DataFrame({"a": ids, "b": ids[root]})
        return out[out["a"] != out["b"]].drop_duplicates()

    return run


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return pairs.join(texts.select(F.col("doc_id").alias("id"), "text"), "id").join(
        texts.select(F.col("doc_id").alias("y"), F.col("text").alias("y_text")), "y"
    )


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (a, b) among ``pairs`` (id, d1, y, y_d1)."""
    x = reps.select("id", "d1", "n", "regs")
    y = reps.select(*(F.col(c).alias(f"y_{c}" if c != "id" else "y") for c in ("id", "d1", "n", "regs")))
    sized = (
        pairs.join(x, ["id", "d1"])
        .join(y, ["y", "y_d1"])
        .where(100 * F.least("n", "y_n") >= percent * F.greatest("n", "y_n"))
    )
    likely = sized.mapInArrow(_likely(percent / 100), "id long, d1 long, y long, y_d1 long")
    return _with_texts(likely, texts).mapInArrow(_verify(k, percent), "a long, b long").distinct()


def _links_in_groups(pairs: DataFrame, found: DataFrame, texts: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join components of ``found`` among members of one center's
    group; ``pairs`` are (id, d1, y, y_d1), y the center."""
    own = found.select(F.col("node").alias("id"), F.col("component").alias("own"))
    main = found.select(F.col("node").alias("y"), F.col("component").alias("main"))
    member = (
        pairs.join(own, "id", "left")
        .join(main, "y", "left")
        .select("id", "d1", "y", "y_d1", (F.coalesce("own", "id") != F.coalesce("main", "y")).alias("minor"))
    )
    group = ["y", "y_d1"]
    sizes = member.groupBy(*group).agg(F.count("*").alias("all"), F.count_if("minor").alias("minors"))
    # every pair between components has a member outside the center's component
    sizes = scratch.keep(
        sizes.where("minors > 0 AND all > 1").select(
            *group,
            F.ceil(F.col("minors") / BLOCK).cast("int").alias("minor_blocks"),
            F.ceil((F.col("all") - F.col("minors")) / BLOCK).cast("int").alias("major_blocks"),
        )
    )
    # the numbers of blocks go along, so that tiles are only dealt by their own key
    differing = scratch.keep(
        _with_texts(member.join(sizes, group), texts)
        .select(*GROUPED, "d1", "text", "y_text")
        .mapInArrow(
            _differences(k),
            "y long, y_d1 long, id long, minor boolean, minor_blocks int, major_blocks int, n long, diff array<long>",
        )
    )
    blocks = F.when(F.col("minor"), F.col("minor_blocks")).otherwise(F.col("major_blocks"))
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # tiles are (minor block, later minor block) and (minor block, -1 - major block)
    ups = F.expr("transform(sequence(0, minor_blocks - 1), j -> struct(least(block, j) AS i, greatest(block, j) AS j))")
    across = F.expr(
        "transform(slice(sequence(0, greatest(major_blocks, 1) - 1), 1, major_blocks), j -> struct(block AS i, -1 - j AS j))"
    )
    from_major = F.expr("transform(sequence(0, minor_blocks - 1), i -> struct(i AS i, -1 - block AS j))")
    tiles = (
        differing.withColumn("block", block)
        .withColumn("tile", F.explode(F.when(F.col("minor"), F.concat(ups, across)).otherwise(from_major)))
        .select(*group, F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), "id", "minor", "block", "n", "diff")
    )
    return tiles.groupBy(*group, "i", "j").applyInPandas(_tile(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``.

    Links are pairs of documents whose sets of ``k``-word shingles have
    100 * intersection >= ``percent`` * union."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.keep(docs.mapInArrow(_sketch(k), "doc_id long, n long, d1 long, d2 long, regs binary"))
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.keep(some.groupBy("d1", "d2").agg(F.min("doc_id").alias("id")))
    # joined on the id too, so that a class with many members is not one key
    reps = scratch.keep(
        some.join(classes.withColumnRenamed("id", "doc_id"), ["doc_id", "d1", "d2"])
        .select(F.col("doc_id").alias("id"), "d1", "d2", "n", "regs")
        .dropDuplicates(["id", "d1", "d2"])
        .drop("d2")
    )
    bands = reps.mapInArrow(_bands, "bucket long, id long, d1 long, n long")
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    shared = scratch.keep(bands.join(buckets, "bucket").select("bucket", "held", "id", "d1"))
    crowd = shared.groupBy("id", "d1").agg(F.sum("held").alias("crowd"))
    ranked = shared.join(crowd, ["id", "d1"]).groupBy("bucket").agg(F.max(F.struct("crowd", (-F.col("id")).alias("id"), "d1")).alias("top"))
    centers = ranked.select("bucket", (-F.col("top.id")).alias("y"), F.col("top.d1").alias("y_d1"))
    stars = scratch.keep(
        shared.join(centers, "bucket").where("id <> y OR d1 <> y_d1").select("id", "d1", "y", "y_d1").distinct()
    )
    texts = scratch.keep(docs.join(shared.select(F.col("id").alias("doc_id")).distinct(), "doc_id"))
    scratch.drop(shared)
    links = scratch.keep(_links(stars, reps, texts, k, percent))
    found = scratch.keep(components(links, scratch))
    more = scratch.keep(_links_in_groups(stars, found, texts, k, percent, scratch))
    scratch.drop(stars, texts, reps)
    member = some.select("doc_id", "d1", "d2").distinct().join(classes, ["d1", "d2"]).select("doc_id", "id")
    twice = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c")
    same = member.join(twice, "doc_id").select("a", F.col("id").alias("b"))
    final = scratch.keep(components(links.union(more).union(same), scratch))
    component = F.coalesce("component", "id", "doc_id")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (
        rows.select("doc_id", "n", "d1", "d2")
        .join(classes, ["d1", "d2"], "left")
        .join(final.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(linked, component).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(linked, F.col("doc_id") == component).otherwise(F.lit(True)).alias("kept"),
        )
    )


def op5_setsketch_near_dedup(spark, sf_dir: str, words: int = 4, percent: int = 80) -> DataFrame:
    """Near duplicates of ``documents`` on ``words``-word shingles at ``percent`` % similarity."""
    return near_duplicates(table(spark, sf_dir, "documents"), words, percent, Scratch(spark, "op5"))


#: The same rows in DuckDB; A-Z lower-cased, words split at 0x20 and 0x09-0x0D.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 3], chr(1))) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * x >= 80 * (na.n + nb.n - x)),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
