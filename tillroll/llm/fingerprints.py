"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into the phrases of an LZ78 dictionary; the set
of phrases is what a compressor learns from the text. Phrase hashes go into
``SLOTS`` bins by one permutation, the least of each bin is a slot of the
signature, empty bins take the next one's (Shrivastava and Li 2014), and each
slot keeps 16 bits. The share of equal slots estimates the Jaccard similarity of
two phrase sets, a similarity of what two texts compress alike.

The document after each one (descending id; after the last the first) is brought
next to it by one exchange of the texts: ids are dealt into runs, each run is
sorted in one task, and the last document of each run is also sent to the next.

Defined results: null text counts as empty; an empty text has the empty
fingerprint, likeness 1 to another empty one and 0 to any other; ids that are
null come last in descending order, rows that repeat an id stand in the order of
a digest of their text; a single row is its own next; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import bounded_batches, table
from tillroll.llm.texts import mix, span_hashes

SLOTS = 128
_SHIFT = np.uint64(57)  # the top 7 bits choose one of SLOTS bins
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _parse(data: bytes, node: dict, root: dict, at: int, ends: list[int], undo: list | None = None) -> dict:
    """Goes on with an LZ78 parse at ``node``; phrase ends are added to ``ends``."""
    add = ends.append
    for c in data:
        at += 1
        deeper = node.get(c)
        if deeper is None:
            node[c] = {}
            add(at)
            if undo is not None:
                undo.append((node, c))
            node = root
        else:
            node = deeper
    return node


def signature(data: bytes, ends: list[int]) -> np.ndarray | None:
    """Slots of a text given its phrase ends; None without phrases."""
    if not ends:
        return None
    stop = np.array(ends, dtype=np.int64)
    start = np.empty_like(stop)
    start[0], start[1:] = 0, stop[:-1]
    hashes = np.sort(span_hashes(np.frombuffer(data, dtype=np.uint8), start, stop))
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    held, least = bins[first], hashes[first]
    every = np.arange(SLOTS)
    place = np.searchsorted(held, every)
    around = place == len(held)  # past the last one held: from the start again
    place[around] = 0
    away = (held[place] + SLOTS * around - every).astype(np.uint64)
    return (mix(least[place] + away * _STEP) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return 1.0 if a is b else 0.0
    return float((a == b).mean())


def _hex(sig: np.ndarray | None) -> str:
    return "" if sig is None else sig.astype(">u2").tobytes().hex()


def fingerprint(text: str) -> np.ndarray | None:
    data, ends, root = text.encode("utf-8"), [], {}
    _parse(data, root, root, 0, ends)
    return signature(data, ends)


def edited_pair(text: str, after: str) -> tuple[str, np.ndarray | None, np.ndarray | None]:
    """The edited text and the signatures of the text and of the edited one;
    their common start is parsed once."""
    half = len(text) // 2
    start, rest, new = (x.encode("utf-8") for x in (text[: len(text) - half], text[len(text) - half :], after[:half]))
    root: dict = {}
    ends: list[int] = []
    node = _parse(start, root, root, 0, ends)
    common, undo = len(ends), []
    _parse(rest, node, root, len(start), ends, undo)
    own = signature(start + rest, ends)
    for d, c in undo:
        del d[c]
    del ends[common:]
    _parse(new, node, root, len(start), ends)
    edited = start + new
    return edited, own, signature(edited, ends)


def _run(batches):
    """Rows come sorted by (run, context first, ascending id): the row before is the next document."""
    run, before, before_sig = None, "", None
    for b in batches:
        out = [[], [], [], [], [], [], []]
        for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_run", "_own"))):
            doc, text, at, own = row
            text = text or ""
            if not own:
                run, before, before_sig = at, text, None
                continue
            if at != run:
                raise ValueError("a run without the document before it")
            edited, sig, edited_sig = edited_pair(text, before)
            if before_sig is None:
                before_sig = (fingerprint(before),)
            values = (
                doc, len(text), hashlib.sha256(edited).hexdigest(), _hex(sig), _hex(edited_sig),
                likeness(sig, edited_sig), likeness(sig, before_sig[0]),
            )
            for o, v in zip(out, values):
                o.append(v)
            before, before_sig = text, (sig,)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], COLUMNS)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _run_of(bounds: list[int]):
    """Number of ``bounds`` (sorted) at or below the id, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.lit([p[0] for p in parts])
    lists = F.array(*(F.lit(p) for p in parts))
    coarse = F.greatest(F.size(F.filter(heads, lambda x: x <= F.col("doc_id"))), F.lit(1))
    fine = F.size(F.filter(F.element_at(lists, coarse), lambda x: x <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise((coarse - 1) * step + fine)


def next_to(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in sorted runs, each led by the document before its first (``_own`` false)."""
    spark = docs.sparkSession
    runs = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / runs for i in range(1, runs)]
    cuts = docs.agg(F.percentile_approx("doc_id", F.lit(shares), F.lit(10 * runs)).alias("c")).first()["c"]
    keyed = docs.select("doc_id", "text", _run_of(sorted(set(cuts or []))).alias("_run"), F.xxhash64("text").alias("_hash"))
    # one row a run comes to the driver: its last place
    tops = keyed.groupBy("_run").agg(F.max(F.struct("doc_id", "_hash")).alias("top")).orderBy("_run").collect()
    if not tops:
        return keyed.withColumn("_own", F.lit(True))
    after = {t["_run"]: tops[(i + 1) % len(tops)]["_run"] for i, t in enumerate(tops)}
    lasts = spark.createDataFrame(
        [(t["_run"], t["top"]["doc_id"], t["top"]["_hash"], after[t["_run"]]) for t in tops],
        "_run int, _top long, _top_hash long, _after int",
    )
    last = F.col("doc_id").eqNullSafe(F.col("_top")) & (F.col("_hash") == F.col("_top_hash"))
    targets = F.when(last, F.array(F.col("_run"), -1 - F.col("_after"))).otherwise(F.array(F.col("_run")))
    return (
        keyed.join(F.broadcast(lasts), "_run")  # a row for each of ``runs`` runs
        .withColumn("_to", F.explode(targets))
        .select(
            "doc_id",
            "text",
            F.when(F.col("_to") < 0, -1 - F.col("_to")).otherwise(F.col("_to")).alias("_run"),
            (F.col("_to") >= 0).alias("_own"),
            "_hash",
        )
        .repartition("_run")
        .sortWithinPartitions("_run", "_own", F.col("doc_id").asc_nulls_first(), "_hash")
    )


def op3_lempel_ziv_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and of its edited text."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return next_to(docs).select("doc_id", "text", "_run", "_own").mapInArrow(_run, SCHEMA)
