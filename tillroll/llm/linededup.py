"""Reversible line dedup: cuckoo filters per shard over exact reference counts.

State is two written tables. ``counts`` holds for each line key (the 128-bit
digest of the stripped, A-Z-lower-cased line) in how many documents it occurs;
it is the truth. ``filters`` holds one cuckoo filter for each shard of the key
space with the keys that have reached ``min_docs``; a filter admits insertion
and deletion, so adding or removing documents touches only the keys whose count
crosses the threshold. Deleting what was inserted gives back the state from
before, exactly.

Dedup probes each document's keys against its shard's filter and confirms the
hits in the exact counts: a filter's false positives never drop a line. Shards
are sized by the count of frequent keys and probed in salted groups of bounded
size, so a key that a third of all documents share costs no task more than the
others.

Defined results: a row of the input is one document (repeated rows and ids count
once each); null text is one empty line; the empty key is never dropped; a
document that loses every line keeps an empty text; an empty table gives no
rows; columns other than doc_id and text pass through untouched in
``dedup_lines`` whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table, unused

#: Characters that are stripped from both ends of a line.
STRIP = b" \t\n\x0b\x0c\r"
#: Frequent keys a filter holds at most, about; bytes of a filter: 2 a slot.
SHARD_KEYS = 50_000
#: Keys probed in one task at a time.
PROBE_ROWS = 200_000
SLOTS = 4
LOAD = 0.84
KICKS = 500

KEYS = "k1 long, k2 long"


def line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text and their keys, as UTF-8."""
    lines = (text or "").encode("utf-8").split(b"\n")
    return lines, [x.strip(STRIP).lower() for x in lines]


def digest(key: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; two buckets a key, by partial-key hashing."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        self.buckets = buckets  # a power of two
        self.slots = (
            np.zeros((buckets, SLOTS), dtype=np.uint16)
            if slots is None
            else np.frombuffer(slots, dtype=np.uint16).reshape(buckets, SLOTS).copy()
        )
        self.kick = 0

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        return cls(1 << max(1, math.ceil(math.log2(max(1, keys) / (SLOTS * LOAD)))))

    def _places(self, k1, k2):
        k1, k2 = np.asarray(k1, dtype=np.int64).view(np.uint64), np.asarray(k2, dtype=np.int64).view(np.uint64)
        mark = (k2 & np.uint64(0xFFFF)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        first = (k1 & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, first ^ self._jump(mark)

    def _jump(self, mark):
        hashed = (np.asarray(mark).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return (hashed & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, k1, k2) -> np.ndarray:
        mark, first, second = self._places(k1, k2)
        return (self.slots[first] == mark[:, None]).any(1) | (self.slots[second] == mark[:, None]).any(1)

    def insert(self, k1: int, k2: int) -> bool:
        """False if no place was found; the filter must then be built larger."""
        mark, first, second = (x[0] for x in self._places([k1], [k2]))
        for at in (first, second):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return True
        at = first
        for _ in range(KICKS):
            self.kick += 1
            slot = self.kick % SLOTS
            mark, self.slots[at, slot] = self.slots[at, slot], mark
            at = at ^ int(self._jump(mark))
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return True
        return False

    def delete(self, k1: int, k2: int) -> bool:
        mark, first, second = (x[0] for x in self._places([k1], [k2]))
        for at in (first, second):
            held = np.flatnonzero(self.slots[at] == mark)
            if len(held):
                self.slots[at, held[0]] = 0
                return True
        return False

    @classmethod
    def of(cls, keys) -> "CuckooFilter":
        """A filter of all (k1, k2); grows until every key has a place."""
        keys = list(keys)
        made = cls.sized(len(keys))
        while not all(made.insert(*k) for k in keys):
            made = cls(made.buckets * 2)
        return made


FILTERS = "shard int, buckets int, slots binary"


def _document_keys(batches):
    """(k1, k2, _row) of each document's distinct non-empty keys."""
    for b in batches:
        k1, k2, rows = [], [], []
        for text, row in zip(b.column("text").to_pylist(), b.column("_row").to_pylist()):
            for key in set(line_keys(text)[1]):
                if key:
                    a, c = digest(key)
                    k1.append(a)
                    k2.append(c)
                    rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, rows)], ["k1", "k2", "_row"])


def row_keys(docs: DataFrame) -> DataFrame:
    """(k1, k2, _row): the distinct line keys of each document.

    ``_row`` digests id and text: equal rows get equal numbers, and are decided alike."""
    return docs.select(row_number_of(), "text").mapInArrow(_document_keys, f"{KEYS}, _row long")


def row_number_of():
    return F.xxhash64(F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("_row")


class LineIndex:
    """Reference counts and filters of a corpus; every change gives a new index."""

    def __init__(self, counts: DataFrame, filters: DataFrame, shards: int, min_docs: int, scratch: Scratch):
        self.counts, self.filters, self.shards, self.min_docs, self.scratch = counts, filters, shards, min_docs, scratch

    @staticmethod
    def shard_of(shards: int):
        return F.pmod(F.shiftrightunsigned("k1", 32), F.lit(shards)).cast("int").alias("shard")

    @classmethod
    def build(cls, keys: DataFrame, min_docs: int, scratch: Scratch) -> "LineIndex":
        """The index of the documents whose keys (``row_keys``) are given."""
        return cls.of_counts(scratch.keep(keys.groupBy("k1", "k2").agg(F.count("*").alias("docs"))), min_docs, scratch)

    @classmethod
    def of_counts(cls, counts: DataFrame, min_docs: int, scratch: Scratch) -> "LineIndex":
        frequent = counts.where(F.col("docs") >= min_docs)
        shards = max(1, math.ceil(frequent.count() / SHARD_KEYS))

        def fill(key, rows):
            made = CuckooFilter.of(sorted(zip(rows["k1"], rows["k2"])))
            return pd.DataFrame([(key[0], made.buckets, made.slots.tobytes())], columns=["shard", "buckets", "slots"])

        sharded = frequent.select(cls.shard_of(shards), "k1", "k2")
        filters = scratch.keep(sharded.groupBy("shard").applyInPandas(fill, FILTERS))
        return cls(counts, filters, shards, min_docs, scratch)

    def changed(self, keys: DataFrame, sign: int) -> "LineIndex":
        """The index after the documents of ``keys`` are inserted (1) or deleted (-1)."""
        delta = keys.groupBy("k1", "k2").agg((F.count("*") * sign).alias("delta"))
        both = self.scratch.keep(
            self.counts.join(delta, ["k1", "k2"], "full").select(
                "k1",
                "k2",
                F.coalesce("docs", F.lit(0)).alias("before"),
                (F.coalesce("docs", F.lit(0)) + F.coalesce("delta", F.lit(0))).alias("docs"),
            )
        )
        if both.where("docs < 0").limit(1).count():
            raise ValueError("a document is deleted that was never inserted")
        least = self.min_docs
        crossed = both.where((F.col("before") >= least) != (F.col("docs") >= least)).select(
            self.shard_of(self.shards), "k1", "k2", (F.col("docs") >= least).alias("enters")
        )

        def update(key, held, rows):
            made = CuckooFilter(int(held["buckets"][0]), held["slots"][0]) if len(held) else CuckooFilter.sized(len(rows))
            for k1, k2 in rows.loc[~rows["enters"], ["k1", "k2"]].itertuples(index=False):
                made.delete(k1, k2)
            full = not all(
                made.insert(k1, k2) for k1, k2 in rows.loc[rows["enters"], ["k1", "k2"]].itertuples(index=False)
            )
            out = (key[0], 0 if full else made.buckets, b"" if full else made.slots.tobytes())
            return pd.DataFrame([out], columns=["shard", "buckets", "slots"])

        filters = self.scratch.keep(
            self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, FILTERS)
        )
        counts = self.scratch.keep(both.where("docs > 0").select("k1", "k2", "docs"))
        if filters.where("buckets = 0").limit(1).count():  # a filter is full: build all anew from the exact counts
            return LineIndex.of_counts(counts, self.min_docs, self.scratch)
        return LineIndex(counts, filters, self.shards, self.min_docs, self.scratch)

    def insert(self, docs: DataFrame) -> "LineIndex":
        return self.changed(row_keys(docs), 1)

    def delete(self, docs: DataFrame) -> "LineIndex":
        return self.changed(row_keys(docs), -1)

    def frequent(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` whose key is in ``min_docs`` documents or more: the
        filters say which may be, the exact counts which are."""
        sharded = keys.select(self.shard_of(self.shards), "k1", "k2", "_row")
        sizes = sharded.groupBy("shard").agg(F.count("*").alias("n"))
        # one row a shard of SHARD_KEYS frequent keys: 10**10 such keys make 200,000 rows, 3 MB
        salts = F.broadcast(sizes.select("shard", F.ceil(F.col("n") / PROBE_ROWS).cast("int").alias("salts")))
        probes = sharded.join(salts, "shard").select(
            "shard", F.pmod(F.xxhash64("k2", "_row"), F.col("salts")).cast("int").alias("salt"), "k1", "k2", "_row"
        )
        spread = self.filters.join(salts, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "buckets", "slots"
        )

        def probe(_, rows, held):
            if not len(held) or not len(rows):
                return rows[["k1", "k2", "_row"]].iloc[:0]
            made = CuckooFilter(int(held["buckets"][0]), held["slots"][0])
            return rows.loc[made.contains(rows["k1"].to_numpy(), rows["k2"].to_numpy()), ["k1", "k2", "_row"]]

        hits = (
            probes.groupBy("shard", "salt").cogroup(spread.groupBy("shard", "salt")).applyInPandas(probe, f"{KEYS}, _row long")
        )
        exact = self.counts.where(F.col("docs") >= self.min_docs).select("k1", "k2")
        return hits.join(exact, ["k1", "k2"])


def _kept(text_name: str, drops_name: str, names: list[str]):
    """Replaces the texts and the digests to drop by the kept text and line counts."""

    def run(batches):
        for b in batches:
            texts, total, gone = [], [], []
            for text, drops in zip(b.column(text_name).to_pylist(), b.column(drops_name).to_pylist()):
                lines, keys = line_keys(text)
                total.append(len(lines))
                if drops:
                    gone_keys = {(d["k1"], d["k2"]) for d in drops}
                    known: dict[bytes, bool] = {}
                    keep = []
                    for line, key in zip(lines, keys):
                        drop = known.get(key)
                        if drop is None:
                            drop = known[key] = bool(key) and digest(key) in gone_keys
                        if not drop:
                            keep.append(line)
                    texts.append(b"\n".join(keep).decode("utf-8"))
                    gone.append(len(lines) - len(keep))
                else:
                    texts.append(text)
                    gone.append(0)
            rest = [n for n in b.schema.names if n not in (text_name, drops_name)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in rest), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                [*rest, *names],
            )

    return run


def dedup_lines(docs: DataFrame, min_docs: int, scratch: Scratch, names=("_kept", "_lines", "_dropped")) -> DataFrame:
    """``docs`` (with all columns but text) and, under ``names``, the text without
    dropped lines (null stays null) and the numbers of lines and of dropped ones.
    ``names`` must not be columns of ``docs``; other names never clash."""
    if set(map(str.lower, names)) & set(map(str.lower, docs.columns)):
        raise ValueError(f"columns of the documents are named like results: {names}")
    row, drops_name = unused([*docs.columns, *names], "_row", "_drops")
    keys = scratch.keep(row_keys(docs))
    index = LineIndex.build(keys, min_docs, scratch)
    drops = scratch.keep(
        index.frequent(keys).distinct().groupBy("_row").agg(F.collect_set(F.struct("k1", "k2")).alias(drops_name))
    ).withColumnRenamed("_row", row)
    joined = docs.withColumn(row, row_number_of()).join(drops, row, "left").drop(row)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    added = [f"`{n}` {t}" for n, t in zip(names, ("string", "long", "long"))]
    scratch.drop(keys, index.counts, index.filters)
    return joined.mapInArrow(_kept("text", drops_name, list(names)), ", ".join([*fields, *added]))


def op4_cuckoo_line_dedup(spark, sf_dir: str, min_docs: int = 10) -> DataFrame:
    """Lines of ``documents`` that are in ``min_docs`` documents or more, dropped everywhere."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = dedup_lines(docs, min_docs, Scratch(spark, "op4"))
    return out.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("_kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


#: The same rows in DuckDB. A code point outside A-Z is not lower-cased.
OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
f AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT l.doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY l.doc_id
"""
