import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import SPACE, documents, fold, messy_documents
from tillroll.llm import linededup as L
from tillroll.llm.scratch import Scratch


def brute(rows, least):
    docs = [(r[0], r[1] or "") for r in rows]
    held = {}
    for i, (_, t) in enumerate(docs):
        for line in t.split("\n"):
            held.setdefault(fold(line.strip(SPACE)), set()).add(i)
    out = []
    for d, t in docs:
        lines = t.split("\n")
        kept = [x for x in lines if not fold(x.strip(SPACE)) or len(held[fold(x.strip(SPACE))]) < least]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("least", [1, 2, 10])
def test_against_brute_force(spark, least):
    out = L.dedup_lines(documents(spark), least, Scratch(spark, "t"))
    got = sorted((r.doc_id, r._kept or "", r._lines, r._dropped) for r in out.collect())
    assert got == brute(messy_documents(), least)
    assert {"kept", "shard", "k1", "x"} <= set(out.columns)


def test_empty_table(spark):
    assert L.dedup_lines(documents(spark, []), 10, Scratch(spark, "t")).collect() == []


def test_inserts_and_deletes_are_reversible(spark):
    scratch = Scratch(spark, "t")
    docs = documents(spark)
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    start = L.LineIndex.build(L.row_keys(first), 4, scratch)
    both = start.insert(second)
    back = both.delete(second)
    table = lambda i: sorted(i.counts.select("k1", "k2", "docs").collect())
    assert table(back) == table(start)
    assert table(both) == table(L.LineIndex.build(L.row_keys(docs), 4, scratch))
    keys = L.row_keys(docs).cache()
    hits = lambda i: sorted(i.frequent(keys).collect())
    assert hits(back) == hits(start)
    assert hits(both) == hits(L.LineIndex.build(L.row_keys(docs), 4, scratch))
    assert len(hits(both)) > len(hits(start))
    with pytest.raises(ValueError):
        start.delete(second)


def test_a_hot_key_is_probed_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(L, "PROBE_ROWS", 50)
    rows = [(i, f"the same line\nown {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = L.dedup_lines(docs, 10, Scratch(spark, "t"))
    assert out.where(F.col("_dropped") != 1).count() == 0
    assert {r._kept for r in out.collect()} == {f"own {i}" for i in range(400)}


def test_cuckoo_filter():
    rng = random.Random(3)
    keys = [(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63) for _ in range(20_000)]
    made = L.CuckooFilter.of(keys)
    k = np.array(keys)
    assert made.contains(k[:, 0], k[:, 1]).all()
    other = np.array([(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63) for _ in range(20_000)])
    assert made.contains(other[:, 0], other[:, 1]).mean() < 0.001
    again = L.CuckooFilter(made.buckets, made.slots.tobytes())
    for a, b in keys[:10_000]:
        assert again.delete(a, b)
    assert again.contains(k[10_000:, 0], k[10_000:, 1]).all()
    assert again.contains(k[:10_000, 0], k[:10_000, 1]).mean() < 0.01


def test_query_digest(spark):
    text = "a\nb"
    docs = spark.createDataFrame([(i, text if i else None) for i in range(12)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.dedup_lines(docs, 10, Scratch(spark, "t")).collect()}
    assert got[0]._kept is None and got[0]._lines == 1 and got[1]._kept == "" and got[1]._dropped == 2
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
