"""The pipeline stage by stage against brute force on a small fixture, and run() as a whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm import test_linededup, test_packing, test_setsketch
from tests.llm.common import SCHEMA, documents, messy_documents, words_of
from tests.llm.test_cotraining import corpus
from tillroll.llm.scratch import Scratch


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    rows, labels = corpus(500)
    mess = [(10_000 + r[0], *r[1:]) for r in messy_documents()]
    documents(spark, rows + mess).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def key(rows):
    return sorted((str(r.asDict()) for r in rows))


def test_stages(spark, sf_dir):
    docs, scratch, frames = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "t"), []
    for name, stage in P.STAGES:
        frames.append((docs, scratch.keep(stage(spark, docs, sf_dir))))
        docs = frames[-1][1]
    assert all(after.schema.simpleString() == before.schema.simpleString() for before, after in frames[:-1])

    before, after = (f.collect() for f in frames[0])  # quality: rejects junk, keeps rows as they are
    assert set(key(after)) < set(key(before))
    bad = dict(corpus(500)[1])
    kept = {r.doc_id for r in after}
    assert sum(i in kept for i, good in bad.items() if good) > 0.99 * sum(bad.values())
    assert sum(i in kept for i, good in bad.items() if not good) < 0.02 * len(bad)

    before, after = (f.collect() for f in frames[1])  # line dedup
    want = test_linededup.brute([(r.doc_id, r.text) for r in before], P.MIN_DOCS)
    assert sorted((r.doc_id, r.text or "") for r in after) == sorted((d, t) for d, t, _, _ in want)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)

    before, after = (f.collect() for f in frames[2])  # near-dedup: one document of each group
    want = test_setsketch.brute([(r.doc_id, r.text) for r in before], P.WORDS, P.PERCENT)
    assert sorted(r.doc_id for r in after) == sorted({d for d, _, _, k in want if k})

    before, after = (f.collect() for f in frames[3])  # mixing: whole documents, the budget but for the last of each leaf
    assert set(key(after)) <= set(key(before)) and len(set(key(after))) == len(after)
    tokens = lambda rows: sum(len(words_of(r.text)) for r in rows)
    budget = tokens(before) * P.MIX_PERCENT // 100
    leaves = len({(r.lang, r.source) for r in before})
    longest = max(len(words_of(r.text)) for r in before)
    assert budget <= tokens(after) <= budget + leaves * longest

    before, after = (f.collect() for f in frames[4])  # packing
    lengths = {}
    for r in after:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {r.doc_id: len(test_packing.ids_of(r.text)) + 1 for r in before}


def test_run(spark, sf_dir):
    out = P.run(spark, sf_dir).collect()
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    assert out and all(sum(r.length for r in s) <= P.TOKENS for s in sequences.values())


def test_extra_columns_named_like_internal_ones(spark, sf_dir):
    names = ["_row", "_kept", "_DROPS", "_dropped", "_lines", "_gone", "_nth", "_chosen", "__kept", "m"]
    messy = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    extra = [F.lit(f"v{i}").alias(n) for i, n in enumerate(names[:-1])] + [F.create_map(F.lit("k"), F.col("doc_id")).alias("m")]
    plain, clashing = messy, messy.select("*", *extra)
    for _, stage in P.STAGES[1:4]:
        scratch = Scratch(spark, "t")
        after, want = scratch.keep(stage(spark, clashing, sf_dir)), scratch.keep(stage(spark, plain, sf_dir))
        assert after.columns == clashing.columns
        assert key(after.select(*want.columns).collect()) == key(want.collect())
        for r in after.collect():
            assert [r[n] for n in names[:-1]] == [f"v{i}" for i in range(len(names) - 1)] and r["m"] == {"k": r["doc_id"]}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
