import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.common import documents
from tillroll.llm import sharding
from tillroll.llm.scratch import Scratch


def test_every_row_has_one_place_and_sizes_are_exact(spark):
    docs = documents(spark)
    rows = sharding.measured(docs)
    out = sharding.shuffle_into_shards(rows, 16, 4, Scratch(spark, "t")).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))


def test_empty_table(spark):
    assert sharding.shuffle_into_shards(sharding.measured(documents(spark, [])), 16, 4, Scratch(spark, "t")).collect() == []


def test_same_seed_same_places(spark):
    rows = spark.range(500).selectExpr("id AS doc_id").coalesce(3)
    a, b = (sharding.shuffle_into_shards(rows, 7, 9, Scratch(spark, "t")).collect() for _ in range(2))
    assert sorted(a) == sorted(b)


def test_matrix_sums_and_means():
    rng = np.random.Generator(np.random.PCG64(1))
    rows, sizes = [50, 0, 200, 7], [86, 86, 85]
    drawn = np.array([sharding.communication_matrix(rows, sizes, rng) for _ in range(2000)])
    assert (drawn.sum(2) == rows).all() and (drawn.sum(1) == sizes).all()
    assert np.allclose(drawn.mean(0), np.outer(rows, sizes) / sum(rows), atol=0.6)


@pytest.mark.parametrize("good,bad,n", [(3 * 10**9, 5 * 10**9, 40_000), (10**9, 2, 7), (2, 10**9, 10**9)])
def test_hypergeometric_beyond_numpy(good, bad, n):
    rng = np.random.Generator(np.random.PCG64(2))
    got = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(400)])
    mean = n * good / (good + bad)
    var = mean * bad / (good + bad) * (good + bad - n) / (good + bad - 1)
    assert (got >= max(0, n - bad)).all() and (got <= min(good, n)).all()
    assert abs(got.mean() - mean) <= 4 * (var / 400) ** 0.5 + 1e-9
    if var > 1:
        assert 0.75 < got.var() / var < 1.3
