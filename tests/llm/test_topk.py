import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import topk as T
from tillroll.llm.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, chunk int, block string, id long, score double"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_force(rows, k, scale=64, every=20):
    """(query, rank, score, id) by every pair; None as id where equal scores and ids leave a choice."""
    known = sorted({(i, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v in rows if i is not None and usable(v)})
    out = []
    for i, q in known:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in known if len(v) == len(q) and (j, v) != (i, q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def top(spark, rows, k, parts=3, **settings):
    frame = spark.createDataFrame([(i, v, 1, 2, "x", 3, 0.5) for i, v in rows], SCHEMA).repartition(parts)
    got = T.top_vectors(frame, k, Scratch(spark, "t"), **settings).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def messy(seed=1, n=400, dim=6):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centers)]) for i in range(n)]
    rows += [(1000 + i, list(centers[0])) for i in range(120)]  # many copies, some of them queries
    rows += [(2000, [0.0] * dim), (2020, [-0.0] * dim), (2001, [1e9, *[0.0] * (dim - 1)])]
    rows += [(3000, None), (3020, []), (3021, []), (3040, [1.0, None, *[0.0] * (dim - 2)]), (3060, [float("nan")] * dim), (3080, [float("inf")] * dim)]
    rows += [(4000, [0.5, 0.25]), (4001, [0.5, 0.25]), (4002, [-0.5, 2.0]), (None, [1.0] * dim)]
    rows += [(40, rows[40][1]), (40, list(centers[1])), (60, [0.1] * dim)]  # repeated row, ids with two vectors
    return rows


@pytest.mark.parametrize("block,part,chunk,shard", [(256, 256, 4096, 4096), (16, 3, 5, 7)])
def test_equals_every_pair(spark, block, part, chunk, shard):
    rows = messy()
    assert top(spark, rows, 7, block=block, part=part, chunk=chunk, shard=shard) == brute_force(rows, 7)


def test_more_copies_than_k_and_few_rows(spark):
    rows = [(i, [0.5, -0.5]) for i in range(60)] + [(100, [3.0, -3.0])]
    assert top(spark, rows, 3, block=8) == brute_force(rows, 3)
    assert top(spark, rows[:2], 3) == [(0, 1, 1, 2048)]
    assert top(spark, rows[:1], 3) == []  # a query alone
    assert top(spark, [], 3) == []


def test_blocks_are_skipped_where_the_data_have_structure(monkeypatch):
    rng = np.random.default_rng(2)
    centers = rng.integers(-60, 60, (40, 16))
    blocks = []
    for n, c in enumerate(centers):
        x = (c + rng.integers(-2, 3, (50, 16))).astype(float)
        blocks.append((x, T.maxima(x), [[100 * n + i] for i in range(50)], np.arange(100 * n, 100 * n + 50)))
    queries = np.concatenate([b[0][:2] for b in blocks])
    scored = []
    monkeypatch.setattr(T, "products", lambda x, y, f=T.products: scored.append(len(x)) or f(x, y))
    best = T.search(queries, np.full(len(queries), -np.inf), blocks, 10)
    every = queries @ np.concatenate([b[0] for b in blocks]).T
    ids = np.concatenate([b[3] for b in blocks])
    for q, found in enumerate(best.found):
        assert [(-s, i) for s, i, _ in found] == sorted(((s, i) for s, i in zip(every[q].astype(int).tolist(), ids.tolist())), key=lambda x: (-x[0], x[1]))[:10]
    assert sum(scored) < 0.25 * len(queries) * len(blocks)


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_bounds_hold_and_products_are_exact(data):
    big = data.draw(st.sampled_from([5, 2**20, 2**28]))
    dim = data.draw(st.integers(0, 5))
    vectors = st.lists(st.lists(st.integers(-big, big), min_size=dim, max_size=dim), min_size=1, max_size=6)
    q, x = data.draw(vectors), data.draw(vectors)
    exact = [[sum(a * b for a, b in zip(u, v)) for v in x] for u in q]
    fq, fx = np.array(q, dtype=float).reshape(len(q), dim), np.array(x, dtype=float).reshape(len(x), dim)
    assert T.products(fq, fx).tolist() == exact
    limit = T.bounds(fq, T.maxima(fx)[None, :])
    assert all(limit[i, 0] >= max(row) for i, row in enumerate(exact))
    assert T.unpack(T.pack(fx), dim, len(x)).tolist() == fx.tolist()


def test_a_score_beyond_a_long_fails():
    with pytest.raises(OverflowError):
        T.products(np.full((1, 2), 2.0**40), np.full((1, 2), 2.0**40))
