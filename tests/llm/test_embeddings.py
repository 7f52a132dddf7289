import numpy as np
import pytest

from tests.llm.common import groups
from tillroll.llm import embeddings as E
from tillroll.llm.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, least string, many int"


def rows_of(seed=1, n=160, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim)
        if i % 3 and rows:  # near an earlier one
            v = np.array(rows[rng.integers(0, len(rows))][1]) + rng.standard_normal(dim) * 0.2 * rng.random()
        rows.append((i * 7 % 1009, [float(x) for x in v.astype(np.float32)], int(i % 2)))
    rows += [(5000 + i, rows[3][1], rows[3][2]) for i in range(20)]  # copies
    rows += [(6000, [2 * x for x in rows[3][1]], rows[3][2])]  # another length, the same direction
    rows += [(6001, None, 0), (6002, [0.0] * dim, 0), (6003, [float("nan")] + [1.0] * (dim - 1), 0)]
    rows += [(6004, [None] + [1.0] * (dim - 1), 0), (6005, rows[3][1], None), (6006, [1.0, 2.0], 0), (6007, [], 0)]
    rows += [(6008, [float("inf")] * dim, 0), rows[5], (rows[8][0], rows[9][1], rows[9][2])]  # repeated rows and ids
    return [(*r, 1, "l", 2) for r in rows]


def brute(rows, threshold):
    def usable(r):
        return r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])

    counts, links = [0] * len(rows), []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    counts[i] += 1
                    counts[j] += 1
                    links.append((a[0], b[0]))
    least = groups({r[0] for r in rows}, links)
    return sorted((r[0], c, least[r[0]], least[r[0]] == r[0]) for r, c in zip(rows, counts))


@pytest.mark.parametrize("block,threshold", [(4096, 0.98), (16, 0.98), (16, 0.9)])
def test_against_brute_force(spark, monkeypatch, block, threshold):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "TILE", 7)
    rows = rows_of()
    got = E.near_vectors(spark.createDataFrame(rows, SCHEMA), threshold, Scratch(spark, "t")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, threshold)


def test_empty_table_and_null_ids(spark):
    assert E.near_vectors(spark.createDataFrame([], SCHEMA), 0.98, Scratch(spark, "t")).collect() == []
    rows = [(None, [1.0, 0.0], 1, 1, "l", 2), (4, [1.0, 0.0], 1, 1, "l", 2), (9, [1.0, 0.0], 1, 1, "l", 2)]
    got = E.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.98, Scratch(spark, "t")).collect()
    assert sorted((tuple(r) for r in got), key=str) == [(4, 2, 4, True), (9, 2, 4, False), (None, 2, None, True)]


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for dim in (2, 64, 1200):
        x, y = rng.standard_normal((60, dim)) ** 3, rng.standard_normal((70, dim)) ** 3
        for threshold in (0.0, 0.1, 0.5):
            got = set(zip(*(i.tolist() for i in E.candidates(E.quantise(x), E.quantise(y), threshold))))
            p, q = (i.ravel() for i in np.meshgrid(np.arange(60), np.arange(70), indexing="ij"))
            hit = E.cosines(x[p], y[q]) >= threshold
            assert set(zip(p[hit].tolist(), q[hit].tolist())) <= got
