import random

import numpy as np
import pytest

from tests.llm.common import documents, groups, messy_documents, words_of
from tillroll.llm import setsketch as S
from tillroll.llm.scratch import Scratch


def sets_of(rows, k):
    out = []
    for r in rows:
        w = words_of(r[1])
        out.append((r[0], {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}))
    return out


def brute(rows, k, percent):
    sets = sets_of(rows, k)
    links = [
        (a, b)
        for i, (a, s) in enumerate(sets)
        for b, t in sets[:i]
        if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    least = groups({a for a, _ in sets if a is not None}, links)
    return sorted((a, len(s), least[a], a == least[a]) for a, s in sets)


@pytest.mark.parametrize("k", [4, 5])
def test_against_brute_force(spark, k):
    got = S.near_duplicates(documents(spark), k, 80, Scratch(spark, "t")).collect()
    assert sorted(tuple(r) for r in got) == brute(messy_documents(), k, 80)


def test_empty_table(spark):
    assert S.near_duplicates(documents(spark, []), 4, 80, Scratch(spark, "t")).collect() == []


def test_chains_of_links_and_repeated_ids(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = []
    words = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(12):  # each links to the next, not to those further on
        rows.append((100 - i, " ".join(words)))
        for j in rng.sample(range(120), 3):
            words[j] = rng.choice(vocabulary)
    rows += [(500 + i, " ".join(rng.choice(vocabulary) for _ in range(80))) for i in range(30)]
    rows += [(95, rows[-1][1]), (None, rows[0][1]), (None, None)]  # 95 has two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.near_duplicates(docs, 4, 80, Scratch(spark, "t")).collect()
    known = [r for r in got if r.doc_id is not None]
    assert sorted(tuple(r) for r in known) == brute([r for r in rows if r[0] is not None], 4, 80)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(5000)]
    words = [rng.choice(vocabulary) for _ in range(100)]
    rows = []
    for i in range(300):
        own = list(words)
        own[rng.randrange(100)] = f"own{i}"
        rows.append((1000 + i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.near_duplicates(docs, 4, 80, Scratch(spark, "t")).collect()
    assert {r.component_id for r in got} == {1000} and sum(r.kept for r in got) == 1


def _random_sets(rng, n, j):
    both = round(2 * n * j / (1 + j))
    pool = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
    return pool[:n], pool[n - both :]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(7)
    for j in (0.3, 0.8, 0.95):
        estimates, kept = [], []
        for _ in range(60):
            a, b = _random_sets(rng, 400, j)
            ra, rb = (S.registers(x, np.array([0]))[0] for x in (a, b))
            union = S.registers(np.union1d(a, b), np.array([0]))[0]
            assert (S.merged(ra, rb) == union).all()
            best, may = S.may_reach(ra[None], rb[None], np.array([400.0]), np.array([400.0]), 0.8)
            estimates.append(best[0])
            kept.append(may[0])
        assert abs(np.mean(estimates) - j) < 0.03
        assert all(kept) if j >= 0.8 else not any(kept)
