import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import documents, messy_documents, words_of
from tillroll.llm import mixing as M
from tillroll.llm.scratch import Scratch


def deal(budget, children):
    """Shares by weight under capacities, in exact fractions: {name: share}."""
    share, left, open_ = {}, Fraction(budget), dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {n: c for n, (w, c) in open_.items() if c <= left * w / total}
        if not full:
            return share | {n: left * w / total for n, (w, _) in open_.items()}
        for n, c in full.items():
            share[n] = Fraction(c)
            left -= c
            del open_[n]
    return share


def domain(source):
    return f"d{int(hashlib.md5(source.encode()).hexdigest()[:2], 16) % 4}"


def weight(level, name):
    return M.WEIGHTS[level].get(name, 1)


@pytest.mark.parametrize("percent,epochs", [(80, 2), (100, 1), (150, 3), (10, 1)])
def test_budgets_and_prefixes(spark, percent, epochs):
    rows = messy_documents()
    got = M.mixture(documents(spark), Scratch(spark, "t"), percent, epochs).collect()
    tokens = defaultdict(int)
    for r in rows:
        tokens[domain(r[3] or ""), r[2] or "", r[3] or ""] += len(words_of(r[1]))
    cap = {leaf: n * epochs for leaf, n in tokens.items()}
    total = min(sum(tokens.values()) * percent // 100, sum(cap.values()))
    want = {(): Fraction(total)}
    for depth, level in enumerate(M.LEVELS, 1):
        for up in [k for k in want if len(k) == depth - 1]:
            names = {leaf[depth - 1] for leaf in cap if leaf[: depth - 1] == up}
            children = {n: (weight(level, n), sum(c for leaf, c in cap.items() if leaf[:depth] == (*up, n))) for n in names}
            want.update({(*up, n): s for n, s in deal(want[up], children).items()})
    taken, per = defaultdict(int), defaultdict(lambda: defaultdict(list))
    for r in got:
        taken[r.domain, r.lang, r.source] += r.taken
        per[r.domain, r.lang, r.source][r.epoch].append(r)
        assert 0 <= r.taken <= r.n_tokens
    assert sum(taken.values()) == total
    for leaf, n in tokens.items():
        assert abs(taken[leaf] - want[leaf]) <= 2 * len(tokens)
        whole = taken[leaf] // n if n else 0
        for epoch, chosen in per[leaf].items():
            if epoch <= whole:
                assert sum(r.taken for r in chosen) == n
        assert all(e <= whole + 1 for e in per[leaf])
        last = per[leaf].get(whole + 1, [])
        assert sum(r.taken < r.n_tokens for r in last) <= 1


def test_a_long_leaf_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN", 10)
    rows = [(i, "a b c", "en", "s") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = M.mixture(docs, Scratch(spark, "t"), 33, 2).collect()
    order = sorted(range(500), key=lambda i: hashlib.md5(f"11:1:{i}".encode()).hexdigest())
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((i, 3) for i in order[:165])


def test_empty_table_and_no_tokens(spark):
    assert M.mixture(documents(spark, []), Scratch(spark, "t")).collect() == []
    blank = spark.createDataFrame([(1, None, None, None), (2, " ", "en", "s")], "doc_id long, text string, lang string, source string")
    assert M.mixture(blank, Scratch(spark, "t")).collect() == []


def test_weights_must_be_positive(spark):
    with pytest.raises(ValueError):
        M.mixture(documents(spark), Scratch(spark, "t"), weights={"lang": {"en": 0}})


def test_no_python_in_the_plan(spark):
    plan = M.mixture(documents(spark), Scratch(spark, "t"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 1000), st.lists(st.tuples(st.integers(1, 9), st.integers(0, 300)), min_size=1, max_size=6))
def test_the_reference_deal_is_exact(budget, children):
    named = dict(enumerate(children))
    budget = min(budget, sum(c for _, c in children))
    out = deal(budget, named)
    assert sum(out.values()) == budget and all(out[n] <= named[n][1] for n in named)
