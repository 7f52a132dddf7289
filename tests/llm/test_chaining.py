import random

import numpy as np
import pyarrow as pa

from tests.llm.common import documents, messy_documents, words_of
from tillroll.llm import chaining as C
from tillroll.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, words int, start string, other int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéfü") for _ in range(rng.randint(3, 8))) for _ in range(n))


def found(spark, rows):
    return C.shared_passages(spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA), Scratch(spark, "t")).collect()


def test_planted_passages_are_found_whole(spark):
    rng = random.Random(4)
    passages = [prose(rng, n) for n in (51, 60, 90, 300)]
    rows, holders = [], {p: [] for p in passages}
    for i in range(60):
        parts = [prose(rng, rng.randint(5, 150))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            parts += [p, prose(rng, rng.randint(5, 150))]
            holders[p].append(i * 5)
        rows.append((i * 5, " ".join(parts)))
    texts = dict(rows)
    got = found(spark, rows)
    for p, held in holders.items():
        pairs = {(r.doc_id, r.other_id) for r in got if texts[r.doc_id][r.start : r.end] == p == texts[r.other_id][r.other_start : r.other_end]}
        assert pairs == {(d, min(held)) for d in held if d != min(held)}
    assert all(texts[r.doc_id][r.start : r.end] in passages for r in got)
    assert all(r.identity == 1 and r.words == r.matched for r in got)


def test_fuzzy_passages(spark):
    rng = random.Random(5)
    passage = prose(rng, 80).split()
    rows = [(0, prose(rng, 30) + " " + " ".join(passage) + " " + prose(rng, 30))]
    for i in range(1, 40):
        own = list(passage)
        for j in rng.sample(range(80), 4):
            own[j : j + 1] = rng.choice([["new"], [], [own[j], "more"]])
        rows.append((i, prose(rng, 30) + " " + " ".join(own) + " " + prose(rng, 30)))
    rows += [(100 + i, prose(rng, 140)) for i in range(40)]
    got = found(spark, rows)
    assert len({r.doc_id for r in got}) >= 37 and all(r.doc_id < 100 for r in got)
    assert all(r.identity >= C.MIN_IDENTITY and r.words >= C.MIN_WORDS for r in got)


def test_a_weak_chain_is_cut_into_its_passages(spark):
    rng = random.Random(11)
    rows, planted = [], set()
    for i, (words, between) in enumerate([(60, 100), (50, 40), (50, 200), (100, 100)]):
        one, two = prose(rng, words), prose(rng, words)
        for doc in (2 * i, 2 * i + 1):
            rows.append((doc, " ".join([prose(rng, 30), one, prose(rng, between + doc % 2), two, prose(rng, 30)])))
        planted |= {(2 * i + 1, one), (2 * i + 1, two)}
    texts = dict(rows)
    got = found(spark, rows)
    assert {(r.doc_id, texts[r.doc_id][r.start : r.end]) for r in got} == planted and len(got) == len(planted)
    assert all(texts[r.other_id][r.other_start : r.other_end] == texts[r.doc_id][r.start : r.end] for r in got)


def test_a_passage_whose_parts_have_other_least_holders(spark):
    rng = random.Random(13)
    rows, pairs = [], set()
    for i in range(0, 60, 10):
        passage = prose(rng, 76).split()
        # lower ids hold the halves, in the last groups twice, or parts that overlap
        cuts = [(0, 38), (38, 76)] if i < 30 else [(0, 38), (38, 76), (38, 76)] if i < 50 else [(0, 39), (37, 76)]
        parts = [passage[a:z] for a, z in cuts] + [passage, passage, passage]
        rows += [(i + j, " ".join([prose(rng, 30), *p, prose(rng, 30)])) for j, p in enumerate(parts)]
        n = len(cuts)
        pairs |= {(i + n + 1, i + n, " ".join(passage)), (i + n + 2, i + n, " ".join(passage))}
    texts = dict(rows)
    got = found(spark, rows)
    assert pairs <= {(r.doc_id, r.other_id, texts[r.doc_id][r.start : r.end]) for r in got}
    assert len({(r.doc_id, r.other_id, r.start, r.other_start) for r in got}) == len(got)


def test_copies_below_any_number_of_holders_of_their_parts(spark):
    rng = random.Random(16)
    rows, pairs = [], set()
    for base, holders in ((0, 6), (1000, C.FEW + 8)):  # below and above the holders that are paired themselves
        passage = prose(rng, 76).split()
        halves = [" ".join(passage[:38]), " ".join(passage[38:])]
        for i in range(2 * holders):
            rows.append((base + i, " ".join([prose(rng, 30), halves[i % 2], prose(rng, 30)])))
        for i in (500, 501):
            rows.append((base + i, " ".join([prose(rng, 30), *passage, prose(rng, 30)])))
        pairs.add((base + 501, base + 500, " ".join(passage)))
    texts = dict(rows)
    got = found(spark, rows)
    assert {(r.doc_id, r.other_id, texts[r.doc_id][r.start : r.end]) for r in got} == pairs and len(got) == len(pairs)


def test_shuffle_files_go_with_their_query(spark, monkeypatch):
    rng, cleanup, keep = random.Random(17), [], Scratch.keep
    one = prose(rng, 60)
    monkeypatch.setattr(Scratch, "keep", lambda self, df: (cleanup.append(spark.conf.get(C.CLEANUP)), keep(self, df))[1])
    before = spark.conf.get(C.CLEANUP)
    got = found(spark, [(i, " ".join([prose(rng, 30), one, prose(rng, 30)])) for i in range(2)])
    assert [(r.doc_id, r.other_id) for r in got] == [(1, 0)]
    assert set(cleanup) == {"true"} and spark.conf.get(C.CLEANUP) == before


def test_edited_copies_below_any_number_of_holders_of_their_parts(spark):
    """Three phrases, each and each two of them held by more documents than are paired
    themselves: documents that hold all three, with other words between, are still found."""
    rng = random.Random(18)
    parts = [prose(rng, 18) for _ in range(3)]
    rows = []
    for i in range(4 * C.FEW):
        two = [parts[k] for k in range(3) if k != i % 3]
        rows.append((i, " ".join([prose(rng, 30), two[0], prose(rng, 2 + i % 7), two[1], prose(rng, 30)])))
    for i in (500, 501):
        rows.append((i, " ".join([prose(rng, 30), parts[0], prose(rng, 2), parts[1], prose(rng, 2), parts[2], prose(rng, 30)])))
    texts = dict(rows)
    got = [r for r in found(spark, rows) if (r.doc_id, r.other_id) == (501, 500)]
    assert len(got) == 1
    assert all(p in texts[501][got[0].start : got[0].end] for p in parts)


def test_recall_by_identity(spark):
    """Passages with a substituted word every few words, or at random places."""
    rng = random.Random(15)
    rows, kind = [], {}
    for words in (50, 80):
        for identity, every in ((0.8, 5), (0.86, 7), (0.9, 10)):
            for spread in ("even", "random"):
                for _ in range(40):
                    one = prose(rng, words).split()
                    other = list(one)
                    edits = range(every // 2, words, every)
                    for k in edits if spread == "even" else rng.sample(range(words), len(edits)):
                        other[k] = "X" + other[k]
                    doc = 2 * len(kind)
                    kind[doc + 1] = words, identity, spread
                    rows += [(doc + k, " ".join([prose(rng, 30), *p, prose(rng, 30)])) for k, p in enumerate((one, other))]
    got = {(r.doc_id, r.other_id) for r in found(spark, rows)}
    assert all(doc - other == 1 and doc in kind for doc, other in got)
    recall = {k: sum((d, d - 1) in got for d, v in kind.items() if v == k) / 40 for k in sorted(set(kind.values()))}
    print(recall)
    least = {0.8: 0.85, 0.86: 0.95, 0.9: 0.95}
    assert all(share >= least[k[1]] for k, share in recall.items()), recall


def test_uncovered_seeds():
    rng = np.random.default_rng(14)
    rows = [(int(d), int(a), -1) for d, a in rng.integers(0, 60, (300, 2))]
    rows += [(int(d), int(a), int(a + n)) for d, a, n in rng.integers(1, 30, (40, 3))]
    rows.sort(key=lambda r: (r[0], r[1], -r[2]))
    doc, at, stop = (pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int64()), (1, pa.int32()), (2, pa.int32())))
    whole = pa.RecordBatch.from_arrays([doc, doc, at, stop], ["seed", "doc", "at", "stop"])
    expected = [(d, a) for d, a, s in rows if s < 0 and not any(e == d and b <= a < z for e, b, z in rows if z >= 0)]
    for step in (1, 7, 400):
        out = C._uncovered(whole.slice(k, step) for k in range(0, len(rows), step))
        assert [r for b in out for r in zip(b["doc"].to_pylist(), b["at"].to_pylist())] == expected


def test_passages_keep_the_limits():
    rng = np.random.default_rng(12)
    for _ in range(60):
        x = rng.integers(0, 1 << 40, 300).astype(np.uint64)
        y = x.copy()
        for a in rng.integers(0, 280, 4):
            y[a : a + rng.integers(1, 40)] = rng.integers(0, 1 << 40)
        y[rng.random(300) < rng.random() * 0.4] = 7
        place = np.arange(300) * 6
        got = sorted(C.passages(x, y, C.exact_runs(x, y, place, place, [(0, 300, 0, 300)])))
        assert all(a[1] <= b[0] and a[3] <= b[2] for a, b in zip(got, got[1:]))
        for fx, tx, fy, ty, n in got:
            assert tx - fx == ty - fy >= C.MIN_WORDS and n == (x[fx:tx] == y[fy:ty]).sum() >= C.MIN_IDENTITY * (tx - fx)
        same, equal = np.concatenate([[0], np.cumsum(x == y)]), np.flatnonzero(x == y).tolist()
        spans = ((a, z + 1) for a in equal for z in equal if z + 1 - a >= C.MIN_WORDS)
        best = max((z - a for a, z in spans if same[z] - same[a] >= C.MIN_IDENTITY * (z - a)), default=0)
        assert max((g[1] - g[0] for g in got), default=0) >= best


def test_messy_and_empty_tables(spark):
    assert C.shared_passages(documents(spark, []), Scratch(spark, "t")).collect() == []
    rows = messy_documents()
    got = C.shared_passages(documents(spark, rows), Scratch(spark, "t")).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert r.other_id < r.doc_id
        a, b = words_of(texts[r.doc_id][r.start : r.end]), words_of(texts[r.other_id][r.other_start : r.other_end])
        assert max(len(a), len(b)) == r.words
    by_text = {}
    for doc, text in sorted(texts.items()):  # every whole copy of a long text is found
        if len(words_of(text)) >= C.MIN_WORDS:
            first = by_text.setdefault(text, doc)
            if first != doc:
                assert any(r.doc_id == doc for r in got)


def test_a_passage_of_many_holders_costs_its_holders(spark):
    rng = random.Random(6)
    passage = prose(rng, 70)
    rows = [(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(400)]
    got = found(spark, rows)
    assert {(r.doc_id, r.other_id) for r in got} == {(i, 0) for i in range(1, 400)} and len(got) == 399


def test_fenwick_tree():
    rng = random.Random(7)
    tree, plain = C.PrefixMaxima(50), [(-1e300, -1)] * 50
    for i in range(300):
        k, v = rng.randrange(50), rng.random()
        tree.put(k, (v, i))
        plain[k] = max(plain[k], (v, i))
        at = rng.randrange(51)
        assert tree.upto(at)[0] == max([p[0] for p in plain[:at]], default=-1e300)


def test_chains_are_the_best_collinear_ones():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = 9
        x, y = rng.choice(4000, n, replace=False), rng.choice(4000, n, replace=False)
        parts = C.fragments(x, y)
        got = C.chains(x, y)[0]

        def score(c):
            total = sum(C.K + (p[1] - p[0]) / 6.0 for p in c)
            return total - C.GAP * sum((b[0] - a[1]) + (b[2] - a[3]) for a, b in zip(c, c[1:]))

        best = 0.0
        for bits in range(1, 1 << len(parts)):
            c = [p for i, p in enumerate(parts) if bits >> i & 1]
            if all(a[1] < b[0] and a[3] < b[2] for a, b in zip(c, c[1:])):
                best = max(best, score(c))
        assert abs(score(got) - best) < 1e-9


def test_matched_words_is_the_longest_common_subsequence():
    rng = random.Random(9)
    for k in range(300):
        a, b = ([rng.randrange(4 if k % 3 else 30) for _ in range(rng.randrange(9 if k % 2 else 70))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert C.matched_words(a, b) == table[-1][-1]


def test_long_unrelated_gaps_are_aligned_in_seconds():
    import time

    rng, begun = random.Random(12), time.process_time()
    a, b = ([rng.randrange(3000) for _ in range(15_000)] for _ in "ab")
    assert 0 < C.matched_words(a, b) < 15_000
    assert time.process_time() - begun < 10


def test_shared_stretches_share_a_seed():
    rng = random.Random(10)
    for _ in range(50):
        run = prose(rng, C.K + C.WINDOW - 1)
        a, b = f"{prose(rng, 20)} {run} {prose(rng, 9)}", f"{prose(rng, 7)} {run} {prose(rng, 30)}"
        seeds, row, _ = C.seeds_of(pa.array([a, None, b]))
        assert set(seeds[row == 0]) & set(seeds[row == 2])


def test_keys_of_seeds_in_reach():
    rng = np.random.default_rng(19)
    rows = sorted({(int(d), int(a), int(s)) for d, a, s in rng.integers((0, 0, 0), (4, 900, 5), (150, 3))})
    rows = [r for r in rows for _ in range(1 + r[1] % 2)]  # rows of repeated ids
    doc, at, seed = (pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int64()), (1, pa.int32()), (2, pa.int64())))
    whole = pa.RecordBatch.from_arrays([seed, doc, at], ["seed", "doc", "at"])
    once = sorted(set(rows))
    near = [(a, b) for a in once for b in once if a[0] == b[0] and C.LEAST_SPAN <= b[1] - a[1] <= C.LEAST_SPAN + C.STRETCH]
    for step in (1, 7, 400):
        out = [r for b in C._keys(whole.slice(k, step) for k in range(0, len(rows), step)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted(r[1:] for r in out) == sorted((a[0], a[1], b[1]) for a, b in near)
        assert len({r[0] for r in out}) == len({(a[2], b[2]) for a, b in near})


def test_sketches_of_a_passage_share_its_pairs_of_words():
    rng = random.Random(20)
    for kinds in (2, 5, 4000):  # words that repeat, too
        for _ in range(40):
            passage = [1 + rng.randrange(kinds) for _ in range(C.MIN_WORDS)]
            edited = list(passage)
            for j in rng.sample(range(C.MIN_WORDS), 8):
                edited[j] = 10_000 + j
            bits = []
            for p, own in ((passage, 5000), (edited, 9000)):
                text = [rng.randrange(own, own + 900) for _ in range(70)] + p + [rng.randrange(own, own + 900) for _ in range(70)]
                bits.append(C.sketch(np.array(text, dtype=np.uint64), np.array([70, 90, 106])))
            for x, y in zip(*bits):
                assert sum(int(v).bit_count() for v in (x & y).view(np.uint64)) >= C.LEAST_ALIKE


def test_a_line_beside_common_phrases_pairs_no_square_of_its_holders(spark, monkeypatch):
    rng, chains, keep = random.Random(21), [], Scratch.keep
    line, phrases = prose(rng, 20), [prose(rng, 6) for _ in range(5)]
    rows = []
    for i in range(240):
        p, q = rng.sample(phrases, 2)
        rows.append((i, " ".join([prose(rng, 30), p, prose(rng, 2 + i % 7), line, prose(rng, 2 + i % 5), q, prose(rng, 30)])))

    def kept(self, df):
        out = keep(self, df)
        chains.extend([out.count()] if "lx" in df.columns else [])
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    found(spark, rows)
    assert len(chains) == C.ROUNDS + 1 and max(chains) < C.FEW * len(rows)  # their pairs are 28,680


def test_a_passage_that_begins_twice_in_the_other_document(spark):
    rng = random.Random(22)
    rows, pairs = [], set()
    for i in range(0, 60, 10):
        passage = prose(rng, 76).split()
        halves = [" ".join(passage[:38]), " ".join(passage[38:])]
        rows += [(i + k, " ".join([prose(rng, 30), h, prose(rng, 30)])) for k, h in enumerate(halves + halves)]
        # the first places of most seeds are not those of the passage
        rows.append((i + 4, " ".join([" ".join(passage[2:30]), prose(rng, 40), *passage, prose(rng, 30)])))
        rows.append((i + 5, " ".join([prose(rng, 30), *passage, prose(rng, 30)])))
        pairs.add((i + 5, i + 4, " ".join(passage)))
    texts = dict(rows)
    got = found(spark, rows)
    assert pairs <= {(r.doc_id, r.other_id, texts[r.doc_id][r.start : r.end]) for r in got if texts[r.other_id][r.other_start : r.other_end] == texts[r.doc_id][r.start : r.end]}
