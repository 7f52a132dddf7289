import random
from bisect import bisect_left
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import documents, messy_documents
from tillroll.llm import alignment as A
from tillroll.llm.scratch import Scratch

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " lead", "trail ", "two  spaces", "a\n b", "a \nb", "tabs\t\tand nbsp   wide", "\n", " ", "   ", "x▁y", "▁",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "nul\x00 \x1c \x85 end", "é ́alone ﬁ Å", "日本語 のテキスト 🙂🙂 👩‍👩", "don't we'LL it's",
    "a" * 3000, "1234567890" * 40, "\r\n\r\n  \r\n x", " ́", "def f(x):\n    return  x\n\n\n# end",
]


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner(*A.default_vocabularies())


@pytest.fixture(scope="module")
def plain():
    """Ids and bytes of whole texts by the public libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_path, piece_path = A.default_vocabularies()
    t = Tokenizer.from_file(byte_path)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    symbol = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}

    def piece(i):
        p = s.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = s.encode(text)
        a, b = [(i, bytes(symbol[c] for c in t.id_to_token(i))) for i in a], [(i, piece(i)) for i in b]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    return tokens


def ends(tokens):
    return np.cumsum([len(x) for _, x in tokens]).tolist()


def brute_force(texts, tokens):
    links, out = [], []
    for t in texts:
        a, b = tokens(t) if t else ([], [])
        ea, eb = ends(a), ends(b)
        shared = sorted(set(ea) & set(eb))
        in_group = [[bisect_left(shared, e) for e in side] for side in (ea, eb)]
        sides = [defaultdict(list), defaultdict(list)]
        for side, numbers, tokens_of in zip(sides, in_group, (a, b)):
            for n, (i, _) in zip(numbers, tokens_of):
                side[n].append(str(i))
        groups = [",".join(sides[0][n]) + "|" + ",".join(sides[1][n]) for n in range(len(shared))]
        by_end = defaultdict(list)
        for (i, _), e in zip(b, eb):
            by_end[e].append(i)
        links.append([(i, j) for (i, _), e in zip(a, ea) for j in by_end[e]])
        out.append([len(a), len(b), len(groups), len(links[-1]), sha256(";".join(groups).encode()).hexdigest() if a else ""])
    count = Counter(p for x in links for p in x)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return [
        (*row[:4], sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own), row[4]) for row, own in zip(out, links)
    ]


def aligned(spark, texts, most=A.SLICE, parts=3):
    rows = [(i, t, i, "x", "a") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slice int, at string, pairs string").repartition(parts, "doc_id")
    got = A.align(docs, *A.default_vocabularies(), Scratch(spark, "t"), most).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    return [tuple(r[c] for c in COLUMNS) for r in sorted(got)]


@pytest.mark.parametrize("most", [A.SLICE, 600])
def test_equals_brute_force_on_messy_texts(spark, plain, most):
    texts = [r[1] for r in messy_documents()] + ODD + [None, ""]
    assert aligned(spark, texts, most) == brute_force(texts, plain)


def test_equals_brute_force_on_documents(spark, plain):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in sorted(rows)]
    assert aligned(spark, texts, 50_000) == brute_force(texts, plain)


def test_units_are_the_whole_text(aligner, plain):
    rng = random.Random(5)
    signs = ["a", "B", "é", " ", " ", " ", "\n", "\t", " ", "1", "'s", "▁", ".", "🙂", "́", "word", "the"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(400)] + ODD
    kept, found = aligner(texts)
    a, b, a_sizes, b_sizes, _, _ = found
    at_a, at_b = np.cumsum(a_sizes), np.cumsum(b_sizes)
    got = {r: (a[x - m : x].tolist(), b[y - n : y].tolist()) for r, x, m, y, n in zip(kept.tolist(), at_a, a_sizes, at_b, b_sizes)}
    for i, t in enumerate(texts):
        want = tuple([j for j, _ in side] for side in plain(t))
        assert got.get(i, ([], [])) == want, t


def test_a_worker_that_forgets(aligner, monkeypatch):
    texts = [r[1] for r in messy_documents()] + ODD
    kept, found = aligner(texts)
    monkeypatch.setattr(A, "UNITS", 5)
    again, same = aligner(texts)
    assert kept.tolist() == again.tolist() and all(np.array_equal(x, y) for x, y in zip(found, same))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 9), min_size=1, max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=60)), min_size=1, max_size=5))
def test_divided_cuts_are_the_shared_ends(docs):
    a_all, b_all, base, a_sizes, b_sizes, want_a = [], [], 0, [], [], []
    for a, b in docs:
        ea, eb = np.cumsum(a).tolist(), np.cumsum(b).tolist()
        end = max(ea[-1], eb[-1])
        ea, eb = [*ea[:-1], end], [*eb[:-1], end]  # both end together
        a_all += [base + e for e in ea]
        b_all += [base + e for e in eb]
        want_a += [e in set(eb) for e in ea]
        a_sizes.append(len(ea))
        b_sizes.append(len(eb))
        base += end
    cut_a, cut_b = A.shared_cuts(*(np.array(x) for x in (a_all, b_all, a_sizes, b_sizes)))
    assert cut_a.tolist() == want_a
    assert np.array(a_all)[cut_a].tolist() == np.array(b_all)[cut_b].tolist()


def test_a_long_text_without_a_shared_cut_inside():
    n = 300_000
    a, b = np.arange(2, 2 * n + 2, 2), np.append(np.arange(1, 2 * n - 1, 2), 2 * n)
    cut_a, cut_b = A.shared_cuts(a, b, np.array([len(a)]), np.array([len(b)]))
    assert cut_a.sum() == cut_b.sum() == 1


def test_empty_table(spark):
    assert A.align(documents(spark, []), *A.default_vocabularies(), Scratch(spark, "t")).collect() == []
