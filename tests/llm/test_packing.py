import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import documents, messy_documents
from tillroll.llm import packing
from tillroll.llm.scratch import Scratch

PATH = packing.default_tokenizer()


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


ODD = [
    "It's we'll foo'S! a,b. c.. d., é. É, 12. x\xa0y\x85z \x1c q ǅ. ΑΣ, İx. İ. á, ﬁ, 's.'t, can't. ſ.",
    "<|endoftext|> a <|EndOfText|> <|startoftext|>b",
    " ́b c ́. ª. º, µ. ², ¹. ß. ÿ, a. z, A. Z.",
    "....,,, . , .. a",
    "",
    None,
    "你好世界 😀😀 a\u0000b",
]


def test_encoder_is_exact_and_remembers():
    encode = packing.Encoder(PATH)
    texts = ODD + [r[1] for r in messy_documents()]
    for _ in range(2):
        assert [x.tolist() for x in encode(pa.array(texts))] == [ids_of(t) for t in texts]


def test_encoder_forgets_when_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 5)
    encode = packing.Encoder(PATH)
    for t in ("a b c d e f g", "b c x y z", "a q"):
        assert encode(pa.array([t]))[0].tolist() == ids_of(t)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    real = packing.words
    monkeypatch.setattr(packing, "words", lambda *a: (*real(*a)[:3], real(*a)[3] % np.uint64(7)))
    encode = packing.Encoder(PATH)
    texts = [r[1] for r in messy_documents()]
    assert [x.tolist() for x in encode(pa.array(texts))] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("most", [2048, 16])
def test_pieces_put_documents_together_again(spark, most):
    scratch = Scratch(spark, "t")
    out = packing.pack(scratch.keep(packing.pieces(documents(spark), PATH, most)), scratch, most).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    rows = messy_documents()
    count = defaultdict(int)
    for r in rows:
        count[r[0]] += 1
    for doc, text in {r[0]: r[1] for r in rows}.items():
        ids = ids_of(text) + [0]
        want = []
        for p, at in enumerate(range(0, len(ids), most)):
            part = ids[at : at + most]
            want += [(p, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))] * count[doc]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]) == sorted(want)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
    low = sum(r.length for r in out) / most
    assert len(by_sequence) <= low * 1.02 + 1


def test_empty_table(spark):
    scratch = Scratch(spark, "t")
    assert packing.pack(scratch.keep(packing.pieces(documents(spark, []), PATH, 64)), scratch, 64).collect() == []


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 400, 600))[::-1]
    sequence, offset = packing.best_fit(lengths, 1000, 5, 250_000.0, (1, 1, 1), score)
    for s in np.unique(sequence):
        own = sequence == s
        assert lengths[own].sum() <= 1000 and own.sum() <= 5 and (lengths[own] ** 2).sum() <= 250_000
        order = np.argsort(offset[own])
        assert (np.cumsum(lengths[own][order]) - lengths[own][order] == offset[own][order]).all()


def test_best_fit_is_close_to_the_bound():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, 2048, 5000))[::-1]
    sequence, _ = packing.best_fit(lengths, 2048, 2048, 2048.0**2, (1, 0.05, 0.05), "norm")
    assert sequence.max() + 1 <= np.ceil(lengths.sum() / 2048) * 1.01
