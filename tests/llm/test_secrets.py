import hashlib
import random
import re
import string

import pyarrow as pa
import pytest

from tests.llm.common import documents, messy_documents
from tillroll.llm import secrets as S

RNG = random.Random(8)
HEX40 = "".join(RNG.choice("0123456789abcdef") for _ in range(40))


def base_of(text):
    """By the patterns, one text at a time."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


ODD = [
    f"é token = \"{HEX40}\" und ü {HEX40}x",
    "secret=token: abcdefgh password:short passwd = 'longer1'",
    "ToKeN : abcdef API_KEY=ABCDEFG apikey='x.y=z-w' ſecret=abcdefghi",
    "AKIA" + "A" * 16 + " AKIAAKIA" + "Z" * 12 + " AKIAB é AKIA" + "1" * 20,
    "a" * 24 + "g" + "b" * 23 + "\n" + "0" * 30,
    "token",
    ": abcdefghij token",
    "=abcdefgh",
    "token\n= abcdefg token  =  \"\"abcdefg",
]


def test_base_spans_against_patterns(spark):
    rows = messy_documents() + [(1000 + i, t, *messy_documents()[0][2:]) for i, t in enumerate(ODD)]
    docs = documents(spark, rows)
    got = S.scan(docs, S.train(docs)).collect()
    assert len(got) == len(rows)
    want = sorted(
        (r[0], [sum(k == x for _, k, _ in base_of(r[1] or "")) for x in range(3)], base_of(r[1] or "")) for r in rows
    )
    for g, (doc, counts, spans) in zip(sorted(got, key=lambda r: (r.doc_id, r.n_assign)), want):
        text = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert (g.doc_id, [g.n_assign, g.n_access, g.n_hex]) == (doc, counts)
        assert g.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(g.spans.split(","))


def test_empty_table(spark):
    docs = documents(spark, [])
    assert S.scan(docs, S.train(docs)).collect() == []


@pytest.fixture(scope="module")
def ratios(spark):
    import os

    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables not present")
    return S.train(spark.read.parquet(path))


def spans_of(ratios, texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    return [x for b in S._scan(ratios)(iter([batch])) for x in b.column("spans").to_pylist()]


@pytest.mark.parametrize(
    "letters,size",
    [(string.ascii_letters + string.digits, 24), (S.ALPHABET[:64], 40), (S.RANDOM["base32"], 32), ("0123456789ABCDEF", 40)],
)
def test_random_strings_are_found(ratios, letters, size):
    rng = random.Random(9)
    texts = ["é words " + "".join(rng.choice(letters) for _ in range(size)) + "== more" for _ in range(300)]
    found = spans_of(ratios, texts)
    assert sum("markov" in x for x in found) >= 0.97 * len(texts)


def test_ordinary_words_and_identifiers_are_left_alone(ratios):
    texts = [
        "getUserAccountSettings some_long_identifier_name internationalization e-mail-verification-service",
        "MAX_NUMBER_OF_RETRIES_ALLOWED /usr/local/lib/python/site-packages Donaudampfschifffahrtsgesellschaft",
        "4785380592391139 0000000000000000000000 ==================== ---------------- ________________",
    ]
    assert spans_of(ratios, texts) == ["", "", ""]


def test_no_false_alarm_in_prose(spark, ratios):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in S.scan(docs, ratios).collect():
        for span in filter(None, r.spans.split(",")):
            kind, start, end = span.split(":")
            if kind == "markov":
                assert re.search(r"\d", texts[r.doc_id][int(start) : int(end)])
