import hashlib
import random

import pytest

from tests.llm.common import documents, messy_documents
from tillroll.llm import fingerprints as P


def phrases(text):
    """LZ78 phrases of the UTF-8 bytes, plainly."""
    seen, now = set(), b""
    for c in text.encode():
        now += bytes([c])
        if now not in seen:
            seen.add(now)
            now = b""
    return seen


def rows_of(spark, rows):
    out = P.next_to(documents(spark, rows).select("doc_id", "text")).select("doc_id", "text", "_run", "_own")
    return out.mapInArrow(P._run, P.SCHEMA).collect()


@pytest.mark.parametrize("partitions", [1, 2, 40])
def test_against_plain_python(spark, partitions):
    rows = [r for i, r in enumerate(messy_documents()) if i < 48] + [(None, "null id", *messy_documents()[0][2:])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = rows_of(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for i, (doc, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (P.fingerprint(x) for x in (text, edited, after))
        want.append(
            (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), P._hex(a), P._hex(b), P.likeness(a, b), P.likeness(a, c))
        )
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_one_and_repeated_rows(spark):
    assert rows_of(spark, []) == []
    rest = messy_documents()[0][2:]
    (one,) = rows_of(spark, [(7, "ab", *rest)])
    assert (one.n_chars, one.near_next, one.edited_sha256) == (2, 1.0, hashlib.sha256(b"aa").hexdigest())
    assert len(rows_of(spark, [(7, "ab", *rest)] * 30)) == 30


def test_phrases_are_lz78():
    for text in ("", "a", "aaaaaaaa", "abababab", "é€😀" * 9, messy_documents()[9][1]):
        ends, root = [], {}
        P._parse(text.encode(), root, root, 0, ends)
        data = text.encode()
        assert {data[a:b] for a, b in zip([0, *ends], ends)} == phrases(text)


def test_likeness_follows_phrase_sets():
    rng = random.Random(3)
    for _ in range(40):
        a = "".join(rng.choice("abcdefgh ") for _ in range(2000))
        b = a[: rng.randrange(2000)] + "".join(rng.choice("abcdefgh ") for _ in range(1000))
        s, t = phrases(a), phrases(b)
        assert abs(P.likeness(P.fingerprint(a), P.fingerprint(b)) - len(s & t) / len(s | t)) < 0.2
    assert P.likeness(P.fingerprint(""), P.fingerprint("")) == 1 and P.likeness(P.fingerprint(""), P.fingerprint("a")) == 0
