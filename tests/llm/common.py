"""Messy tables for the tests of tillroll.llm: nulls, empty and long texts, repeated
rows, copies, extra columns with names that operators use themselves."""

import random
import re

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept int, n int, shard string, id long, label string, k1 string, component double, x array<int>"
)


def fold(text):
    """A-Z lower-cased, nothing else."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))


def messy_documents(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghéü") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))

    base = [prose(rng.randint(30, 200)) for _ in range(12)]
    texts = [None, "", " ", "\n\n", "one", "One", "a b", "  x", prose(4000), *base]
    for t in base[:6]:  # near copies: some words changed
        w = t.split(" ")
        for i in rng.sample(range(len(w)), max(1, len(w) // 60)):
            w[i] = "changed"
        texts += [t, " ".join(w), t.upper()]
    shared = prose(60).replace("\n", " ")
    texts += [f"{prose(20)}\nAll rights reserved.\n {shared} \n{prose(20)}" for _ in range(14)]
    texts += [f"\t ALL rights RESERVED. \r\n{prose(5)}" for _ in range(3)]
    rows = [
        (3 * i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "hot", "hot", None]), None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    rows += [rows[10], rows[10], rows[0]]  # repeated rows
    return [(*r, 1, 2, "x", 5, "l", "k", 0.5, [1]) for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(messy_documents() if rows is None else rows, SCHEMA)


def groups(nodes, links):
    """Least node reachable from each."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
