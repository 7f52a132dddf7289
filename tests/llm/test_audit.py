import random
import re
from collections import defaultdict
from itertools import permutations

from tests.llm.common import documents, messy_documents
from tillroll.llm import audit as A

LABELS = "doc_id long, quality int, toxic int, part string, fails string, n int"


def failing(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        x
        for x, f in (
            ("A", len(words) < 200),
            ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
            ("D", any(c in "#$%&*|" for c in text)),
        )
        if f
    }


def brute_force(rows, labels):
    """Every order over every row: {(part, order, step): counts}."""
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = []
    for i, t, lang, *_ in rows:
        f = failing(t or "")
        if i is not None and least[t or ""] < i:
            f.add("E")
        docs.append((lang or "", f, i in good, i in toxic))
    out, shapley = {}, defaultdict(int)
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                redundant = sum(x in d[1] for d in own) - len(gone)
                left = [d for d in left if x not in d[1]]
                shapley[part, x] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), redundant, sum(d[1] == {x} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit(spark, rows, labels):
    said = spark.createDataFrame([(*r, "x", "A", 1) for r in labels], LABELS)
    got = A.interactions(documents(spark, rows), said).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in A.COUNTS) + (r.shapley,) for r in got}
    assert len(out) == len(got)
    return out


def test_equals_every_order_over_every_row(spark):
    rng = random.Random(3)
    rows = messy_documents()
    extra = rows[0][5:]
    rows += [(1000 + i, "word " * 250 + rng.choice(["", "#", "ABC" * 90]), "en", "s", 1, *extra) for i in range(40)]  # many copies
    rows += [(None, t, None, "s", 1, *extra) for t in ("one", "word " * 250, None)]  # no id
    rows += [(999, "word " * 250, "de", "s", 1, *extra)] * 3  # the least id of a text, repeated
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows if rng.random() < 0.7]
    labels += [(labels[0][0], 1, 1), (None, 1, 1), (77777, 1, 1)]
    want = brute_force(rows, labels)
    assert audit(spark, rows, labels) == want
    parts = {k[0] for k in want}
    assert parts == {"", "en", "de"} and len(want) == 600 * len(parts)


def test_one_part_without_any_failure_has_zeros(spark):
    rows = [(7, " ".join(f"w{i}" for i in range(200)), "en", "s", 1, *messy_documents()[0][5:])]
    got = audit(spark, rows, [])
    assert got == brute_force(rows, []) and set(got.values()) == {(1, 0, 0, 0, 0, 0, 0)}


def test_empty_tables(spark):
    assert audit(spark, [], []) == {}
    assert audit(spark, [], [(1, 1, 1)]) == {}


def test_no_python_and_a_bounded_broadcast(spark):
    plan = A.interactions(documents(spark), spark.createDataFrame([], LABELS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
