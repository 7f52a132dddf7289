import random

import numpy as np
import pyarrow as pa

from tests.llm.common import documents, messy_documents
from tillroll.llm import cotraining as C


def corpus(n=1200, seed=2):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        bad = rng.random() < 0.3
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w for w in words for _ in range(6)]
        text = " ".join(words)
        rows.append((i, text, "en", "junk" if bad and rng.random() < 0.9 else "s", len(text), *messy_documents()[0][5:]))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    shown = spark.createDataFrame(labels[:300] + [(5, 1 - labels[5][1]), (None, 1), (6, None), (7, 4)], "doc_id long, quality int")
    model = C.train(docs, shown)
    assert isinstance(model, C.CoTrained) and sum(model.taught) > 0
    truth = dict(labels)
    got = {r.doc_id: r for r in C.score(docs, model).collect()}
    assert len(got) == len(rows)
    unseen = [i for i in truth if i >= 300]
    assert np.mean([got[i].kept == (truth[i] == 1) for i in unseen]) > 0.98
    assert np.mean([got[i].kept for i in unseen if truth[i]]) > 0.99
    kept = C.filter_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_repeated_ids_are_picked_alike_in_every_partitioning(spark):
    rows, labels = corpus(400)
    rows += [(r[0], rows[-1 - i][1], *r[2:]) for i, r in enumerate(rows[:40])]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = documents(spark, rows)
    frames = docs.coalesce(1), docs.repartition(7, "text"), docs.orderBy("text").repartition(3)
    got = [sorted((r.doc_id, r.p_good) for r in C.score(docs, C.train(f, labels)).collect()) for f in frames]
    assert got[0] == got[1] == got[2]


def test_messy_and_empty_tables(spark):
    labels = spark.createDataFrame([(0, 1), (3, 0)], "doc_id long, quality int")
    docs = documents(spark)
    model = C.train(docs, labels)
    rows = C.score(docs, model).collect()
    assert len(rows) == len(messy_documents()) and all(r.kept and r.p_good == 0.5 for r in rows)
    assert C.filter_quality(docs, model).count() == len(rows)
    none = C.train(documents(spark, []), labels.limit(0))
    assert C.score(documents(spark, []), none).collect() == []
    rows, known = corpus(400)
    trained = C.train(documents(spark, rows), spark.createDataFrame(known, "doc_id long, quality int"))
    assert len(C.score(docs, trained).collect()) == len(messy_documents())


def test_views_do_not_depend_on_the_batch():
    texts = [r[1] for r in messy_documents()]
    whole = C.text_view(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], C.text_view(pa.array([t], pa.string()))[0])


def test_an_uninformative_view_gets_little_weight():
    rng = np.random.default_rng(1)
    y = (rng.random(800) < 0.5).astype(float)
    views = [np.stack([y + rng.normal(0, 0.3, 800), rng.normal(size=800)], 1), rng.normal(size=(800, 3))]
    pool = [v[:100] for v in views]
    model = C.CoTrained(views, y, np.arange(800) % 4 == 0, pool)
    assert abs(model.combination.w[0]) > 3 * abs(model.combination.w[1])


def test_sums_over_the_table_equal_those_of_one_matrix(spark):
    rows, labels = corpus(500)
    rows += [(None, *rows[3][1:]), (7, *rows[9][1:])]
    docs = documents(spark, rows)
    features = docs.repartition(5, "text").transform(C.narrow).mapInArrow(C._features, C.FEATURES)
    labelled = np.arange(0, 100)
    apart = [r for r in rows if r[0] is None or r[0] >= 100]
    text = C.text_view(pa.array([r[1] for r in apart])).astype("<f4").astype(float)
    page = C.page_view(C.page_places([r[2] for r in apart], [r[3] for r in apart], [r[4] for r in apart]))
    added = C._added(features, labelled)
    assert np.allclose(added(C._moments), C._moments((text, page)), rtol=1e-9)
    shown = [C.text_view(pa.array([r[1] for r in rows[:100]])), C.page_view(C.page_places(*zip(*[r[2:5] for r in rows[:100]])))]
    y = np.array([dict(labels)[i] for i in range(100)], dtype=float)
    held_out = np.arange(100) % 4 == 0
    far, near = C.CoTrained(shown, y, held_out, added), C.CoTrained(shown, y, held_out, (text, page))
    assert far.taught == near.taught and sum(near.taught) > 100
    for a, b in zip(far.views, near.views):
        assert (a.w == b.w).all()


def plain_probability(view, platt, row):
    """The same score by one document's features, number by number."""
    z = view.w[-1]
    for x, mean, scale, w in zip(row, view.mean, view.scale, view.w):
        z += max(-C.CLIP, min(C.CLIP, (x - mean) / scale)) * w
    odds = platt.w[0] * (max(-30, min(30, z)) - platt.mean[0]) / platt.scale[0] + platt.w[1]
    return max(-30, min(30, odds))


def test_scores_equal_a_plain_version(spark):
    rows, labels = corpus(400)
    docs = documents(spark, rows)
    model = C.train(docs, spark.createDataFrame(labels[:200], "doc_id long, quality int"))
    got = {r.doc_id: r for r in C.score(docs, model).collect()}
    for i in range(0, 400, 7):
        row = rows[i]
        views = C.text_view(pa.array([row[1]]))[0], C.page_view(C.page_places([row[2]], [row[3]], [row[4]]))[0]
        odds = [plain_probability(*p) for p in zip(model.views, model.calibrations, views)]
        c = model.combination
        both = c.w[-1] + sum(w * (o - m) / s for w, o, m, s in zip(c.w, odds, c.mean, c.scale))
        good = 1 / (1 + np.exp(-max(-30, min(30, both))))
        assert abs(got[i].p_text - 1 / (1 + np.exp(-odds[0]))) < 1e-9
        assert abs(got[i].p_page - 1 / (1 + np.exp(-odds[1]))) < 1e-9
        assert abs(got[i].p_good - good) < 1e-9 and got[i].kept == (got[i].p_good >= model.cut)


def test_every_confident_document_teaches_and_classes_weigh_as_their_labels():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.5).astype(float)
    truth = (rng.random(30000) < 0.9).astype(float)
    views = [np.stack([y * 4 + rng.normal(0, 0.4, 400), rng.normal(size=400)], 1) for _ in range(2)]
    pool = [np.stack([truth * 4 + rng.normal(0, 0.4, 30000), rng.normal(size=30000)], 1) for _ in range(2)]
    model = C.CoTrained(views, y, np.arange(400) % 4 == 0, pool)
    assert min(model.taught) > 30000 / 2  # no number a round, class or stratum bounds them
    assert np.mean((model.score(pool)[2] >= 0.5) == (truth == 1)) > 0.99
