"""Quality classifier by co-training two views of a document.

One classifier sees the text (shares of byte classes, hashed byte pairs, word
shape and repetition), the other the page metadata (language, source, length).
Both are logistic regressions on features standardised over all documents. In
each round every view labels all unlabelled documents that it is confident of
(unless the other view is as sure of the opposite), and those pseudo-labels join
the other view's training rows; however many there are, those of a class weigh no
more than the labelled rows of that class. At the end each view is calibrated on held-out labelled rows (Platt), and the calibrated
views are combined by a logistic regression on their log-odds; a view that tells
nothing gets no weight.

The labelled rows are a bounded sample (``LABELLED``, those of least keyed hash)
that the driver holds. Everything else is a Spark job over all documents: the
features are written once, and moments, pseudo-labels and the sums of each
step (a gradient and a curvature, of fixed size) are added up in the tasks and
merged in ``MERGERS`` more. Moments and weights are put on a grid far coarser than
the rounding of such sums, so the order of the rows does not show.

Defined results: null text counts as empty, null metadata as a value of its own;
labels other than 0 and 1, and ids with both, are left out; of labelled rows that
repeat an id the one of least features trains; with fewer than ``LEAST`` labels of
either class nothing is learnt: every document scores the share of good labels (1
without any) and is kept; a row is a row; an empty table gives no rows; extra
columns are not read by the classifier and pass through ``filter_quality``
untouched.
"""

from __future__ import annotations

import copy
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, bounded_batches, table
from tillroll.llm.texts import distinct, flat, slices, words

#: Bound of the labelled sample, in documents.
LABELLED = 8000
#: Least labels of each class.
LEAST = 2
#: Rounds of exchange, and steps of a round at most (each starts from the last).
ROUNDS, STEPS = 4, 3
#: A pseudo-label needs this probability.
CONFIDENT = 0.95
#: Standardised features are cut here; weights are multiples of ``GRID``.
CLIP, GRID = 16.0, 1 / 1024
#: Tasks that merge the sums of the tasks before them.
MERGERS = 16
#: The share of labelled good documents that the cut must keep.
KEEP_GOOD = 0.995
CUT = 0.5

PAIRS, PLACES = 128, 64
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", "!", "|", "#$%&*", "\"'()-:;?"]
_CLASS = np.full(256, len(_CLASSES), dtype=np.int64)  # the rest of ASCII
_CLASS[128:] = len(_CLASSES) + 1
for _k, _chars in enumerate(_CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _k
KINDS = len(_CLASSES) + 2
_RNG = np.random.Generator(np.random.PCG64(77))
_LEFT, _RIGHT = _RNG.integers(0, PAIRS, 256), _RNG.integers(0, PAIRS, 256)


def text_view(column) -> np.ndarray:
    """Features of whole texts, a row each."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    per = 1 / np.maximum(size, 1)[:, None]
    kinds = np.bincount(row * KINDS + _CLASS[data], minlength=n * KINDS).reshape(n, KINDS) * per
    same = row[1:] == row[:-1]
    pair = (_LEFT[data[:-1]] + _RIGHT[data[1:]]) % PAIRS
    pairs = np.bincount((row[1:] * PAIRS + pair)[same], minlength=n * PAIRS).reshape(n, PAIRS) * per
    start, end, at, hashes = words(data, offsets)
    count = np.bincount(at, minlength=n)
    each = 1 / np.maximum(count, 1)
    again = np.bincount(at[1:][(at[1:] == at[:-1]) & (hashes[1:] == hashes[:-1])], minlength=n) * each
    different = np.bincount(distinct(hashes, at)[1], minlength=n) * each
    length = np.bincount(at, weights=end - start, minlength=n) * each
    first = _CLASS[data[start]] == 1
    capital = np.bincount(at[first], minlength=n) * each
    mark = (_CLASS[data[end - 1]] >= 7) & (_CLASS[data[end - 1]] <= 9)
    marked = np.bincount(at[mark], minlength=n) * each
    shape = np.stack([again, different, np.log1p(length), capital, marked, np.log1p(count), np.log1p(size)], axis=1)
    return np.concatenate([kinds, np.sqrt(pairs), shape], axis=1)


def page_places(lang, source, chars) -> np.ndarray:
    """Language and source by hash, length by power of two: three small numbers a row."""
    out = np.zeros((len(lang), 3), dtype=np.uint8)
    for i, (a, b, c) in enumerate(zip(lang, source, chars)):
        out[i, 0] = zlib.crc32(b"\0" if a is None else str(a).encode()) % PLACES
        out[i, 1] = zlib.crc32(b"\0" if b is None else str(b).encode()) % PLACES
        out[i, 2] = 0 if c is None else min(31, 1 + max(0, int(c)).bit_length())
    return out


def page_view(places: np.ndarray) -> np.ndarray:
    """Features of the metadata, from their places."""
    out = np.zeros((len(places), 2 * PLACES + 32))
    for k in range(3):
        out[np.arange(len(places)), PLACES * k + places[:, k].astype(np.int64)] = 1
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Logistic:
    """L2-regularised logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)
        w = np.zeros(z.shape[1])
        ridge = np.full(len(w), penalty)
        ridge[-1] = 1e-6
        for _ in range(25):
            p = _sigmoid(z @ w)
            gradient = z.T @ (p - y) + ridge * w
            curvature = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curvature, gradient)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


class View:
    """A view's logistic regression; features are standardised by given moments."""

    def __init__(self, count: float, total: np.ndarray, squares: np.ndarray):
        mean = total / max(count, 1)
        deviation = np.sqrt(np.maximum(squares / max(count, 1) - mean * mean, 0)) + 1e-6
        self.scale = np.exp2(np.round(np.log2(deviation) * 16) / 16)
        self.mean = np.round(mean / self.scale * 64) / 64 * self.scale
        self.w = np.zeros(len(mean) + 1)

    def _standard(self, x):
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._standard(x) @ self.w, -30, 30)

    def sums(self, x, y, weight) -> np.ndarray:
        """Gradient and upper triangle of the curvature of weighted rows. The curvature
        is that of the tangent parabola above the loss, so a step never raises the loss."""
        z = self._standard(x)
        m = np.clip(z @ self.w, -30, 30)
        size = np.maximum(np.abs(m), 1e-6)
        curvature = (z * (weight * np.tanh(size / 2) / (2 * size))[:, None]).T @ z
        return np.concatenate([z.T @ (weight * (_sigmoid(m) - y)), curvature[np.triu_indices(len(self.w))]])

    def step(self, sums: np.ndarray) -> bool:
        """A ridge-penalised step by summed ``sums``; whether nothing moved."""
        n = len(self.w)
        ridge = np.append(np.ones(n - 1), 1e-6)
        curvature = np.zeros((n, n))
        curvature[np.triu_indices(n)] = sums[n:]
        curvature += np.triu(curvature, 1).T + np.diag(ridge)
        w = np.round((self.w - np.linalg.solve(curvature, sums[:n] + ridge * self.w)) / GRID) * GRID
        settled = bool(np.abs(w - self.w).max() <= GRID)
        self.w = w
        return settled


def _moments(views) -> np.ndarray:
    return np.concatenate([np.concatenate([[len(v)], v.sum(0), (v * v).sum(0)]) for v in views])


def _lessons(teachers, views):
    """For each pupil view: the rows that the other view is confident of, and their
    labels; not those of which the pupil itself is as sure of the other label."""
    p = [_sigmoid(platt.log_odds(model.log_odds(x)[:, None])) for (model, platt), x in zip(teachers, views)]
    for pupil, q in enumerate(p[::-1]):
        sure = np.where(q >= 0.5, np.where(p[pupil] > 1 - CONFIDENT, q, 0), np.where(p[pupil] < CONFIDENT, 1 - q, 0))
        rows = np.flatnonzero(sure >= CONFIDENT)
        yield pupil, rows, (q[rows] >= 0.5).astype(np.int64)


def _lesson_counts(teachers, views) -> np.ndarray:
    return np.concatenate([np.bincount(y, minlength=2) for _, _, y in _lessons(teachers, views)]).astype(np.float64)


def _lesson_sums(teachers, pupils, weights, views) -> np.ndarray:
    return np.concatenate([pupils[k].sums(views[k][rows], y, weights[k][y]) for k, rows, y in _lessons(teachers, views)])


class CoTrained:
    """Two views, their calibrations, the combination and the cut."""

    def __init__(self, views, labels, held_out, pool):
        """``views``: the two feature matrices of the labelled rows; ``held_out``:
        which of those calibrate; ``pool``: adds a function of the two views up over
        all unlabelled rows (or the two matrices of such rows)."""
        added = pool if callable(pool) else lambda of: of(pool)
        sizes = [v.shape[1] for v in views]
        self.views = []
        moments = added(_moments) + _moments(views)
        for d in sizes:
            self.views.append(View(moments[0], moments[1 : d + 1], moments[d + 1 : 2 * d + 1]))
            moments = moments[2 * d + 1 :]
        fit = ~held_out
        shown, y = [v[fit] for v in views], labels[fit]
        for view, x in zip(self.views, shown):
            for _ in range(50):
                if view.step(view.sums(x, y, np.ones(len(y)))):
                    break
        of_class = np.array([(y == c).sum() for c in (0, 1)], dtype=np.float64)
        before = None
        for _ in range(ROUNDS):
            teachers = list(zip(map(copy.copy, self.views), self._calibrations(views, labels, held_out)))
            counts = added(partial(_lesson_counts, teachers)).reshape(2, 2)
            if not counts.any() or (before is not None and (counts == before).all()):
                break
            before = counts
            weights = np.minimum(1, of_class / np.maximum(counts, 1))
            for _ in range(STEPS):
                sums = added(partial(_lesson_sums, teachers, self.views, weights))
                settled = []
                for view, x in zip(self.views, shown):
                    own = view.sums(x, y, np.ones(len(y)))
                    settled.append(view.step(own + sums[: len(own)]))
                    sums = sums[len(own) :]
                if all(settled):
                    break
        self.taught = [0, 0] if before is None else before.sum(1).astype(int).tolist()
        self.calibrations = self._calibrations(views, labels, held_out)
        both = self._odds(views)
        self.combination = Logistic(both[held_out], labels[held_out])
        good = np.sort(_sigmoid(self.combination.log_odds(both[held_out & (labels == 1)])))
        self.cut = min(CUT, float(good[int((1 - KEEP_GOOD) * len(good))]))

    def _calibrations(self, views, labels, held_out):
        return [Logistic(m.log_odds(v[held_out])[:, None], labels[held_out]) for m, v in zip(self.views, views)]

    def _odds(self, views):
        return np.stack([c.log_odds(m.log_odds(v)[:, None]) for c, m, v in zip(self.calibrations, self.views, views)], axis=1)

    def score(self, views):
        """(probability of good quality by text, by metadata, by both) of each row."""
        odds = self._odds(views)
        return _sigmoid(odds[:, 0]), _sigmoid(odds[:, 1]), _sigmoid(self.combination.log_odds(odds))


class Constant:
    """What is used where nothing can be learnt."""

    cut = 0.0

    def __init__(self, share: float):
        self.share = share

    def score(self, views):
        flat_ = np.full(len(views[0]), self.share)
        return flat_, flat_, flat_


FIELDS = ["doc_id", "text", "lang", "source", "n_chars"]


def _views(batch):
    """The two views of runs of rows of a batch."""
    for a, z in slices(batch.column("text")):
        part = batch.slice(a, z - a)
        yield part, (text_view(part.column("text")), page_view(_places(part)))


def _places(part):
    return page_places(*(part.column(c).to_pylist() for c in FIELDS[2:]))


FEATURES = "doc_id long, text binary, page binary"


def _features(batches):
    for b in batches:
        for a, z in slices(b.column("text")):
            part = b.slice(a, z - a)
            cells = text_view(part.column("text")).astype("<f4"), _places(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array([r.tobytes() for r in c], pa.binary()) for c in cells)], ["doc_id", "text", "page"]
            )


def _read_views(text: list, page: list):
    x = np.frombuffer(b"".join(text), dtype="<f4").reshape(len(text), -1) if text else np.zeros((0, KINDS + PAIRS + 7))
    return x.astype(np.float64), page_view(np.frombuffer(b"".join(page), dtype=np.uint8).reshape(-1, 3))


def _added(features: DataFrame, labelled: np.ndarray):
    """Adds functions of the two views up over all rows but the labelled ids'."""

    def partial_sums(of):
        def run(batches):
            total = None
            for b in batches:
                ids = b.column("doc_id")
                own = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), labelled)
                b = b.filter(pa.array(~own | ids.is_null().to_numpy(zero_copy_only=False)))
                if b.num_rows:
                    sums = of(_read_views(b.column("text").to_pylist(), b.column("page").to_pylist()))
                    total = sums if total is None else total + sums
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        return run

    def merged(batches):
        total = None
        for b in batches:
            for cell in b.column("sums").to_pylist():
                sums = np.frombuffer(cell)
                total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def added(of):
        parts = features.mapInArrow(partial_sums(of), "sums binary").repartition(MERGERS).mapInArrow(merged, "sums binary")
        return sum((np.frombuffer(r["sums"]) for r in parts.collect()), of(_read_views([], [])))  # MERGERS rows at most

    return added


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, seed: int = 5):
    """A classifier from a bounded sample of ``labels`` (doc_id, quality) and all ``docs``."""
    key = F.xxhash64(F.lit(seed), "doc_id")
    clean = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
    )
    some = {r["doc_id"]: float(r["quality"]) for r in clean.orderBy(key, "doc_id").limit(LABELLED).select("doc_id", "quality").collect()}
    if not some:
        return Constant(1.0)
    spark = docs.sparkSession
    scratch = Scratch(spark, "cotraining")
    features = scratch.keep(narrow(docs).mapInArrow(_features, FEATURES))
    chosen = F.broadcast(spark.createDataFrame([(i,) for i in sorted(some)], "doc_id long"))  # LABELLED ids at most
    one = features.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "page")).alias("first"))
    found = sorted(one.select("doc_id", "first.text", "first.page").collect(), key=lambda r: r["doc_id"])
    views = _read_views([r["text"] for r in found], [r["page"] for r in found])
    y = np.array([some[r["doc_id"]] for r in found])
    held_out = np.array([zlib.crc32(str(r["doc_id"]).encode()) % 4 == 0 for r in found], dtype=bool)
    if len(y) and all(min((y[part] == c).sum() for c in (0, 1)) >= LEAST for part in (held_out, ~held_out)):
        model = CoTrained(views, y, held_out, _added(features, np.array(sorted(some))))
    else:
        model = Constant(float(y.mean()) if len(y) else 1.0)
    scratch.drop(features)
    return model


def _scored(model):
    def run(batches):
        for b in batches:
            for part, views in _views(b):
                text, page, both = model.score(views)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(text), pa.array(page), pa.array(both), pa.array(both >= model.cut)],
                    ["doc_id", "p_text", "p_page", "p_good", "kept"],
                )

    return run


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, p_text, p_page, p_good and kept of each document."""
    return narrow(docs).mapInArrow(_scored(model), "doc_id long, p_text double, p_page double, p_good double, kept boolean")


def _filtered(model):
    def run(batches):
        for b in batches:
            at = [b.schema.get_field_index(c) for c in FIELDS]
            for a, z in slices(b.column(at[1])):
                part = b.slice(a, z - a)
                views = text_view(part.column(at[1])), page_view(page_places(*(part.column(i).to_pylist() for i in at[2:])))
                yield part.filter(pa.array(model.score(views)[2] >= model.cut))

    return run


def filter_quality(docs: DataFrame, model) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    return docs.mapInArrow(_filtered(model), docs.schema)


def op7_cotraining_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, trained from ``labels``."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
