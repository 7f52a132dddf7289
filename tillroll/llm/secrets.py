"""Secret scan: base patterns, and character Markov models for what they miss.

Candidates are maximal runs of base64 and identifier characters. Each is scored
by the log-likelihood ratio of first-order character Markov models: one for each
kind of random string (hex, base32, base62, base64) against one of ordinary
words and identifiers. The models are trained from labelled samples: random
strings drawn from a fixed seed and the values that the base patterns find, and
the words of all documents, also joined the way identifiers
are (camelCase, snake_case, kebab-case, UPPER_CASE, paths, a number at the end).
Transition counts are summed by Spark; the driver sees a table of fixed size.

Spans are in code points with exclusive ends. Base spans always stay; the models
add spans of kind ``markov`` that meet no base span.

Defined results: null text counts as empty; a row is a row; without documents to
train on the ordinary model is uniform and adds nothing; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import bounded_batches, table
from tillroll.llm.texts import flat, slices

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "markov"]
_HINT = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")

#: Random strings of each kind that train its model.
TRAIN_STRINGS = 4000
#: A candidate has this many characters at least, and its ratio (in nats) is
#: LEAST_RATIO and LEAST_PER_CHARACTER times its length, or more.
CANDIDATE = 16
LEAST_RATIO, LEAST_PER_CHARACTER = 16.0, 0.6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RANDOM = {
    "hex": "0123456789abcdef",
    "base32": ALPHABET[:26] + "234567",
    "base62": ALPHABET[:62],
    "base64": ALPHABET[:64],
    "base64url": ALPHABET[:62] + "_-",
}
SIZE = len(ALPHABET)
_CLASS = np.full(256, 255, dtype=np.uint8)
_CLASS[[ord(c) for c in ALPHABET]] = np.arange(SIZE)
_HEX = np.zeros(256, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True


def runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of maximal runs of True of ``least`` bytes or more, within rows."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros(len(inside), dtype=bool), np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    before &= ~edge[:-1]
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    long = end - start >= least
    start, end = start[long], end[long]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def code_points(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position of a row."""
    if not (row & 0x80).any():
        return at
    return np.concatenate([[0], np.cumsum((row & 0xC0) != 0x80)])[at]


def base_spans(data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, kind, end) by row, by the base patterns, in code points."""
    raw = data.tobytes()
    out: dict[int, list[tuple[int, int, int]]] = {}

    def rows_of(places):
        return sorted(set((np.searchsorted(offsets, np.array(places), "right") - 1).tolist())) if places else []

    def text(r):
        return raw[offsets[r] : offsets[r + 1]].decode("utf-8")

    for r in rows_of([m.start() for m in _HINT.finditer(raw.lower())]):
        for m in ASSIGN.finditer(text(r)):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                out.setdefault(r, []).append((m.start(), 0, m.end()))
    places, at = [], raw.find(b"AKIA")
    while at >= 0:
        places.append(at)
        at = raw.find(b"AKIA", at + 1)
    for r in rows_of(places):
        for m in ACCESS.finditer(text(r)):
            if m.end() - m.start() >= ACCESS_LEAST:
                out.setdefault(r, []).append((m.start(), 1, m.end()))
    for r, spans in _by_row(*runs(_HEX[data], offsets, HEX_LEAST), data, offsets):
        out.setdefault(r, []).extend((s, 2, e) for s, e, _, _ in spans)
    return out


def _by_row(start, end, row, data, offsets):
    """(row, [(start, end in code points, start, end in bytes of the batch)])."""
    for r in np.unique(row).tolist():
        own = row == r
        s, e = start[own], end[own]
        line = data[offsets[r] : offsets[r + 1]]
        cs, ce = code_points(line, s - offsets[r]), code_points(line, e - offsets[r])
        yield r, list(zip(cs.tolist(), ce.tolist(), s.tolist(), e.tolist()))


def _identifiers(words: list[str]) -> list[str]:
    """Identifiers built of neighbouring words, in the usual styles."""
    out = []
    for i in range(0, len(words) - 2, 3):
        a, b, c = words[i : i + 3]
        out += [a + b.capitalize() + c.capitalize(), a.capitalize() + b.capitalize() + c.capitalize()]
        out += [f"{a}_{b}_{c}", f"{a}-{b}-{c}", f"{a}/{b}/{c}", f"{a}_{b}_{c}".upper(), f"{a}{b.capitalize()}{i % 100}"]
    return out


def _transitions(tokens: list[str]) -> np.ndarray:
    """Counts of neighbouring characters; a token's start counts as its first character alone."""
    data = np.frombuffer(" ".join(tokens).encode("ascii", "replace"), dtype=np.uint8)
    code = _CLASS[data].astype(np.int64)
    both = (code[:-1] < 255) & (code[1:] < 255)
    return np.bincount(code[:-1][both] * SIZE + code[1:][both], minlength=SIZE * SIZE)


_WORD = re.compile(rf"[{re.escape(ALPHABET)}]+")


def _training(batches):
    """(label, cell, n): transitions of ordinary tokens and of base values."""
    ordinary, secret = np.zeros(SIZE * SIZE, dtype=np.int64), np.zeros(SIZE * SIZE, dtype=np.int64)
    for b in batches:
        column = b.column("text")
        for a, z in slices(column):
            part = column.slice(a, z - a)
            spans = base_spans(*flat(part))
            for r, text in enumerate(part.to_pylist()):
                text, at, plain = text or "", 0, []
                for start, kind, end in sorted(spans.get(r, [])):
                    if kind == 0:
                        m = ASSIGN.match(text, start)
                        secret += _transitions([m.group(2)])
                    else:
                        secret += _transitions([text[start:end]])
                    plain.append(text[at : max(at, start)])
                    at = max(at, end)
                plain.append(text[at:])
                words = _WORD.findall(" ".join(plain))
                ordinary += _transitions(words) + _transitions(_identifiers(words))
    for label, counts in (("ordinary", ordinary), ("secret", secret)):
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(cells), pa.string()), pa.array(cells), pa.array(counts[cells])], ["label", "cell", "n"]
        )


def _log_model(counts: np.ndarray, smooth: float) -> np.ndarray:
    counts = counts.reshape(SIZE, SIZE) + smooth
    return np.log(counts / counts.sum(1, keepdims=True))


def train(docs: DataFrame, seed: int = 3) -> np.ndarray:
    """(kinds, SIZE, SIZE) log-likelihood ratios of a character after another."""
    counts = (
        docs.select("text")
        .mapInArrow(_training, "label string, cell long, n long")
        .groupBy("label", "cell")
        .agg(F.sum("n").alias("n"))
        .collect()  # two tables of SIZE * SIZE counts at most
    )
    ordinary, secret = np.zeros(SIZE * SIZE), np.zeros(SIZE * SIZE)
    for c in counts:
        (ordinary if c["label"] == "ordinary" else secret)[c["cell"]] = c["n"]
    if not ordinary.any():
        return np.full((len(RANDOM), SIZE, SIZE), -1.0)
    rng = np.random.Generator(np.random.PCG64(seed))
    base = _log_model(ordinary, 0.5)
    models = []
    for letters in RANDOM.values():
        drawn = rng.integers(0, len(letters), (TRAIN_STRINGS, 40))
        strings = ["".join(letters[i] for i in x) for x in drawn.tolist()]
        own = np.zeros((SIZE, SIZE))
        inside = [ALPHABET.index(c) for c in letters]
        own[np.ix_(inside, inside)] = secret.reshape(SIZE, SIZE)[np.ix_(inside, inside)]
        if own.sum():  # values found count as much as the strings drawn, at most
            own *= min(1.0, TRAIN_STRINGS * 40 / own.sum())
        models.append(_log_model(_transitions(strings) + own.ravel(), 0.05) - base)
    return np.stack(models)


def _scan(ratios: np.ndarray):
    def added(data, offsets):
        """Row's (start, end in code points) of runs that the models call random."""
        code = _CLASS[data]
        start, end, row = runs(code < 255, offsets, CANDIDATE)
        if not len(start):
            return {}
        size = end - start
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        chars = code[at].astype(np.int64)
        first = np.cumsum(size) - size
        pair = chars[:-1] * SIZE + chars[1:]
        best = np.full(len(start), -np.inf)
        for table_ in ratios:
            step = np.append(table_.ravel()[pair], 0.0)
            step[first + size - 1] = 0.0  # no step from one run to the next
            best = np.maximum(best, np.add.reduceat(step, first))
        letters = np.add.reduceat((chars < 52).astype(np.int64), first) > 0
        hit = letters & (best >= np.maximum(LEAST_RATIO, LEAST_PER_CHARACTER * size))
        return dict(_by_row(start[hit], end[hit], row[hit], data, offsets))

    def run(batches):
        for b in batches:
            ids, column = b.column("doc_id"), b.column("text")
            for a, z in slices(column):
                data, offsets = flat(column.slice(a, z - a))
                base, more = base_spans(data, offsets), added(data, offsets)
                out = [[], [], [], [], []]
                for r in range(z - a):
                    own = sorted(base.get(r, []))
                    every = own
                    if r in more:
                        line = data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8")
                        new = []
                        for s, e, _, _ in more[r]:
                            e += len(line[e : e + 2]) - len(line[e : e + 2].lstrip("="))  # padding of base64
                            if not any(s < y and x < e for x, _, y in own):
                                new.append((s, 3, e))
                        every = sorted(own + new)
                    for o, kind in zip(out, range(3)):
                        o.append(sum(k == kind for _, k, _ in own))
                    out[3].append(hashlib.sha256(_join(own).encode()).hexdigest())
                    out[4].append(_join(every))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), *(pa.array(o, pa.int64()) for o in out[:3]), *(pa.array(o, pa.string()) for o in out[3:])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return run


def _join(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, counts by base kind, base_sha256 and spans of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(ratios), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def op1_markov_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
