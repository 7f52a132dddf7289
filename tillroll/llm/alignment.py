"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the same bytes in their own ways. An interval of both token
sequences is divided at a token end that both have, the nearest to its middle:
the middle token's end is looked up among the other's ends by bisect, then its
neighbours outward in windows that double. Both halves are divided in turn; an
interval without a shared end inside is a leaf, one group. All intervals of a
slice of documents are divided together, a level at a time, in numpy.

Texts are encoded in units: neither tokenizer joins across a space between two
characters that are not white space, so the ids of a unit (a space and the
characters up to the next such space) are the same wherever it stands, and a
worker remembers the units it has met. The vocabularies are checked for that
when they are loaded; otherwise whole texts are encoded.

Counts over the corpus are Spark's: a slice counts its linked id pairs once (its
dictionary), pairs add up by a group-by with partial sums, and each slice's
dictionary gets the sums back through a join by pair, one row for each pair of a
slice however many documents hold it. Documents carry positions in their slice's
dictionary and meet it by slice; a slice is about ``SLICE`` bytes of text or one
longer document, so no task grows with the corpus or with a frequent pair.

Defined results: null and empty texts, and texts whose joined token bytes differ
from the space and the text (those with U+2581, which the piece vocabulary turns
into a space) have zeros and ``''``; a row is a row: repeated rows are aligned
and counted again; ids may be null; an empty table gives no rows; other columns
are not read. Ties of a B id's highest count are all best.
"""

from __future__ import annotations

import json
import re
from array import array
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table
from tillroll.llm.texts import slices

#: Bytes of text that share a dictionary, about.
SLICE = 4 << 20
#: Units that a worker remembers, and ids in its memory, at most.
UNITS, IDS = 400_000, 4_000_000
#: Splits text before the merges of the byte-level vocabulary (a fixed value of its format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPACE = "▁"
#: Where a unit begins, and what shows that plain spaces do not tell units apart.
_UNIT = re.compile(rf"(?<![ {_SPACE}])(?= \S)")
_ODD = re.compile(rf" (?:\s|\Z)|{_SPACE}")


def _byte_symbols() -> dict[str, int]:
    """Symbol of each byte in byte-level vocabularies: printable ones stand for
    themselves, the others take the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteVocabulary:
    """A byte-level vocabulary (JSON): ids of a text and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        symbols = _byte_symbols()
        self.bytes = {i: bytes(symbols[c] for c in t) for t, i in model["vocab"].items()}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the ids of the vocabulary do not follow its merges")
        import tiktoken

        self.encode = tiktoken.Encoding(
            "bytes", pat_str=PATTERN, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={}
        ).encode_ordinary
        self.size = max(self.bytes) + 1

    def joined(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class PieceVocabulary:
    """A piece vocabulary (model file): ids of a text and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode, self.size, self.bytes = model.encode, model.vocab_size(), {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPACE, " ").encode()
        #: Whether a space can only begin a piece, so that units stand alone.
        self.by_unit = not any(re.search(f"[^{_SPACE}]{_SPACE}", model.id_to_piece(i)) for i in range(self.size))

    joined = ByteVocabulary.joined


class Units(dict):
    """Number of each unit (without its space); a new one is encoded when it is asked for."""

    def __init__(self, a: ByteVocabulary, b: PieceVocabulary):
        self.a, self.b = a, b
        self.lengths = [np.array([len(v.bytes.get(i, b"")) for i in range(v.size)]) for v in (a, b)]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids = array("i"), array("i")
        self.sizes = array("i"), array("i")
        self.whole = array("b")  # whether the bytes of both are those of the unit

    def __missing__(self, unit: str) -> int:
        wanted, whole = b" " + unit.encode(), True
        for k, (vocabulary, text) in enumerate(((self.a, " " + unit), (self.b, unit))):
            ids = vocabulary.encode(text)
            self.ids[k].extend(ids)
            self.sizes[k].append(len(ids))
            whole &= vocabulary.joined(ids) == wanted
        self.whole.append(whole)
        self[unit] = n = len(self)
        return n

    def learn(self, new: list[str]) -> None:
        """Encode units that plain spaces divide as one text, cut where they end."""
        text = " ".join(new)
        wanted = (" " + text).encode()
        ends = np.cumsum([len(u.encode()) + 1 for u in new])
        found = []
        for vocabulary, lengths, t in ((self.a, self.lengths[0], " " + text), (self.b, self.lengths[1], text)):
            ids = vocabulary.encode(t)
            at = np.cumsum(lengths[ids])
            last = np.searchsorted(at, ends)
            if vocabulary.joined(ids) != wanted or (at[last] != ends).any():
                return  # one by one, as they are asked for
            found.append((ids, np.diff(last, prepend=-1)))
        for k, (ids, sizes) in enumerate(found):
            self.ids[k].extend(ids)
            self.sizes[k].extend(sizes.tolist())
        self.whole.extend([1] * len(new))
        self.update(zip(new, range(len(self), len(self) + len(new))))

    def of(self, texts: list[str]) -> list[list[int]]:
        """The units of each text; none is empty."""
        divided: list[list[str]] = []
        plain: set[str] = set()
        for text in texts:
            spaced = " " + text
            if not self.b.by_unit:
                divided.append([text])
            elif _ODD.search(spaced):
                divided.append([u[1:] for u in _UNIT.split(spaced) if u])
            else:
                divided.append(text.split(" "))
                plain.update(divided[-1])
        new = [u for u in plain if u not in self]
        for at in range(0, len(new), 5_000):
            self.learn(new[at : at + 5_000])
        return [list(map(self.__getitem__, units)) for units in divided]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), then start[1], ..."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


def _nearest(a_end, b_end, low, middle, high):
    """For each interval the position in low..high nearest to the middle whose end
    ``b_end`` has too (-1: none), and where it has it, in windows of doubling width
    about the middle."""
    at, other, todo, width = np.full(len(low), -1), np.full(len(low), -1), np.arange(len(low)), 1
    while len(todo):
        m = middle[todo]
        first, last = np.maximum(low[todo], m - width + 1), np.minimum(high[todo], m + width - 1)
        size = last - first + 1
        place = _runs(first, size)
        away = place - np.repeat(m, size)
        rank = 2 * np.abs(away) + (away > 0)
        end = a_end[place]
        q = np.searchsorted(b_end, end)
        rank[b_end[q] != end] = np.iinfo(np.int64).max
        begin = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, begin)
        found = best < np.iinfo(np.int64).max
        d = best[found]
        p = m[found] + np.where(d % 2 == 1, 1, -1) * (d // 2)
        at[todo[found]] = p
        other[todo[found]] = q[begin[found] + p - first[found]]
        todo = todo[~found & ((first > low[todo]) | (last < high[todo]))]
        width *= 2
    return at, other


def shared_cuts(a_end, b_end, a_sizes, b_sizes) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the tokens of both sides that end a group. ``a_end`` and ``b_end``
    are the ends of all tokens of some documents one after another, ``a_sizes`` and
    ``b_sizes`` each document's number of tokens (none is 0; both sides of a
    document end together)."""
    a_high, b_high = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_low, b_low = a_high - a_sizes, b_high - b_sizes
    cut_a, cut_b = np.zeros(len(a_end), dtype=bool), np.zeros(len(b_end), dtype=bool)
    cut_a[a_high - 1] = True
    cut_b[b_high - 1] = True
    while True:
        inside = (a_high - a_low > 1) & (b_high - b_low > 1)  # else a leaf
        a_low, a_high, b_low, b_high = (x[inside] for x in (a_low, a_high, b_low, b_high))
        if not len(a_low):
            return cut_a, cut_b
        p, q = _nearest(a_end, b_end, a_low, (a_low + a_high - 2) // 2, a_high - 2)
        found = p >= 0  # the others are leaves
        a_low, a_high, b_low, b_high, p, q = (x[found] for x in (a_low, a_high, b_low, b_high, p, q))
        cut_a[p] = True
        cut_b[q] = True
        a_low, a_high = np.concatenate([a_low, p + 1]), np.concatenate([p + 1, a_high])
        b_low, b_high = np.concatenate([b_low, q + 1]), np.concatenate([q + 1, b_high])


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..size-1, to the right, and which are not leading zeros."""
    width = len(str(max(size - 1, 0)))
    powers = 10 ** np.arange(width)[::-1]
    n = np.arange(size)[:, None]
    shown = n >= powers
    shown[:, -1] = True
    return (n // powers % 10 + ord("0")).astype(np.uint8), shown


def group_texts(a, b, cut_a, cut_b, a_sizes, b_sizes, digits):
    """``a1,a2|b1;a3|b2,b3`` of each document, as bytes."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    upto_a, upto_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1  # ends of groups
    at_a = np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]
    at_b = np.arange(len(b)) + upto_a[group_b]
    n, (figures, shown) = len(a) + len(b), digits
    out = np.empty((n, figures.shape[1] + 1), dtype=np.uint8)
    keep = np.ones(out.shape, dtype=bool)
    for ids, at, cut, mark in ((a, at_a, cut_a, "|"), (b, at_b, cut_b, ";")):
        out[at, :-1] = figures[ids]
        out[at, -1] = np.where(cut, ord(mark), ord(","))
        keep[at, :-1] = shown[ids]
    ends = np.cumsum(a_sizes) + np.cumsum(b_sizes)
    keep[ends - 1, -1] = False
    flat = out[keep]
    byte_ends = np.cumsum(keep.sum(axis=1))[ends - 1]
    return [flat[s:e].tobytes() for s, e in zip(np.concatenate([[0], byte_ends[:-1]]).tolist(), byte_ends.tolist())]


class Aligner:
    """Aligns texts; ``__call__`` takes those of one slice."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteVocabulary(byte_path), PieceVocabulary(piece_path)
        self.units = Units(self.a, self.b)
        self.digits = _digits(max(self.a.size, self.b.size))

    def __call__(self, texts: list[str | None]):
        """Rows of the texts that have tokens; for these the ids of both sides one
        after another, the sizes, and the marks of the groups' ends."""
        if len(self.units) > UNITS or max(map(len, self.units.ids)) > IDS:
            self.units.forget()
        rows = [i for i, t in enumerate(texts) if t]
        units = self.units.of([texts[i] for i in rows])
        if not rows:
            return np.zeros(0, dtype=np.int64), None
        flat = np.fromiter(chain.from_iterable(units), dtype=np.int64)
        each = np.array(list(map(len, units)))
        first = np.cumsum(each) - each
        sides = []
        for ids, sizes in zip(self.units.ids, self.units.sizes):
            pool, size = np.array(ids, dtype=np.int32), np.array(sizes, dtype=np.int64)
            sides.append((pool[_runs((np.cumsum(size) - size)[flat], size[flat])], np.add.reduceat(size[flat], first)))
        good = np.logical_and.reduceat(np.array(self.units.whole, dtype=bool)[flat], first)
        for k in np.flatnonzero(~good):  # the whole text decides
            parts = [i[o[k] - s[k] : o[k]] for i, s, o in ((i, s, np.cumsum(s)) for i, s in sides)]
            spaced = b" " + texts[rows[k]].encode()
            good[k] = all(v.joined(p.tolist()) == spaced for v, p in zip((self.a, self.b), parts))
        if not good.all():
            sides = [(ids[np.repeat(good, s)], s[good]) for ids, s in sides]
        kept = np.array(rows)[good]
        if not len(kept):
            return kept, None
        (a, a_sizes), (b, b_sizes) = sides
        ends = [np.cumsum(n[ids]) for n, ids in zip(self.units.lengths, (a, b))]
        return kept, (a, b, a_sizes, b_sizes, *shared_cuts(*ends, a_sizes, b_sizes))


_SLICED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "slice long, at binary, times binary, pairs array<long>, counts array<long>"
)


def _align(byte_path: str, piece_path: str, most: int):
    def run(batches):
        aligner = Aligner(byte_path, piece_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column("text")
            for first, end in slices(column, most):
                number += 1
                yield _sliced(aligner, number, batch.column("doc_id").slice(first, end - first), column.slice(first, end - first).to_pylist())

    return run


def _sliced(aligner: Aligner, number: int, ids, texts) -> pa.RecordBatch:
    n = len(texts)
    counts = np.zeros((4, n + 1), dtype=np.int64)
    digests, at, times = [""] * n, [b""] * n, [b""] * n
    kept, found = aligner(texts)
    pairs = sums = np.zeros(0, dtype=np.int64)
    if found is not None:
        a, b, a_sizes, b_sizes, cut_a, cut_b = found
        groups = np.add.reduceat(cut_a, np.cumsum(a_sizes) - a_sizes, dtype=np.int64)
        linked = a[cut_a].astype(np.int64) * aligner.b.size + b[cut_b]  # one link a group: its last tokens end together
        pairs, where, sums = np.unique(linked, return_inverse=True, return_counts=True)
        counts[:, kept] = a_sizes, b_sizes, groups, groups
        spelled = group_texts(a, b, cut_a, cut_b, a_sizes, b_sizes, aligner.digits)
        end = np.cumsum(groups)
        for k, row in enumerate(kept.tolist()):
            digests[row] = sha256(spelled[k]).hexdigest()
            own, many = np.unique(where[end[k] - groups[k] : end[k]], return_counts=True)
            at[row], times[row] = own.astype("<u4").tobytes(), many.astype("<u4").tobytes()
    # the last row is the slice's dictionary
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([ids, pa.nulls(1, pa.int64())]),
            *(pa.array(c) for c in counts),
            pa.array([*digests, None], pa.string()),
            pa.array([number] * (n + 1), pa.int64()),
            pa.array([*at, None], pa.binary()),
            pa.array([*times, None], pa.binary()),
            pa.array([None] * n + [pairs], pa.list_(pa.int64())),
            pa.array([None] * n + [sums], pa.list_(pa.int64())),
        ],
        [c.split()[0] for c in _SLICED.split(", ")],
    )


def _summed(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Best links and sums of counts of a slice's documents; ``known`` has the
    corpus counts of its dictionary by position."""
    place = known.column("i").to_numpy()
    count, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    count[place] = known.column("n").to_numpy()
    best[place] = known.column("best").to_numpy()
    n_best, count_sum = [], []
    for at, times in zip(docs.column("at").to_pylist(), docs.column("times").to_pylist()):
        at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int(best[at] @ times))
        count_sum.append(int(count[at] @ times))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def pair_counts(sliced: DataFrame, pieces: int) -> DataFrame:
    """pair (A id times ``pieces`` plus B id), n (its links over the corpus) and
    best (1 where no pair of its B id has more). A B id meets as many A ids as the
    byte vocabulary has at most, so its window is bounded."""
    each = sliced.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip("pairs", "counts")))
    n = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n"))
    of_b = Window.partitionBy(F.col("pair") % pieces)
    return n.withColumn("best", (F.col("n") == F.max("n").over(of_b)).cast("long"))


def align(docs: DataFrame, byte_path: str, piece_path: str, scratch: Scratch, most: int = SLICE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of
    each row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sliced = scratch.keep(texts.mapInArrow(_align(byte_path, piece_path, most), _SLICED))
    counts = pair_counts(sliced, PieceVocabulary(piece_path).size)
    known = (
        sliced.where("pairs IS NOT NULL")
        .select("slice", F.posexplode("pairs").alias("i", "pair"))
        .join(counts, "pair")
        .select(F.col("slice").alias("of_slice"), "i", "n", "best")
    )
    rows = sliced.where("pairs IS NULL").drop("pairs", "counts")
    out = rows.groupBy("slice").cogroup(known.groupBy("of_slice")).applyInArrow(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    """The tokens of all ``documents`` under a byte-level and a piece vocabulary, aligned."""
    return align(table(spark, sf_dir, "documents"), *default_vocabularies(), Scratch(spark, "op13"))
