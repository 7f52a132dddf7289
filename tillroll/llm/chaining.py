"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Seeds are k-mers of ``K`` words of each whole text: those whose hash is among a
``SHARE`` of all, and the least of every window of ``WINDOW``, so any shared stretch
of K + WINDOW - 1 words shares a seed. A seed that stands in several documents links each of them to
the least id that holds it, so a passage with any number of holders costs its
holders, not their pairs; holders that no passage covers then are linked to the
next least of them, ``ROUNDS`` times in all. What is still uncovered is compared
without a cap: documents that share two seeds a chain's least span apart, or more, are
paired where ``FEW`` or fewer share them; of more, each is paired with the least, and those
that also share a further seed close by are taken apart in the same way, until no such
seed is left. Pairs are aligned where sketches of the words around show as many equal
pairs of neighbouring words as a passage leaves. The matches of a pair of documents are merged along
diagonals and chained in order in both texts at the best score under a linear
gap cost, with a Fenwick tree of prefix maxima; several chains of a pair are
taken best first. Chains are then aligned on the texts word by word: gaps between
their fragments by edit alignment, the ends by extension, and kept as passages
by length and identity; a chain of too low an identity is cut into the longest
parts that have it.

Defined results: null text counts as empty; rows with a null id are left out;
rows that repeat an id are one document with the seeds of all (only its own
texts that hold a chain's words align); texts with fewer than ``MIN_WORDS`` words
hold no passage; repeats inside one document are no matches; an empty table
gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table
from tillroll.llm.texts import _WEIGHT, flat, mix, slices, words

#: Words of a seed, and seeds of a window of which the least is taken.
K, WINDOW = 4, 8
#: Besides, seeds whose hash is among this share of all hashes are taken, whatever
#: stands beside them: an edit next to a seed does not lose it.
SHARE = 0.5
#: A passage has this many words on both sides, and this share of them aligned, or more.
MIN_WORDS, MIN_IDENTITY = 40, 0.8
#: Times that the holders of a seed, where no passage covers them, are linked to the
#: least of them that no round before had as the least; all others are paired after that.
ROUNDS = 2
#: Two seeds, or more, of so many uncovered holders or fewer pair all of them, others are
#: narrowed by a further seed; the seeds lie within so many bytes of each other.
FEW, STRETCH = 32, 250
#: Bits of a sketch of the words around a seed. Of the 39 pairs of neighbouring words of a
#: passage of ``MIN_WORDS``, 8 edits leave 23; documents with fewer equal bits are no pair.
WIDTH, LEAST_ALIKE = 1024, 16
#: Matches of a seed's places in two documents of which all are taken.
REPEATS = 256
#: Cost of a byte of gap on either side, in words of seed.
GAP = 0.016
#: Least bytes from a chain's first to its last seed (both sides) for it to be aligned.
LEAST_SPAN = 40
#: Bytes around a chain in which its passage's ends are looked for.
MARGIN = 700
#: Spark removes a query's shuffle files when the query has ended, not when the driver
#: next collects garbage: the steps' shuffles do not add up on disk.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: An extension stops where its score (1 a match, -1 a mismatch) has fallen by this.
DROP = 8


def seeds_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and byte position of the k-mers of each text that are winnowed or
    have a small hash."""
    start, _, row, hashes = words(*flat(column))
    n = len(hashes) - K + 1
    none = np.zeros(0, dtype=np.int64)
    if n < WINDOW:
        return none.astype(np.uint64), none, none
    mer = np.zeros(n, dtype=np.uint64)
    for j in range(K):
        mer += hashes[j : n + j] * _WEIGHT[j]
    mer = mix(mer)
    # a window must lie inside one text
    m = n - WINDOW + 1
    inside = row[:m] == row[K + WINDOW - 2 :]
    least = mer[:m].copy()
    for j in range(1, WINDOW):
        np.minimum(least, mer[j : m + j], out=least)
    taken = (mer < np.uint64(int(SHARE * 2**64))) & (row[:n] == row[K - 1 :])
    for j in range(WINDOW):
        taken[j : m + j] |= inside & (mer[j : m + j] == least)
    taken[1:] &= mer[1:] != mer[:-1]  # a run of one word counts once
    at = np.flatnonzero(taken)
    return mer[at], row[at], start[at]


def _seeds(batches):
    for b in batches:
        ids, text = b.column("doc_id").to_numpy(), b.column("text")
        for a, z in slices(text):
            part = text.slice(a, z - a)
            seed, row, at = seeds_of(part)
            _, offsets = flat(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed.view(np.int64)), pa.array(ids[a:z][row]), pa.array((at - offsets[row]).astype(np.int32))],
                ["seed", "doc", "at"],
            )


class PrefixMaxima:
    """A Fenwick tree of the best (score, index) among positions up to a given one."""

    def __init__(self, n: int):
        self.best = [(-1e300, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        best, n = self.best, len(self.best)
        i += 1
        while i < n:
            if best[i][0] < value[0]:
                best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """The best among positions below ``i``."""
        best, out = self.best, (-1e300, -1)
        while i > 0:
            if best[i][0] > out[0]:
                out = best[i]
            i -= i & -i
        return out


def fragments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(first x, last x, first y, last y, seeds) of runs of matches on one diagonal."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    far = (np.diff(x - y) != 0) | (np.diff(x) > 8 * (K + 2 * WINDOW))
    edges = np.concatenate([[0], np.flatnonzero(far) + 1, [len(x)]])
    out = [(int(x[a]), int(x[z - 1]), int(y[a]), int(y[z - 1]), int(z - a)) for a, z in zip(edges[:-1], edges[1:])]
    return sorted(out)


def chains(x: np.ndarray, y: np.ndarray) -> list[list[tuple[int, int, int, int, int]]]:
    """Collinear chains of the matches (x, y) of a pair, best first."""
    parts = fragments(x, y)
    if len(parts) == 1:
        return [parts]
    ys = sorted({p[3] for p in parts})
    rank = {v: i for i, v in enumerate(ys)}
    below = np.searchsorted(ys, [p[2] for p in parts]).tolist()  # ends strictly before a start
    tree = PrefixMaxima(len(ys))
    score, back = [0.0] * len(parts), [-1] * len(parts)
    ending = sorted(range(len(parts)), key=lambda i: parts[i][1])
    e = 0
    for i, (fx, lx, fy, ly, n) in enumerate(parts):
        while e < len(ending) and parts[ending[e]][1] < fx:
            j = ending[e]
            tree.put(rank[parts[j][3]], (score[j] + GAP * (parts[j][1] + parts[j][3]), j))
            e += 1
        best, j = tree.upto(below[i])
        own = K + (lx - fx) / 6.0
        gain = best - GAP * (fx + fy)
        score[i], back[i] = (own + gain, j) if gain > 0 else (own, -1)
    out, used = [], [False] * len(parts)
    for i in sorted(range(len(parts)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(parts[i])
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


CHAIN = "doc long, other long, x array<int>, lx array<int>, y array<int>, ly array<int>"


def _chained(batches):
    """Rows come sorted by (doc, other): the matches of a pair are one run."""

    def finish(doc, other, x, y):
        for c in chains(x, y):
            n = sum(p[4] for p in c)
            if n >= 2 and min(c[-1][1] - c[0][0], c[-1][3] - c[0][2]) >= LEAST_SPAN:
                yield doc, other, [p[0] for p in c], [p[1] for p in c], [p[2] for p in c], [p[3] for p in c]

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 4)
        cols = list(zip(*rows)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["doc", "other", "x", "lx", "y", "ly"])

    held = None
    for b in batches:
        doc, other, x, y = (b.column(c).to_numpy() for c in ("doc", "other", "x", "y"))
        if held is not None:
            doc, other, x, y = (np.concatenate([p, q]) for p, q in zip(held, (doc, other, x, y)))
        if not len(doc):
            continue
        edges = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])]))
        rows = []
        wide = np.minimum(*(np.maximum.reduceat(v, edges) - np.minimum.reduceat(v, edges) for v in (x, y))) >= LEAST_SPAN
        for a, z, spans in zip(edges[:-1].tolist(), edges[1:].tolist(), wide.tolist()):
            if z - a > 1 and spans:
                rows.extend(finish(int(doc[a]), int(other[a]), x[a:z], y[a:z]))
        a = edges[-1]
        held = (doc[a:], other[a:], x[a:], y[a:])
        yield batch(rows)
    if held is not None and len(held[0]) > 1:
        yield batch(list(finish(int(held[0][0]), int(held[1][0]), held[2], held[3])))


def matched_words(x: list[int], y: list[int]) -> int:
    """Equal words in the best alignment of two runs of words: the length of their
    longest common subsequence, a bit of a number for each word of the longer run
    (Hyyrö, Bit-parallel LCS-length computation revisited, 2004)."""
    if len(x) < len(y):
        x, y = y, x
    common = set(y)
    x = [w for w in x if w in common]
    places: dict[int, list[int]] = {}
    for i, w in enumerate(x):
        places.setdefault(w, []).append(i)
    # numbers as long as the run are kept for frequent words only
    bits = {w: sum(1 << i for i in at) for w, at in places.items() if len(at) > 4}
    every = (1 << len(x)) - 1
    free = every
    for w in y:
        if w in places:
            held = free & (bits.get(w) or sum(1 << i for i in places[w]))
            free = ((free + held) | (free - held)) & every
    return len(x) - free.bit_count()


def _extend(x: np.ndarray, y: np.ndarray, loss: int = 1) -> tuple[int, int]:
    """(words, matches) of the best gapless extension along x and y from their
    starts, where a match scores 1 and a mismatch ``-loss``."""
    n = min(len(x), len(y))
    if not n:
        return 0, 0
    same = x[:n] == y[:n]
    score = np.cumsum(np.where(same, 1, -loss))
    fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score >= DROP * loss)
    end = int(fallen[0]) if len(fallen) else n
    if not end or score[:end].max() <= 0:
        return 0, 0
    stop = int(score[:end].argmax()) + 1
    return stop, int(same[:stop].sum())


def exact_runs(x, y, sx, sy, parts) -> list[tuple[int, int, int]]:
    """(first x, first y, words) of the runs of equal words on the diagonals of a
    chain's fragments, in order in both texts. ``sx`` and ``sy`` are the words' first
    bytes, ``parts`` word indices (first x, end x, first y, end y)."""
    out: list[tuple[int, int, int]] = []
    ax = ay = 0
    for bx, ex, by, ey in parts:
        # words at one distance from the fragment's start in bytes, whatever their number
        _, i, j = np.intersect1d(sx[bx:ex] - sx[bx], sy[by:ey] - sy[by], assume_unique=True, return_indices=True)
        i, j = i + bx, j + by
        same = (x[i] == y[j]) & (i >= ax) & (j >= ay)  # the later of overlapping fragments gives way
        i, j = i[same], j[same]
        if not len(i):
            continue
        edges = np.concatenate([[0], np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1, [len(i)]])
        out += [(int(i[a]), int(j[a]), int(z - a)) for a, z in zip(edges[:-1], edges[1:])]
        ax, ay = int(i[-1]) + 1, int(j[-1]) + 1
    return out


def _longest(surplus: np.ndarray, lost: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[int, int]:
    """(first, last) of the longest row of runs whose surplus, less what the gaps
    between them lose, is not negative."""
    before = np.concatenate([[0.0], np.cumsum(surplus[:-1] - lost)])  # up to the start of each run
    best = np.maximum.accumulate((before + surplus)[::-1])  # at the end of a run or of a later one
    last = len(before) - 1 - np.searchsorted(best, before - 1e-9)
    i = int((end[last] - first).argmax())
    return i, int(last[i])


def passages(x: np.ndarray, y: np.ndarray, runs: list[tuple[int, int, int]]):
    """(first x, end x, first y, end y, matched) in words of the parts of a chain that
    have ``MIN_WORDS`` words and ``MIN_IDENTITY``: the whole chain, or else its longest
    row of runs that has the identity, and so on to the left and right of that."""
    gaps = [
        (max(b[0] - a[0], b[1] - a[1]) - a[2], matched_words(x[a[0] + a[2] : b[0]].tolist(), y[a[1] + a[2] : b[1]].tolist()))
        for a, b in zip(runs, runs[1:])
    ]
    at, size = np.array(runs), np.array([r[2] for r in runs])
    wide, equal = (np.array([g[k] for g in gaps], dtype=np.int64) for k in (0, 1))
    matched = np.concatenate([[0], np.cumsum(size[:-1] + equal)])

    def kept(i, j, low, high, losses):
        """Runs i to j with extensions inside ``low`` and ``high`` (x, y)."""
        fx, fy, tx, ty = int(at[i, 0]), int(at[i, 1]), int(at[j, 0] + size[j]), int(at[j, 1] + size[j])
        for loss in losses:
            left, gained = _extend(x[low[0] : fx][::-1], y[low[1] : fy][::-1], loss)
            right, more = _extend(x[tx : high[0]], y[ty : high[1]], loss)
            span = (tx + right - fx + left, ty + right - fy + left)
            n = int(matched[j] - matched[i] + size[j]) + gained + more
            if min(span) >= MIN_WORDS and n >= MIN_IDENTITY * max(span):
                return fx - left, tx + right, fy - left, ty + right, n
            if n < MIN_IDENTITY * MIN_WORDS:  # at a higher loss an extension is no longer
                break
        return None

    whole = kept(0, len(runs) - 1, (0, 0), (len(x), len(y)), (1, 4) if len(runs) == 1 else (1,))
    if whole:
        yield whole
    if whole or len(runs) == 1:
        return
    todo = [(0, len(runs), (0, 0), (len(x), len(y)))]
    while todo:
        a, z, low, high = todo.pop()
        if a >= z or min(high[0] - low[0], high[1] - low[1]) < MIN_WORDS:
            continue
        # a gap counts its longer side, so a row without loss has the identity
        part, between = slice(a, z), slice(a, z - 1)
        i, j = _longest(
            (1 - MIN_IDENTITY) * size[part], MIN_IDENTITY * wide[between] - equal[between], at[part, 0], at[part, 0] + size[part]
        )
        i, j = i + a, j + a
        found = kept(i, j, low, high, (1, 4))  # at a loss of 4 an extension has the identity itself
        if found:
            yield found
            begin, end = (found[0], found[2]), (found[1], found[3])
        else:
            begin, end = (int(at[i, 0]), int(at[i, 1])), (int(at[j, 0] + size[j]), int(at[j, 1] + size[j]))
        # an extension ends before a row's neighbours or takes some of their words
        l, r = i, j + 1
        while l > a and (at[l - 1, 0] + size[l - 1] > begin[0] or at[l - 1, 1] + size[l - 1] > begin[1]):
            l -= 1
        while r < z and (at[r, 0] < end[0] or at[r, 1] < end[1]):
            r += 1
        todo += [(a, l, low, begin), (r, z, end, high)]


def _side(column, cut_left, cut_right):
    """Words of each slice: hashes and byte spans; a word at a cut is left out."""
    data, offsets = flat_binary(column)
    start, end, row, hashes = words(data, offsets)
    edges = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for r in range(len(offsets) - 1):
        a, z = int(edges[r]), int(edges[r + 1])
        a, z = a + bool(cut_left[r]), z - bool(cut_right[r])
        z = max(a, z)
        out.append((hashes[a:z], start[a:z] - offsets[r], end[a:z] - offsets[r], data[offsets[r] : offsets[r + 1]]))
    return out


def flat_binary(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _code_points(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


FOUND = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ("other_id", pa.int64()), ("other_start", pa.int64()), ("other_end", pa.int64()),
    ("words", pa.int64()), ("matched", pa.int64()), ("identity", pa.float64()),
    ("at", pa.int32()), ("stop", pa.int32()),
]
PASSAGE = (
    "doc_id long, start long, end long, other_id long, other_start long, other_end long, "
    "words long, matched long, identity double, at int, stop int"
)


def _aligned(batches):
    for b in batches:
        if not b.num_rows:
            continue
        sides = []
        for s in ("x", "y"):
            low, high, size = (b.column(f"{s}_{c}").to_numpy() for c in ("low", "high", "size"))
            sides.append((_side(b.column(f"{s}_part"), low > 0, high < size), low, b.column(f"{s}_chars").to_numpy()))
        (xs, xlow, xchars), (ys, ylow, ychars) = sides
        rows = []
        for r, (doc, other, *at) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc", "other", "x", "lx", "y", "ly")))):
            (hx, sx, ex, dx), (hy, sy, ey, dy) = xs[r], ys[r]
            index = []
            for values, start, low in ((at[0], sx, xlow), (at[1], sx, xlow), (at[2], sy, ylow), (at[3], sy, ylow)):
                values = np.array(values) - low[r]
                place = np.searchsorted(start, values)
                if len(start) and (place < len(start)).all() and (start[place] == values).all():
                    index.append(place.tolist())
            if len(index) < 4:
                continue  # another text of a repeated id
            parts = [(a, z + K, c, d + K) for a, z, c, d in zip(*index)]
            if parts[-1][1] > len(hx) or parts[-1][3] > len(hy):
                continue
            runs = exact_runs(hx, hy, sx, sy, parts)
            for fx, tx, fy, ty, matched in passages(hx, hy, runs) if runs else ():
                count = max(tx - fx, ty - fy)
                row = [doc]
                for first, f, t, start, end, data, chars in (
                    (at[0][0] - xlow[r], fx, tx, sx, ex, dx, xchars[r]),
                    (at[2][0] - ylow[r], fy, ty, sy, ey, dy, ychars[r]),
                ):
                    # code points from the chain's first seed, which a passage may begin after
                    low, high = sorted((int(start[f]), int(first)))
                    begin = int(chars) + (1 if start[f] > first else -1) * _code_points(data[low:high])
                    row += [begin, begin + _code_points(data[start[f] : end[t - 1]]), other]
                at_byte = int(xlow[r])  # bytes of the passage in the document itself
                rows.append((*row[:-1], count, matched, matched / count, at_byte + int(sx[fx]), at_byte + int(ex[tx - 1])))
        cols = list(zip(*rows)) if rows else [[]] * len(FOUND)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(cols, FOUND)], [n for n, _ in FOUND])


def _with_part(chain: DataFrame, docs: DataFrame, side: str, key: str) -> DataFrame:
    """Joins the part of a text around a chain: bytes, place, the text's size and
    the code points before the first seed. Cut where Spark joins, not in Python."""
    text = docs.select(F.col("doc_id").alias(key), F.col("text").cast("binary").alias("_bytes"))
    first, last = F.element_at(side, 1), F.element_at(f"l{side}", -1)
    return (
        chain.join(text, key)
        .withColumn(f"{side}_size", F.octet_length("_bytes"))
        .withColumn(f"{side}_low", F.greatest(first - MARGIN, F.lit(0)))
        .withColumn(f"{side}_high", F.least(last + MARGIN, F.col(f"{side}_size")))
        .withColumn(f"{side}_part", F.expr(f"substring(_bytes, {side}_low + 1, greatest({side}_high - {side}_low, 0))"))
        .withColumn(f"{side}_chars", F.char_length(F.expr(f"cast(substring(_bytes, 1, element_at({side}, 1)) AS string)")))
        .drop("_bytes")
    )


def _uncovered(batches):
    """Rows come sorted by (doc, at, stop descending): the seeds that start in no
    passage, whose rows have a stop."""
    doc_now, covered = None, -1
    for b in batches:
        doc, at, stop = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "at", "stop"))
        if not len(doc):
            continue
        # ends of passages, made to grow with the document so that one running maximum does
        group = np.cumsum(np.concatenate([[doc_now is not None and int(doc[0]) != doc_now], doc[1:] != doc[:-1]]))
        ends = (group << 32) + stop
        ends[0] = max(int(ends[0]), covered if not group[0] else -1)
        reach = np.maximum.accumulate(ends) - (group << 32)
        free = (stop < 0) & (reach <= at)
        doc_now, covered = int(doc[-1]), int(reach[-1])
        yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(free)) for c in ("seed", "doc", "at")], ["seed", "doc", "at"])


def _passages(matches: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The matches (doc, other, x, y) of each pair chained, the chains aligned."""
    found = scratch.keep(
        matches.repartition("doc", "other").sortWithinPartitions("doc", "other").mapInArrow(_chained, CHAIN)
    )
    both = _with_part(_with_part(found, docs, "x", "doc"), docs, "y", "other")
    passages = scratch.keep(both.mapInArrow(_aligned, PASSAGE))
    scratch.drop(found)
    return passages


def _linked(seeds: DataFrame, docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Passages by links of each seed's holders to the least of them, and the seeds
    that were linked."""
    # the aggregates are written before they are joined: a join with a plain table is
    # one whose hot seeds Spark can split
    holders = seeds.groupBy("seed").agg(F.min("doc").alias("other"), F.max("doc").alias("_last"))
    holders = scratch.keep(holders.where("other < _last").drop("_last"))
    held = scratch.keep(seeds.join(holders, "seed"))
    scratch.drop(holders)
    first = scratch.keep(held.where("doc = other").groupBy("seed").agg(F.min("at").alias("y")))
    matches = held.where("doc <> other").join(first, "seed").select("doc", "other", F.col("at").alias("x"), "y")
    passages = _passages(matches, docs, scratch)
    scratch.drop(first)
    return passages, held


def _keys(batches):
    """Rows come sorted by (doc, at, seed): a key for each two seeds of a document that
    start ``LEAST_SPAN`` to ``LEAST_SPAN + STRETCH`` bytes apart."""
    tail = None
    for b in batches:
        seed, doc, at = (b.column(c).to_numpy() for c in ("seed", "doc", "at"))
        if not len(doc):
            continue
        old = 0
        if tail is not None:
            seed, doc, at = (np.concatenate([p, q]) for p, q in zip(tail, (seed, doc, at)))
            old = len(tail[0])
        again = (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]) & (seed[1:] == seed[:-1])
        kept = np.concatenate([[True], ~again])  # rows of repeated ids; none of the tail repeats
        seed, doc, at = seed[kept], doc[kept], at[kept]
        first, second = [], []
        for k in range(1, len(doc)):
            apart = np.where(doc[k:] == doc[:-k], at[k:] - at[:-k], 1 << 30)
            if apart.min() > LEAST_SPAN + STRETCH:
                break
            i = np.flatnonzero((apart >= LEAST_SPAN) & (apart <= LEAST_SPAN + STRETCH))
            i = i[i + k >= old]  # others came with the batch before
            first.append(i)
            second.append(i + k)
        i, j = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (first, second))
        key = mix(seed[i].view(np.uint64) * _WEIGHT[0] + seed[j].view(np.uint64) * _WEIGHT[1])
        near = (doc == doc[-1]) & (at >= at[-1] - LEAST_SPAN - STRETCH)
        tail = seed[near], doc[near], at[near]
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *map(pa.array, (doc[i], at[i], at[j]))], ["key", "doc", "lo", "hi"])


def sketch(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A bit set of the pairs of neighbouring words among ``MIN_WORDS`` words before and
    after each of ``places`` (indices of a text's words), as 64-bit numbers. A pair's second
    occurrence is another than its first, so equal bits count pairs as often as both sides
    have them, but for bits that several pairs set."""
    n = len(hashes) - 1
    if n < 1:
        return np.zeros((len(places), WIDTH // 64), dtype=np.int64)
    at = places[:, None] + np.arange(-MIN_WORDS, MIN_WORDS + K - 1)
    pair = mix(hashes[:-1] * _WEIGHT[0] + hashes[1:] * _WEIGHT[1])
    pair = np.where((at >= 0) & (at < n), pair[np.clip(at, 0, n - 1)], np.uint64(0))
    pair.sort(axis=1)
    step = np.arange(pair.shape[1])
    new = np.concatenate([np.ones((len(pair), 1), bool), pair[:, 1:] != pair[:, :-1]], axis=1)
    nth = step - np.maximum.accumulate(np.where(new, step, 0), axis=1)
    bit = (mix(pair + nth.astype(np.uint64) * _WEIGHT[2]) % np.uint64(WIDTH)).astype(np.int64)
    out = np.zeros((len(pair), WIDTH), dtype=bool)
    row, col = np.nonzero(pair)
    out[row, bit[row, col]] = True
    return np.packbits(out, axis=1).view(np.int64)


SKETCH = [f"s{k}" for k in range(WIDTH // 64)]


def _sketches(batches):
    for b in batches:
        doc, text, places = b.column("doc").to_numpy(), b.column("text"), b.column("places")
        for a, z in slices(text):
            data, offsets = flat(text.slice(a, z - a))
            start, _, row, hashes = words(data, offsets)
            edges = np.searchsorted(row, np.arange(z - a + 1))
            for r in range(z - a):
                own = slice(edges[r], edges[r + 1])
                at = np.sort(np.asarray(places[a + r].values.to_numpy()))
                begin = start[own] - offsets[r]
                at = at[np.isin(at, begin)]  # others are places in another text of the id
                for part in range(0, len(at), 4096):
                    some = at[part : part + 4096]
                    bits = sketch(hashes[own], np.searchsorted(begin, some))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), doc[a + r])), pa.array(some.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in bits.T)],
                        ["doc", "at", *SKETCH],
                    )


def _alike(rows: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, other) of the rows (same, doc, places, n, least) that share a key and enough
    pairs of words around it: all of a key of ``FEW`` documents or fewer, of others those
    with the least document of the key. Keys of the same documents are one."""
    rows = rows.select(F.col("same").alias("key"), "doc", "n", "least", F.explode("places").alias("at")).distinct()
    places = scratch.keep(rows.groupBy("doc").agg(F.collect_set("at").alias("places")))
    texts = docs.select(F.col("doc_id").alias("doc"), "text").join(places, "doc")
    made = scratch.keep(texts.mapInArrow(_sketches, "doc long, at int, " + ", ".join(f"{c} long" for c in SKETCH)))
    # a key has the words of all its places, a place those of all texts of a repeated id
    rows = rows.join(made, ["doc", "at"]).groupBy("key", "doc")
    rows = scratch.keep(rows.agg(F.max("n").alias("n"), F.max("least").alias("least"), *(F.bit_or(c).alias(c) for c in SKETCH)))
    scratch.drop(places, made)
    few, many = rows.where(F.col("n") <= FEW), rows.where(F.col("n") > FEW)
    their = [F.col("doc").alias("other"), *(F.col(c).alias(f"t{c}") for c in SKETCH)]
    equal = F.expr(" + ".join(f"bit_count({c} & t{c})" for c in SKETCH)) >= LEAST_ALIKE
    few = few.join(few.select("key", *their), "key").where("other < doc").where(equal)
    many = many.join(many.where("doc = least").select("key", *their), "key").where("other < doc").where(equal)
    pairs = scratch.keep(few.select("doc", "other").unionByName(many.select("doc", "other")).distinct())
    scratch.drop(rows)
    return pairs


def _narrowed(held: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Rows (key, doc, lo, hi, places, n, least, same) of the keys that several documents share: two
    seeds that a chain's least span apart, and for a key of more than ``FEW`` documents
    each further seed close by that only some of them hold, until none is left."""
    rows = held.repartition("doc").sortWithinPartitions("doc", "at", "seed").mapInArrow(_keys, "key long, doc long, lo int, hi int")
    rows = rows.groupBy("key", "doc").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set("lo").alias("places"))
    rows, out, groups = rows.withColumn("of", F.lit(1 << 62)), [], None
    while True:
        written = scratch.keep(rows)
        if groups is not None:
            scratch.drop(groups)
        # keys of the same documents are narrowed as one
        same = F.xxhash64(F.count("doc"), F.min("doc"), F.bit_xor(F.xxhash64("doc")), F.bit_xor(F.xxhash64("doc", F.lit(1))))
        keys = written.groupBy("key").agg(F.count("doc").alias("n"), F.min("doc").alias("least"), same.alias("same"), F.max("of").alias("of"))
        keys = scratch.keep(keys.where("n > 1 AND n < of").drop("of"))
        out.append(scratch.keep(written.drop("of").join(keys, "key")))
        scratch.drop(written, keys)
        groups = out[-1].where(F.col("n") > FEW).groupBy("same", "doc")
        groups = scratch.keep(groups.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("of")))
        if groups.isEmpty():
            scratch.drop(groups)
            return out
        near = groups.join(held, "doc").where(F.col("at").between(F.col("lo") - STRETCH, F.col("hi") + STRETCH))
        rows = near.groupBy(F.xxhash64("same", "seed").alias("key"), "doc").agg(
            F.least(F.min("lo"), F.min("at")).alias("lo"), F.greatest(F.max("hi"), F.max("at")).alias("hi"),
            F.collect_set("at").alias("places"), F.max("of").alias("of"),
        )


def _rest(seeds: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Passages of the documents that share uncovered seeds, whatever their number."""
    count = scratch.keep(seeds.groupBy("seed").agg(F.count_distinct("doc").alias("n")).where("n > 1"))
    held = scratch.keep(seeds.join(count, "seed").drop("n"))
    scratch.drop(count)
    narrowed = _narrowed(held, scratch)
    rows = narrowed[0]
    for more in narrowed[1:]:
        rows = rows.unionByName(more)
    pairs = _alike(rows, docs, scratch)
    scratch.drop(*narrowed)

    # every place of a seed in one with every place in the other, but where that were
    # many: there the first, and the one of the same rank
    places = scratch.keep(held.groupBy("seed", "doc").agg(F.sort_array(F.collect_set("at")).alias("x")))
    scratch.drop(held)
    theirs = places.select("seed", F.col("doc").alias("other"), F.col("x").alias("y"))
    matches = pairs.join(places, "doc").join(theirs, ["seed", "other"])
    matches = matches.select("doc", "other", "y", (F.size("x") * F.size("y") <= REPEATS).alias("all"), F.posexplode("x").alias("k", "x"))
    some = F.array_distinct(F.array(F.col("y")[0], F.element_at("y", F.least(F.col("k") + 1, F.size("y")))))
    matches = matches.select("doc", "other", "x", F.explode(F.when(F.col("all"), F.col("y")).otherwise(some)).alias("y"))
    passages = _passages(matches, docs, scratch)
    scratch.drop(places, pairs)
    return passages


def shared_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Passages of ``docs`` that another document of lesser id holds too: places
    (code points, ends exclusive) in both, length, words aligned, identity."""
    conf = scratch.spark.conf
    was = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return _shared_passages(docs, scratch)
    finally:
        conf.set(CLEANUP, was)


def _shared_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    # taken twice from the texts: written they would take more disk than the texts
    seeds = docs.mapInArrow(_seeds, "seed long, doc long, at int")
    rounds = []
    for k in range(ROUNDS):
        passages, held = _linked(seeds, docs, scratch)
        if k:
            scratch.drop(seeds)
        rounds.append(passages)
        # holders that no passage covers are linked again, without the least, tried with each
        events = held.where("doc <> other").select("seed", "doc", "at", F.lit(-1).alias("stop"))
        places = passages.select(F.lit(0).cast("long").alias("seed"), F.col("doc_id").alias("doc"), "at", "stop")
        events = events.unionByName(places)
        events = events.repartition("doc").sortWithinPartitions("doc", "at", F.desc("stop"))
        seeds = scratch.keep(events.mapInArrow(_uncovered, "seed long, doc long, at int"))
        scratch.drop(held)
        if seeds.isEmpty():
            break
    else:
        rounds.append(_rest(seeds, docs, scratch))
    scratch.drop(seeds)
    out = rounds[0]
    for p in rounds[1:]:
        out = out.unionByName(p)
    return out.drop("at", "stop")


def op8_collinear_chaining(spark, sf_dir: str) -> DataFrame:
    """Fuzzy passages that ``documents`` share (``shared_passages``)."""
    return shared_passages(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
