"""Vector best-fit packing of token sequences.

A piece is a vector (tokens, 1 document, attention cost = tokens squared), a
sequence has a capacity in each of the three. Pieces are taken longest first;
each goes to the open sequence that admits it under every constraint and is the
best by score: the least weighted norm of what would be left (``norm``) or the
least weighted dot product of the piece with what is left (``dot``), both over
shares of the capacities (Panigrahy et al., Heuristics for Vector Bin Packing,
2011). The defaults of the document and cost capacities are those the token
capacity implies, so that tokens alone bind.

Texts never move: each is tokenized where it is read, and only lengths are
exchanged. Pieces are dealt by a keyed hash into groups of ``GROUP_SEQUENCES``
sequences, about, each packed in one task; what a group wastes is part of one
sequence or so. A piece as long as a sequence needs no exchange.

Defined results: null text counts as empty and is one piece of the end token; a
row is a row (repeated rows are packed again); an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table
from tillroll.llm.texts import RAW_CODE, _LOWER, flat, slices, span_hashes, words

#: Sequences that a group of pieces fills, about.
GROUP_SEQUENCES = 1500
#: Distinct words whose ids a Python worker remembers (about 40 bytes each).
CACHE = 4_000_000
END_ID = 0

#: Bytes of ASCII letters; the first of Latin-1 letters, and the second ones after it
#: (all but the multiplication and division signs); a full stop and a comma.
_LETTER, _LATIN, _STOP = (np.zeros(256, dtype=bool) for _ in range(3))
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True
_LATIN[[i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)]] = True
_STOP[[ord("."), ord(",")]] = True
#: Codes of the hash that confirms a word, A-Z lower-cased.
CHECK_CODE = RAW_CODE[::-1][_LOWER]


class Encoder:
    """Ids of whole texts, put together from remembered ids of their words.

    The tokenizer lower-cases, drops white space and never joins across it, so a
    text's ids are those of its white-space separated words, one after another.
    Words are looked up all at once for a batch, by a 64-bit hash with A-Z
    lower-cased in an open-addressing table, and confirmed by a second one of other
    codes; each new one is tokenized once. Texts that hold a word whose second hash
    differs, or may hold a special token, are tokenized whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._empty(1 << 16)
        self.known = 0
        self.pool = np.zeros(1 << 16, dtype="<u4")
        self.used = 0

    def _empty(self, places: int) -> None:
        self.keys = np.zeros(places, dtype=np.uint64)  # 0: empty
        self.check = np.zeros(places, dtype=np.uint64)
        self.at = np.zeros(places, dtype=np.int64)  # where in the pool a word's ids begin
        self.size = np.zeros(places, dtype=np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, or the empty one where its search ends."""
        mask = len(self.keys) - 1
        place = (hashes & np.uint64(mask)).astype(np.int64)
        held = self.keys[place]
        left = np.flatnonzero((held != hashes) & (held != 0))
        while len(left):
            place[left] = (place[left] + 1) & mask
            held = self.keys[place[left]]
            left = left[(held != hashes[left]) & (held != 0)]
        return place

    def _put(self, keys, check, at, size) -> None:
        """Adds distinct keys that are not in the table."""
        left = np.arange(len(keys))
        while len(left):
            place = self._find(keys[left])
            self.keys[place] = keys[left]  # of those that meet in an empty place one stays
            stays = self.keys[place] == keys[left]
            place, done = place[stays], left[stays]
            self.check[place], self.at[place], self.size[place] = check[done], at[done], size[done]
            left = left[~stays]

    def _ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after another, where each word's begin and their
        number. Letters (here ASCII and Latin-1) end in one word-end id, a full stop or
        comma after them is another; such words are encoded as one text and cut there."""
        size = end - start
        total = np.cumsum(size)
        source = np.repeat(start - (total - size), size) + np.arange(int(total[-1]))
        byte, first = data[source], total - size
        stop = (size > 1) & _STOP[byte[total - 1]]
        odd = ~_LETTER[byte]
        odd[1:] &= ~(_LATIN[byte[1:]] & (byte[:-1] == 0xC3))  # the second byte of a Latin-1 letter
        odd[total[stop] - 1] = False
        is_plain = np.add.reduceat(odd.astype(np.int32), first) == 0
        plain, rest = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        spaced = np.full(int(size[plain].sum()) + len(plain), 0x20, dtype=np.uint8)
        width = size[plain] + 1
        place = np.cumsum(width) - width
        spaced[np.arange(int(size[plain].sum())) + np.repeat(np.arange(len(plain)), size[plain])] = byte[np.repeat(is_plain, size)]
        cuts, text = [*place[::1000].tolist(), len(spaced)], spaced.tobytes()
        texts = [text[a:z].decode("utf-8") for a, z in zip(cuts[:-1], cuts[1:])]
        pool, sizes = [], []
        for k, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            last = np.cumsum(1 + stop[plain[1000 * k : 1000 * (k + 1)]])
            if len(ends) != last[-1]:
                raise ValueError("the tokenizer does not end runs of letters as expected")
            pool.append(ids)
            sizes.append(np.diff(ends[last - 1], prepend=0))
        raw = byte.tobytes()
        others = [raw[a:z].decode("utf-8") for a, z in zip(first[rest].tolist(), total[rest].tolist())]
        for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False):
            pool.append(np.asarray(e.ids, dtype="<u4"))
            sizes.append(np.array([len(pool[-1])]))
        number, at = np.empty(len(size), dtype=np.int64), np.empty(len(size), dtype=np.int64)
        order, each = np.concatenate([plain, rest]), np.concatenate(sizes)
        number[order], at[order] = each, np.cumsum(each) - each
        return np.concatenate(pool), at, number

    def _learn(self, keys, check, data, start, end) -> None:
        ids, at, size = self._ids(data, start, end)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 2 * len(ids), dtype="<u4")])
        self.pool[self.used : self.used + len(ids)] = ids
        self.known += len(keys)
        if 2 * self.known > len(self.keys):
            old = np.flatnonzero(self.keys)
            held = self.keys[old], self.check[old], self.at[old], self.size[old]
            self._empty(1 << (4 * self.known - 1).bit_length())
            self._put(*held)
        self._put(keys, check, self.used + at, size)
        self.used += len(ids)

    def __call__(self, column) -> list[np.ndarray]:
        """The ids of each row of a string column."""
        data, offsets = flat(column)
        start, end, row, hashes = words(data, offsets)
        hashes = np.maximum(hashes, np.uint64(1))  # 0 marks an empty place
        check = span_hashes(data, start, end, CHECK_CODE)
        if self.known > CACHE:
            self._forget()
        place = self._find(hashes)
        new = np.flatnonzero(self.keys[place] == 0)
        if len(new):
            keys, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            self._learn(keys, check[first], data, start[first], end[first])
            place = self._find(hashes)
        at, size = self.at[place], self.size[place].astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(at - (ends - size), size) + np.arange(total)]
        edges = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(len(offsets)))].tolist()
        out = [ids[a:z] for a, z in zip(edges[:-1], edges[1:])]
        special = pc.match_substring(column, "<|").fill_null(False).to_numpy(zero_copy_only=False)
        for r in np.union1d(np.flatnonzero(special), row[self.check[place] != check]):
            whole = self.tokenizer.encode(column[int(r)].as_py(), add_special_tokens=False)
            out[r] = np.asarray(whole.ids, dtype="<u4")
        return out


_encoders: dict[str, Encoder] = {}


def _pieces(path: str, most: int):
    def run(batches):
        encode = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for b in batches:
            out = [[], [], [], [], []]
            text = b.column("text")
            coded = (x for a, z in slices(text, 4 << 20) for x in encode(text.slice(a, z - a)))
            for doc, ids in zip(b.column("doc_id").to_pylist(), coded):
                ids = ids.tobytes() + end
                for piece, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    for o, v in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, t) for o, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def pieces(docs: DataFrame, tokenizer: str, most: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and an end id,
    cut at ``most`` tokens."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, most), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: np.ndarray, tokens: int, docs: int, cost: float, weights, score: str):
    """Sequence and offset of each piece; ``lengths`` must not increase."""
    w = np.asarray(weights, dtype=np.float64)
    room = np.empty((3, 256))  # what open sequences have left, as shares of their capacities
    left = np.empty(256, dtype=np.int64)
    name = np.empty(256, dtype=np.int64)
    count = made = 0
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    slack = 1e-12
    last, need, fits_from = None, None, 0
    for i, n in enumerate(lengths.tolist()):
        if n != last:
            last, need = n, np.array([n / tokens, 1 / docs, n * n / cost])
        r = room[:, :count]
        ok = (left[:count] >= n) & (r[1] >= need[1] - slack) & (r[2] >= need[2] - slack)
        if score == "norm":
            s = w[0] * (r[0] - need[0]) ** 2 + w[1] * (r[1] - need[1]) ** 2 + w[2] * (r[2] - need[2]) ** 2
        else:
            s = w[0] * need[0] * r[0] + w[1] * need[1] * r[1] + w[2] * need[2] * r[2]
        s[~ok] = np.inf
        at = int(s.argmin()) if count else -1
        if at < 0 or not ok[at]:
            if count == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], axis=1)
                left, name = np.concatenate([left, left]), np.concatenate([name, name])
            at, count = count, count + 1
            room[:, at], left[at], name[at] = 1.0, tokens, made
            made += 1
        sequence[i], offset[i] = name[at], tokens - left[at]
        left[at] -= n
        room[:, at] -= need
        if left[at] == 0 or room[1, at] < 1 / docs - slack:  # full: the last open one takes its place
            count -= 1
            room[:, at], left[at], name[at] = room[:, count], left[count], name[count]
    return sequence, offset


def pack(
    parts: DataFrame,
    scratch: Scratch,
    tokens: int = 2048,
    docs: int | None = None,
    cost: float | None = None,
    weights=(1.0, 0.05, 0.05),
    score: str = "norm",
    seed: int = 7,
) -> DataFrame:
    """``parts`` (written pieces) with ``sequence_id`` and ``offset``.

    Takes a written table: it is read for the group count and again to pack."""
    docs, cost = docs or tokens, cost or float(tokens) ** 2
    total = parts.where(F.col("length") < tokens).agg(F.sum("length").alias("n")).first()["n"] or 0
    groups = max(1, math.ceil(total / tokens / GROUP_SEQUENCES))
    alone = docs >= 1 and cost >= float(tokens) ** 2
    names = parts.columns

    def fill(key, rows):
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = best_fit(rows["length"].to_numpy(), tokens, docs, cost, weights, score)
        # groups count down from -1 so that they never meet the full pieces' own numbers
        return rows[names].assign(sequence_id=-1 - (sequence * groups + key[0]), offset=offset)

    schema = ", ".join(f"{n} {t}" for n, t in parts.dtypes) + ", sequence_id long, offset long"
    shorter = parts.where(F.col("length") < tokens) if alone else parts
    dealt = shorter.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "piece", "ids_crc32"), F.lit(groups)))
    packed = dealt.groupBy("_group").applyInPandas(fill, schema)
    if not alone:
        return packed
    full = parts.where(F.col("length") == tokens)
    return packed.union(
        full.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_vector_best_fit_packing(spark, sf_dir: str, tokens: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """All documents in as few sequences of ``tokens`` tokens as best fit finds."""
    scratch = Scratch(spark, "op6")
    parts = scratch.keep(pieces(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer(), tokens))
    return pack(parts, scratch, tokens)
