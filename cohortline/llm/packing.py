"""Bulk-synchronous best-fit packing of tokenized documents into sequences of a fixed capacity.

Pieces are sorted by length across the cluster, so that a piece's place is its rank among all of
them. Pieces of one length are interchangeable, and so are sequences with one remaining gap; hence a
superstep matches all pieces of one length at once. The longest go first. Each sweep gives the class
its successor, the smallest gap that still takes it; where more pieces want a gap than it holds, the
lower ranks get it; gaps are updated and the rest sweeps on to the next successor, until no gap
is left and new sequences open. The sweeps see lengths, gaps and counts only (at most ``capacity``
of each, whatever the corpus holds); the ranking and the placing of pieces run on the executors.

Defined results: a null text counts as empty, and its one piece holds the end token; rows with one id
are documents of their own; ids may be null; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, partitions, schema, steps, store, with_text
from .hashing import Words

CAPACITY = 4096
# Characters that the tokenizer never joins with the letters before them.
_MARKS = ".,;:!?$%&*#|()-\""
END = 1
# Words that a worker remembers at most; beyond it the memory starts anew.
REMEMBERED = 1_000_000
# Bytes of text that are looked up at a time.
BLOCK_BYTES = 1 << 20

_CUTS = np.zeros(256, bool)
_CUTS[[32, 10, 9, 13]] = True


class WordIds:
    """Packed ids of texts; words are encoded by the tokenizer once and remembered.

    The tokenizer treats what stands between white space separately, so a text's ids are those of its
    words in turn. Only characters that every version takes for white space cut. A special token's text
    is read as that token where it stands, as the library does by default, unless ``literal``; such words hold
    signs, so the tokenizer gets them whole.
    """

    def __init__(self, path: str, literal: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)       # sorted, with the slot of each
        self.slots = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)         # of each slot in ids
        self.ids = np.zeros(0, "<u4")

    def slot_of(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of the hashes, -1 where unknown."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.slots[at], np.int32(-1))

    def remember(self, hashes: np.ndarray, packed: list[bytes]) -> None:
        """Adds distinct unknown hashes with their ids."""
        new = np.arange(len(hashes), dtype=np.int32) + np.int32(len(self.start) - 1)
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(packed), "<u4")])
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.slots = np.insert(self.hashes, at, hashes[order]), np.insert(self.slots, at, new[order])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        blob = [t.encode("utf-8", "surrogatepass") for t in texts]
        words = Words(blob, _CUTS)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        distinct, first, each = np.unique(words.hash, return_index=True, return_inverse=True)
        slots = self.slot_of(distinct)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            line = b" ".join(blob)
            new = [line[x:y].decode("utf-8", "surrogatepass")
                   for x, y in zip(words.begin[first[missing]].tolist(), words.end[first[missing]].tolist())]
            packed = self.look_up(new)
            missing_hashes = distinct[missing]
            unknown = self.slot_of(missing_hashes) < 0     # a stem may have become known meanwhile
            self.remember(missing_hashes[unknown], [p for p, u in zip(packed, unknown.tolist()) if u])
            slots = self.slot_of(distinct)
        slots = slots[each]
        begin, n = self.start[slots], self.start[slots + 1] - self.start[slots]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(begin - total[:-1], n) + np.arange(total[-1])].tobytes()
        edges = (4 * total[words.bounds]).tolist()
        return [ids[x:y] for x, y in zip(edges, edges[1:])]

    def look_up(self, new: list[str]) -> list[bytes]:
        """Packed ids of words; a run of letters with marks after it is encoded as the two."""
        tails, other, split, stems = {"": b""}, [], [], {}
        for w in new:
            stem = w.rstrip(_MARKS)
            if stem.isascii():
                key, plain = stem.lower(), stem.isalpha()
            else:
                key, plain = stem, stem.isalpha() and stem.lower().isalpha() and is_normalized("NFC", stem)
            if plain:
                tail = w[len(stem):]
                split.append((key, tail))
                stems[key] = None
                tails.setdefault(tail, None)
            else:
                split.append((None, len(other)))
                other.append(w)
        names = list(stems)
        hashes = Words([k.encode() for k in names], _CUTS).hash if names else np.zeros(0, np.uint64)
        slots = self.slot_of(hashes)
        unknown = np.flatnonzero(slots < 0).tolist()
        self.remember(hashes[unknown], self.encode_plain([names[i] for i in unknown]))
        slots = self.slot_of(hashes)
        for key, x, y in zip(names, self.start[slots].tolist(), self.start[slots + 1].tolist()):
            stems[key] = self.ids[x:y].tobytes()
        marks = [t for t in tails if t]
        encoded = [np.array(e.ids, "<u4").tobytes()
                   for e in self.tokenizer.encode_batch_fast(other + marks, add_special_tokens=False)]
        tails.update(zip(marks, encoded[len(other):]))
        return [encoded[b] if a is None else stems[a] + tails[b] for a, b in split]

    def encode_plain(self, words: list[str]) -> list[bytes]:
        """Runs of letters are one word each to the tokenizer: many go in one call, told apart by their last ids."""
        out = []
        for begin in range(0, len(words), 2000):
            part = words[begin:begin + 2000]
            e = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            packed, edges = ids.tobytes(), (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            out += [packed[x:y] for x, y in zip([0, *edges], edges)]
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path, literal=False)


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document's ids and the end token, cut at ``capacity``."""
    src = with_text(docs, id_col, text_col)
    out = schema(src, id_col, "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa

        own = word_ids(path)
        for batch in batches:
            target = arrow_schema(out, batch.schema.field("id").type)
            for part in steps(batch, BLOCK_BYTES):
                row, piece, length, crc, ids = [], [], [], [], []
                for i, packed in enumerate(own.encode(part.column("text").to_pylist())):
                    packed += last
                    for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                        here = packed[at:at + 4 * capacity]
                        row.append(i), piece.append(k), length.append(len(here) // 4), crc.append(zlib.crc32(here))
                        if with_ids:
                            ids.append(np.frombuffer(here, "<u4").astype(np.int32))
                start = np.array(piece, np.int64) * capacity
                columns = [part.column("id").take(pa.array(row, pa.int64())), piece, start, length, crc, *([ids] * with_ids)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                                  for c, f in zip(columns, target)], schema=target)

    return src.mapInArrow(run, out)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Placement of ranked pieces, from the number of pieces of each length.

    Ranks run from 0 with the longest pieces first. One row per match of a class and a gap:
    (first rank, pieces per sequence, first sequence, offset of the first piece, length).
    """
    gaps: dict[int, list[list[int]]] = {}      # gap -> [first sequence, sequences]
    sizes: list[int] = []                      # gaps at hand, ascending
    rows, rank, opened = [], 0, 0

    def give(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                insort(sizes, gap)
            gaps.setdefault(gap, []).append([first, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(sizes, length)                     # the successor
            if k == len(sizes):
                each = capacity // length
                gap, first, n = capacity, opened, -(-left // each)
                opened += n
            else:
                gap = sizes[k]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[k]
                each = gap // length
            full = min(n, left // each)                        # sequences filled by the lowest ranks
            if full:
                rows.append((rank, each, first, capacity - gap, length))
                give(gap - each * length, first, full)
            rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:                                     # fewer than one sequence takes
                rows.append((rank, left, first, capacity - gap, length))
                give(gap - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            if n:
                give(gap, first, n)
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """The pieces (with ``piece`` and ``length``) with ``sequence_id`` and ``offset``.

    Only the narrow columns are sorted and placed; ids, if there are any, are joined to the places.
    """
    pieces = store(pieces.withColumn("_row", F.monotonically_increasing_id()))
    placed = places(pieces.drop("ids"), capacity, id_col)
    if "ids" not in pieces.columns:
        return placed.drop("_row")
    return pieces.join(placed.select("_row", "sequence_id", "offset"), "_row").drop("_row")


def places(pieces: DataFrame, capacity: int, id_col: str) -> DataFrame:
    """The given rows with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    order = [F.col("length").desc(), F.col(id_col), F.col("piece")]
    ranked = store(pieces.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()))
    # one row per partition, one per length
    sizes = dict(ranked.groupBy(F.shiftright("_at", 33).alias("p")).count().collect())
    counts = dict(ranked.groupBy("length").count().collect())
    starts = np.zeros(max(sizes, default=0) + 2, np.int64)
    for p, n in sizes.items():
        starts[p + 1] = n
    plan = spark.sparkContext.broadcast((np.cumsum(starts), best_fit(counts, capacity)))
    out = ranked.drop("_at").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        import pyarrow as pa

        first, rows = plan.value
        for batch in batches:
            at = batch.column("_at").to_numpy()
            rank = first[at >> 33] + (at & ((1 << 33) - 1))
            row = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
            k = rank - row[:, 0]
            kept = [n for n in batch.schema.names if n != "_at"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(row[:, 2] + k // row[:, 1]),
                 pa.array(row[:, 3] + k % row[:, 1] * row[:, 4])], names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, out)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(tokenized_pieces(docs, path, capacity, end, with_ids, id_col, text_col), capacity, id_col)
