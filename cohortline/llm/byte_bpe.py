"""Byte-level BPE encoding and decoding on padded numpy matrices.

Every distinct piece of text becomes a row of byte ids in a matrix of its length class. In each
round every row merges its leftmost pair of least rank; pair ranks come from an open-addressing
hash table, the merged column is closed up, and rows without a mergeable pair leave the matrix.

Defined results: a null text counts as empty and has no ids; every row of the input has one row
in the output, repeated ids included; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from base64 import b64decode
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts, with_text

# Upper ends of the length classes; a longer piece merges through a heap instead of a row.
CLASSES = (2, 4, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256, 512, 1024)
# Distinct strings in each of the two generations that a worker remembers.
REMEMBERED = 250_000

_NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Ranks by pair of ids: open addressing with linear probing, looked up a whole array at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(len(left) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY, np.uint64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        keys, todo, self.probes = self._key(left, right), np.arange(len(left)), 0
        while len(todo):
            slots = self._slot(keys[todo], self.probes)
            free = self.keys[slots] == _EMPTY
            winners, first = np.unique(slots[free], return_index=True)
            taken = todo[free][first]
            self.keys[winners], self.ranks[winners] = keys[taken], rank[taken]
            todo = np.setdiff1d(todo, taken, assume_unique=True)
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys * _MIX >> self.shift).astype(np.int64) + probe) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the largest int32 where the two do not merge."""
        keys = self._key(left, right)
        out = np.full(len(keys), _NONE, np.int32)
        todo = np.arange(len(keys))
        for probe in range(self.probes):
            slots = self._slot(keys[todo], probe)
            found = self.keys[slots]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slots[hit]]
            todo = todo[~hit & (found != _EMPTY)]
            if not len(todo):
                break
        return out


class Codec:
    """Encoder and decoder for one file of ranks (``base64(bytes) rank`` lines) and one split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.rank_of = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.rank_of.items()}
        self.byte_ids = np.array([self.rank_of[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in self.rank_of.items():
            for cut in range(1, len(token)):
                a, b = self.rank_of.get(token[:cut]), self.rank_of.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, rank)))
        self.pattern = regex.compile(pattern)
        # A space between two non-space characters always begins a match of its own, so a text can be
        # cut there; other spaces stay inside a chunk.
        self.inner_space = regex.compile(r"(?<=\S) (?=\S)")
        self.width = np.dtype("<u2" if max(self.bytes_of) < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- encoding

    def merge_rows(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Packed ids after all merges of each row; ``ids`` is padded on the right beyond ``lengths``."""
        done: list = [b""] * len(ids)
        rows = np.arange(len(ids))
        columns = np.arange(ids.shape[1])
        ranks = np.full((len(ids), max(1, ids.shape[1] - 1)), _NONE, np.int32)
        r, c = np.nonzero(columns[1:] < lengths[:, None])
        ranks[r, c] = self.pairs.get(ids[r, c], ids[r, c + 1])
        while len(rows):
            at = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            over = best == _NONE
            if over.any():
                packed, size = ids[over].astype(self.width).tobytes(), self.width.itemsize
                begin = np.arange(int(over.sum())) * ids.shape[1] * size
                for k, x, y in zip(rows[over].tolist(), begin.tolist(), (begin + lengths[over] * size).tolist()):
                    done[k] = packed[x:y]
                rows, ids, ranks, lengths, at, best = (x[~over] for x in (rows, ids, ranks, lengths, at, best))
                if not len(rows):
                    break
            # compaction: the pair becomes one id, everything right of it moves one column left
            every = np.arange(len(rows))
            ids[every, at] = best
            shift = columns[:-1] > at[:, None]
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            lengths = lengths - 1
            if ranks.shape[1] > 1:
                ranks[:, :-1] = np.where(shift[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NONE
            has = at + 1 < lengths
            ranks[every, np.minimum(at, ranks.shape[1] - 1)] = _NONE
            k = every[has]
            ranks[k, at[has]] = self.pairs.get(ids[k, at[has]], ids[k, at[has] + 1])
            k = every[at > 0]
            ranks[k, at[k] - 1] = self.pairs.get(ids[k, at[k] - 1], ids[k, at[k]])
            width = int(lengths.max())
            if width < ids.shape[1]:
                ids, ranks, columns = ids[:, :width].copy(), ranks[:, :max(1, width - 1)].copy(), columns[:width]
        return done

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece by a heap of pairs: n log n steps."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        follow, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))

        def rank(i: int) -> int:
            j = follow[i]
            if j >= len(ids):
                return -1
            return self.rank_of.get(self.bytes_of[ids[i]] + self.bytes_of[ids[j]], -1)

        heap = [(r, i) for i in range(len(ids)) if (r := rank(i)) >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = follow[i]
            ids[i], ids[j], follow[i] = r, -1, follow[j]
            if follow[j] < len(ids):
                before[follow[j]] = i
            for k in (before[i], i):
                if k >= 0 and (x := rank(k)) >= 0:
                    heapq.heappush(heap, (x, k))
        return np.array([x for x in ids if x >= 0], self.width).tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of distinct non-empty pieces (matches of the split pattern)."""
        out: list = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        classes = np.searchsorted(CLASSES, lengths)
        for c in np.unique(classes).tolist():
            members = np.nonzero(classes == c)[0]
            if c == len(CLASSES):
                for i in members.tolist():
                    out[i] = self.merge_long(pieces[i])
                continue
            width = CLASSES[c]
            step = max(1, (1 << 20) // width)
            for begin in range(0, len(members), step):
                part = members[begin:begin + step]
                padded = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in part.tolist()]), np.uint8)
                ids = self.byte_ids[padded.reshape(len(part), width)]
                for i, merged in zip(part.tolist(), self.merge_rows(ids, lengths[part])):
                    out[i] = merged
        for i, piece in enumerate(pieces):  # as the library does, a piece that is a token stays whole
            if (whole := self.rank_of.get(piece)) is not None:
                out[i] = whole.to_bytes(self.width.itemsize, "little")
        return out

    def learn(self, need: set[str]) -> None:
        """Puts the packed ids of the chunks into ``known``, by way of those of their pieces."""
        if len(self.known) + len(need) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        pieces, compound = set(), []
        for c in need:
            if c in known:
                continue
            if (old := older.get(c)) is not None:
                known[c] = old
            elif c[1:].isalpha() and (c[0] == " " or c[0].isalpha()):  # one run of letters: one match
                pieces.add(c)
            else:
                found = self.pattern.findall(c)
                compound.append((c, found))
                for p in found:
                    if p not in known:
                        if (old := older.get(p)) is not None:
                            known[p] = old
                        else:
                            pieces.add(p)
        new = list(pieces)
        known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        for c, found in compound:
            known[c] = b"".join([known[p] for p in found])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, each match of the split pattern encoded separately."""
        cut = [t.replace(" ", "\0 ").split("\0") if "\0" not in t else None for t in texts]
        need = set().union(*(c for c in cut if c))
        odd = {c for c in need if c in ("", " ") or c[-1].isspace() or c[1:2].isspace()}
        need -= odd
        for i, c in enumerate(cut):
            if c is None or odd and not odd.isdisjoint(c):  # some space stands beside another: cut elsewhere
                at = [m.start() for m in self.inner_space.finditer(texts[i])]
                cut[i] = [x for x in (texts[i][a:b] for a, b in zip([0, *at], [*at, len(texts[i])])) if x]
                need.update(cut[i])
        self.learn(need)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), self.width) for c in cut]

    # -- decoding

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of every whole text."""
    return map_texts(with_text(df, id_col, text_col), id_col, "ids array<int>",
                     lambda texts: [(x.astype(np.int32),) for x in codec(path, pattern).encode(texts)])


def decode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """(id, bytes binary): what the ids stand for; null ids count as none."""
    import pyarrow as pa

    src = df.select(id_col, ids_col)
    out = src.select(id_col).schema.add("bytes", "binary")

    def run(batches):
        own = codec(path, pattern)
        for b in batches:
            data = pa.array([own.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), data], names=[id_col, "bytes"])

    return src.mapInArrow(run, out)


def round_trip_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes, then decodes the ids, without shipping either."""

    def each(texts: list[str]) -> list[tuple]:
        own, out = codec(path, pattern), []
        decimal = decimals(path, pattern)
        for part in (texts[i:i + 1024] for i in range(0, len(texts), 1024)):
            for packed in own.encode(part):
                ids = packed.tolist()
                out.append((len(ids),
                            hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                            hashlib.sha256(own.decode(ids)).hexdigest()))
        return out

    return map_texts(with_text(df, id_col, text_col), id_col,
                     "n_tokens long, ids_sha256 string, decoded_sha256 string", each)


@lru_cache(maxsize=2)
def decimals(path: str, pattern: str) -> dict[int, str]:
    return {i: str(i) for i in codec(path, pattern).bytes_of}
