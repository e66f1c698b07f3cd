"""Which hashed items of a block of documents also occur elsewhere: a shuffle of packed arrays.

A map task takes documents in blocks and sends, for each block and bucket of the hash space, one row
with the block's distinct items as packed arrays: a few bytes per item instead of a row. An item is
sent once per block however often the block repeats it, so a very common item reaches its bucket
at most once per block. The bucket's task counts items over all blocks and answers each block; a
block's directory row brings its answers and its documents together again.

The number of buckets follows the size of the texts (``BUCKET_BYTES`` of text each) and is twice the session's shuffle
partitions at least, so what a bucket's task holds does not grow with the corpus. Within a bucket 48 bits of the hash tell
items apart, with the bucket 53 bits and more; callers verify what these leave open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

BUCKET_BYTES = 32 << 20   # of text whose items one bucket gets, about
LOW = np.uint64((1 << 48) - 1)

ROW = "bucket int, block long, part int, a binary, b binary, c binary, d binary"
_NAMES = ["bucket", "block", "part", "a", "b", "c", "d"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
ITEMS, DIRECTORY = 0, 1


def buckets(texts: DataFrame, column: str = "text") -> int:
    """How many buckets the items of these texts are dealt to: one number is added up over all texts."""
    size = texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return min(1 << 30, max(2 * partitions(texts.sparkSession), -(-size // BUCKET_BYTES)))


def rows(values: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*values)) or [()] * 7, _TYPES)], names=_NAMES)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def code(h: np.ndarray, n: int) -> np.ndarray:
    """An item's name within a block: the last bits of its bucket and 48 bits of its hash."""
    return named(bucket_of(h, n), h & LOW)


def named(bucket, low: np.ndarray) -> np.ndarray:
    return (np.asarray(bucket, np.int64).astype(np.uint64) << np.uint64(48)) | low


def packed(x: np.ndarray) -> bytes:
    """The lower 48 bits of each."""
    return x.astype(np.uint32).tobytes() + (x >> np.uint64(32)).astype(np.uint16).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    n = len(b) // 6
    return np.frombuffer(b, np.uint32, n).astype(np.uint64) | np.frombuffer(b, np.uint16, offset=4 * n).astype(np.uint64) << np.uint64(32)


def small(x: np.ndarray) -> bytes:
    """Ascending integers as differences in the narrowest type, named by its first byte."""
    d = np.diff(x, prepend=0)
    for k, t in ((1, np.uint8), (2, np.uint16), (4, np.uint32)):
        if not len(d) or d.max() <= np.iinfo(t).max:
            return bytes([k]) + d.astype(t).tobytes()
    return b"\x08" + d.astype(np.uint64).tobytes()


def unsmall(b: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, f"<u{b[0]}", offset=1), dtype=np.int64)


def block_number(count: int) -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 24 | count


def item_rows(block: int, codes: np.ndarray, buckets: np.ndarray, where: np.ndarray, flag: np.ndarray | None) -> tuple[list[tuple], np.ndarray]:
    """Rows of the block's distinct items, and the indices of repeated ones.

    ``where`` ascends. Per item go 48 bits of its hash, the difference of its first place, a flag that any of its places
    sets, and (sparsely) how often the block has it.
    """
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    head = np.ones(len(codes), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(head)
    first, count = order[starts], np.diff(np.append(starts, len(codes)))
    flags = np.ones(len(starts), bool) if flag is None else np.maximum.reduceat(flag[order].view(np.uint8), starts).astype(bool) \
        if len(starts) else np.zeros(0, bool)
    bucket = buckets[first]
    again = np.lexsort((first, bucket))
    first, count, flags, bucket = first[again], count[again], flags[again], bucket[again]
    low = codes[first]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else np.zeros(1, np.int64)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        many = np.flatnonzero(count[a:b] > 1).astype(np.uint32)
        out.append((int(bucket[a]), block, ITEMS, packed(low[a:b]), small(where[first[a:b]]),
                    np.packbits(flags[a:b]).tobytes(), many.tobytes() + count[a:b][many].astype(np.uint32).tobytes()))
    repeated = np.sort(order[~head])
    return out, repeated


def common_items(sent: DataFrame) -> DataFrame:
    """Answers to each block: (where, 48 bits of the hash, count over all blocks) of its items that occur twice or more.

    An item whose flag is set nowhere is not answered. Directory rows pass through.
    """
    def count(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() == DIRECTORY:
            return table
        bucket, blocks = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        sent_rows = list(zip(*(table.column(c).to_pylist() for c in "abcd")))
        lows = [unpacked(r[0]) for r in sent_rows]
        sizes = np.fromiter(map(len, lows), np.int64, len(lows))
        keys = np.concatenate(lows)
        del lows
        counts = np.ones(len(keys), np.int64)
        flags = np.concatenate([np.unpackbits(np.frombuffer(r[2], np.uint8), count=n) for r, n in zip(sent_rows, sizes.tolist())])
        begin = np.concatenate([[0], np.cumsum(sizes)])
        for r, at in zip(sent_rows, begin.tolist()):
            if r[3]:
                many = np.frombuffer(r[3], np.uint32)
                counts[at + many[:len(many) // 2].astype(np.int64)] = many[len(many) // 2:]
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        total = np.add.reduceat(counts[order], starts)
        good = (total > 1) & (np.maximum.reduceat(flags[order], starts) > 0)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        hit, of = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        hit[order], of[order] = good[group], total[group]
        out = []
        for i, (block, r) in enumerate(zip(blocks, sent_rows)):
            mine = np.flatnonzero(hit[begin[i]:begin[i + 1]])
            if len(mine):
                at = begin[i] + mine
                out.append((bucket, block, ITEMS, packed(keys[at]), unsmall(r[1])[mine].astype(np.uint32).tobytes(),
                            np.minimum(of[at], 2 ** 32 - 1).astype(np.uint32).tobytes(), None))
        return pa.Table.from_batches([rows(out)])

    return sent.groupBy("bucket", "part").applyInArrow(count, ROW)


def directory(block: int, n: int, a: bytes, b: bytes = b"", c: bytes = b"", d: bytes = b"") -> tuple:
    return (block * 2654435761 % n, block, DIRECTORY, a, b, c, d)


def by_block(answers: DataFrame, fields: str, finish: Callable[[tuple, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """Per block ``finish(directory, codes, where, counts)``: its directory and the answers of all buckets."""
    def meet(table: pa.Table) -> pa.Table:
        part = table.column("part").to_pylist()
        columns = [table.column(c).to_pylist() for c in ("bucket", "a", "b", "c", "d")]
        book, codes, where, counts = None, [], [], []
        for p, bucket, a, b, c, d in zip(part, *columns):
            if p == DIRECTORY:
                book = (a, b, c, d)
            else:
                codes.append(named(bucket, unpacked(a)))
                where.append(np.frombuffer(b, np.uint32))
                counts.append(np.frombuffer(c, np.uint32))
        none = [np.zeros(0, np.uint64)]
        return pa.Table.from_batches([finish(book, *(np.concatenate(x or none) for x in (codes, where, counts)))])

    return answers.groupBy("block").applyInArrow(meet, fields)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of ``range(s, s + n)`` one after the other."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return np.repeat(starts - total[:-1], lengths) + np.arange(total[-1])
