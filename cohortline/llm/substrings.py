"""Removal of passages that a document with a smaller id also has, found from fixed-block anchors.

Anchors: every document is an index of non-overlapping blocks of seven words; every rolling window of
seven words of every document probes it. A repeat of thirteen words holds one whole block of either
document, so its place in both is among the hits; an anchor that occurs once in the corpus is none.
Extension: around the hits all windows of thirteen words are hashed and compared over the corpus; runs
of windows that a document with a smaller id has too are the maximal repeats, and their words go.

Both comparisons go through packed arrays (``exchange``): a passage that very many documents share is
sent once per block of documents.

Defined results: words are runs between ASCII white space, unchanged; a null text has none. Rows of one id do not
remove each other's words; a row with a null id keeps all its words and removes none of others. Repeats inside one
document stay. Anchors tell items apart by 53 bits or more and only select candidates; windows by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, steps, store
from .exchange import (DIRECTORY, ITEMS, ROW, block_number, bucket_of, buckets, by_block, code, common_items,
                       directory, item_rows, rows, small, unsmall)
from .hashing import Words, mix, runs

WINDOW = 13
_OTHER = np.uint64(0xA0761D6478BD642F)   # mixed into the words of the second hash
ANCHOR = 7      # the longest block of which every window holds a whole one


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, sum): the sum tells rows of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("sum"))


def blobs(part: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]


def first_of_equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a new pair begins among sorted pairs."""
    out = np.ones(len(a), bool)
    out[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return out


def intervals(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Union of ``[s, s + length)`` over ascending starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + length


def candidates(src: DataFrame, window: int, anchor: int, count: int) -> DataFrame:
    """(id, sum, starts): for documents with anchor hits, the words at which windows around them start."""
    def send(batches):
        made = 0
        for batch in batches:
            for part in steps(batch, STEP_BYTES // 2):
                block = block_number(made)
                made += 1
                words = Words(blobs(part))
                h = runs(words.hash, anchor)
                size = np.diff(words.bounds)
                doc = words.doc()
                here = np.arange(len(h))
                good = np.flatnonzero((here + anchor <= words.bounds[1:][doc]) & (size[doc] >= window))
                flag = (good - words.bounds[doc[good]]) % anchor == 0
                codes = code(h[good], count)
                out, again = item_rows(block, codes, bucket_of(h[good], count), good, flag)
                out.append(directory(block, count, part.column("id").to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                                     part.column("sum").to_numpy().astype(np.int64).tobytes(), words.bounds.tobytes(),
                                     codes[again].tobytes() + good[again].astype(np.uint32).tobytes()))
                yield rows(out)

    def finish(book, codes, where, counts):
        ids, sums, bounds = (np.frombuffer(x, np.int64) for x in book[:3])
        repeats = len(book[3]) // 12
        more, at = np.frombuffer(book[3], np.uint64, repeats), np.frombuffer(book[3], np.uint32, offset=8 * repeats)
        hits = np.unique(np.concatenate([where, at[np.isin(more, codes)]])).astype(np.int64)
        cuts = np.searchsorted(hits, bounds)
        out = []
        for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if a < b:
                last = bounds[i + 1] - bounds[i] - window
                own = hits[a:b] - bounds[i]
                begin, end = intervals(np.maximum(own - (window - anchor), 0), window - anchor + 1)
                out.append((i, np.stack([begin, np.minimum(end, last + 1)]).astype(np.int32).tobytes()))
        rows_at = [i for i, _ in out]
        return pa.RecordBatch.from_arrays([pa.array(ids[rows_at]), pa.array(sums[rows_at]), pa.array([x for _, x in out], pa.binary())],
                                          names=["id", "sum", "starts"])

    known = src.filter("id is not null")
    return by_block(common_items(known.mapInArrow(send, ROW)), "id long, sum long, starts binary", finish)


def repeated_spans(src: DataFrame, found: DataFrame, window: int, count: int) -> DataFrame:
    """(id, sum, spans): the words covered by windows that a document with a smaller id has too.

    Windows are equal if two hashes of 64 bits each are, over differently mixed words.
    """
    where_to_look = found.groupBy("id", "sum").agg(F.first("starts").alias("starts"))
    asked = src.join(where_to_look, ["id", "sum"])

    def send(batches):
        made = 0
        for batch in batches:
            for part in steps(batch.take(pc.sort_indices(batch.column("id"))), STEP_BYTES // 2):
                block = block_number(made)
                made += 1
                words = Words(blobs(part))
                ids = part.column("id").to_numpy().astype(np.int64)
                at = []
                for first, s in zip(words.bounds.tolist(), part.column("starts").to_pylist()):
                    begin, end = np.frombuffer(s, np.int32).reshape(2, -1).astype(np.int64)
                    at += [np.arange(a, b) + first for a, b in zip(begin.tolist(), end.tolist())]
                at = np.concatenate(at)
                h, h2 = runs(words.hash, window)[at], runs(mix(words.hash ^ _OTHER), window)[at]
                owner = ids[words.doc()[at]]
                order = np.lexsort((h2, h))
                head = first_of_equal(h[order], h2[order])
                leader = np.empty(len(h), np.int64)
                leader[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
                mine = leader == np.arange(len(h))              # the block's first place of a window: of its smallest id
                local = owner[leader] < owner
                alias = ~mine & ~local
                bucket = bucket_of(h, count)
                sent = np.flatnonzero(mine)
                sent = sent[np.argsort(bucket[sent], kind="stable")]
                edges = np.flatnonzero(np.diff(bucket[sent], prepend=-1, append=-1))
                out = []
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    k = sent[a:b]
                    out.append((int(bucket[k[0]]), block, ITEMS, h[k].tobytes(), small(at[k]),
                                np.diff(owner[k], prepend=0).tobytes(), h2[k].tobytes()))
                out.append(directory(block, count, ids.tobytes(), part.column("sum").to_numpy().astype(np.int64).tobytes(),
                                     words.bounds.tobytes(),
                                     np.concatenate([[local.sum()], at[local], at[alias], at[leader[alias]]]).astype(np.int64).tobytes()))
                yield rows(out)

    def compare(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() == DIRECTORY:
            return table
        blocks = table.column("block").to_pylist()
        parts = [[np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in (("a", np.uint64), ("c", np.int64), ("d", np.uint64))]
        h, h2, owner = np.concatenate(parts[0]), np.concatenate(parts[2]), np.concatenate([np.cumsum(x) for x in parts[1]])
        order = np.lexsort((owner, h2, h))
        starts = np.flatnonzero(first_of_equal(h[order], h2[order]))
        least = np.empty(len(h), np.int64)
        least[order] = np.repeat(owner[order][starts], np.diff(np.append(starts, len(h))))
        hit = least < owner
        out, begin = [], 0
        for block, own, w in zip(blocks, parts[0], table.column("b").to_pylist()):
            mine = np.flatnonzero(hit[begin:begin + len(own)])
            begin += len(own)
            if len(mine):
                out.append((0, block, ITEMS, b"", unsmall(w)[mine].astype(np.uint32).tobytes(), b"", None))
        return pa.Table.from_batches([rows(out)])

    def finish(book, codes, where, counts):
        ids, sums, bounds, rest = (np.frombuffer(x, np.int64) for x in book)
        local, rest = rest[1:1 + rest[0]], rest[1 + rest[0]:]
        alias, leader = rest[:len(rest) // 2], rest[len(rest) // 2:]
        hits = np.unique(np.concatenate([where.astype(np.int64), local, alias[np.isin(leader, where)]]))
        cuts = np.searchsorted(hits, bounds)
        out = []
        for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if a < b:
                out.append((i, np.stack(intervals(hits[a:b] - bounds[i], window)).astype(np.int32).tobytes()))
        rows_at = [i for i, _ in out]
        return pa.RecordBatch.from_arrays([pa.array(ids[rows_at]), pa.array(sums[rows_at]), pa.array([x for _, x in out], pa.binary())],
                                          names=["id", "sum", "spans"])

    answers = asked.mapInArrow(send, ROW).groupBy("bucket", "part").applyInArrow(compare, ROW)
    return by_block(answers, "id long, sum long, spans binary", finish)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Stored (id, sum, spans) of the documents that lose words; ``spans`` packs the bounds of word runs."""
    src = keyed(docs, id_col, text_col)
    count = buckets(src)
    found = store(candidates(src, window, (window + 1) // 2, count))
    spans = store(repeated_spans(src, found, window, count))
    return spans.groupBy("id", "sum").agg(F.first("spans").alias("spans"))


def bounds_of(spans: bytes | None) -> list[tuple[int, int]]:
    return [] if spans is None else list(zip(*np.frombuffer(spans, np.int32).reshape(2, -1).tolist()))


def without(items: list, spans: list[tuple[int, int]]) -> list:
    kept, at = [], 0
    for a, b in spans:
        kept += items[at:a]
        at = b
    return kept + items[at:]


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: words, words removed, and the digest of what is kept."""
    spans = find_spans(docs, id_col, text_col, window)
    src = keyed(docs, id_col, text_col).join(spans, ["id", "sum"], "left").select("id", "text", "spans")
    id_type = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            out = []
            for text, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                kept = without(words, bounds_of(s))
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string())))],
                                             names=["id", "n_words", "n_removed", "kept_sha256"])

    got = src.mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string")
    return got.select(F.col("id").cast(id_type).alias(id_col), "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows with the repeated words, and the white space after them, cut out of the text."""
    spans = find_spans(docs, id_col, text_col, window).withColumnsRenamed({"id": "_id", "sum": "_sum", "spans": "_spans"})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.join(spans, (F.col(id_col).cast("long") == F.col("_id")) & (F.xxhash64(text) == F.col("_sum")), "left")
    fields = docs.schema

    def run(batches):
        for batch in batches:
            texts = []
            for t, s in zip(batch.column(text_col).to_pylist(), batch.column("_spans").to_pylist()):
                if s is not None:
                    raw = t.encode("utf-8", "surrogatepass")
                    begin = [*Words([raw]).begin.tolist(), len(raw)]
                    parts, at = [], 0
                    for a, b in bounds_of(s):
                        parts.append(raw[at:begin[a]])
                        at = begin[b]
                    t = b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass").rstrip(" \t\n\r\v\f")
                texts.append(t)
            arrays = [pa.array(texts, batch.column(c).type) if c == text_col else batch.column(c) for c in fields.names]
            yield pa.RecordBatch.from_arrays(arrays, names=fields.names)

    return joined.select(*docs.columns, "_spans").mapInArrow(run, fields)
