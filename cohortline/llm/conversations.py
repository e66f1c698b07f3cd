"""Conversation repair: the cheapest edits of every conversation that make its roles alternate, with an audit of them.

Edits of the rows of a conversation, in order: keep (K, 0), rerole to user or assistant (R, 1), delete (D, 2; the only
edit of a blank or duplicate row) and, anywhere, insert an empty user or assistant turn (I, 5). A truncated row that
stays adds 5. The role initials that result match ``(s?(ua)+)?``; of the cheapest audits the ASCII-least one is taken.

A dynamic program runs over the rows with one state per kind of last turn. Its audits are linked nodes that share
their prefixes; a node knows its ancestors at distances 1, 2, 4, ... and a rolling hash of its prefix. Where two
audits tie, a search over the ancestors' hashes finds their longest common prefix, which is then verified (a hash
collision is settled by walking both); the first differing edit decides. Audits that use the same rows in the same state at
the same cost are never prefixes of each other, so a prefix that loses can't be part of the result.

Rows are range-sorted by conversation, turn, role, text digest and scan order, so that a conversation of any size is spread over
partitions. Conversations that lie within one partition, and within ``CHUNK`` rows, are done there. Others become
chunks: duplicates come from a grouping by role and text digest, each chunk is solved for every state it may begin
with, and the chunks' results are joined in order with the same linked nodes (an insertion counts to the row after it, so
that the audits of a chunk aren't prefixes of each other either). Memory of a task is bounded by a chunk; only the
audit itself and the hash of a conversation, which are sequential, pass one task as a stream of chunks.

Defined cases: null roles and texts are one space; a null conversation id is a conversation; null turns come first; rows of one
turn are ordered by role, then by the SHA-256 of the text; a role counts by its first character (an empty one fits
nowhere); a conversation without rows has zeros and an empty audit; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, partitions, schema, settings, store

CHUNK = 4096              # rows of a conversation that are solved together
CHUNK_BYTES = 8 << 20     # and bytes of their texts
BATCH_BYTES = 8 << 20     # of an Arrow batch that a task returns

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5     # costs
# last turn: none, system, user, assistant
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = (2, 2, 3, 2)       # the state after a turn that may be chosen
CHOSEN = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("blank", "duplicate", "truncated", "illegal")

_ROWS = "array<struct<turn: bigint, role: string, text: string, digest: string, dropped: boolean>>"
_TURNS = "array<struct<role: string, text: string>>"
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SCANNED = f"part long, chunk long, single boolean, {_REPORT}, turns {_TURNS}, rows {_ROWS}"
_SUMMARY = ("part long, chunk long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, n long, "
            "least long, most long, distinct_turns long, paths array<struct<start: int, stop: int, cost: bigint, audit: string>>")
_COMBINED = f"part long, chunk long, state int, piece string, {_REPORT}"


class Node:
    """An audit: its last piece, the nodes 1, 2, 4, ... pieces before it, and the hash of all pieces."""

    __slots__ = ("piece", "up", "depth", "hash", "state")
    MODULUS = (1 << 61) - 1

    def __init__(self, before: Node | None = None, piece: str = "", state: int = 0):
        self.piece, self.state = piece, state
        if before is None:
            self.up, self.depth, self.hash = (), 0, 0
            return
        up, k = [before], 0
        while len(up[k].up) > k:
            up.append(up[k].up[k])
            k += 1
        self.up, self.depth = tuple(up), before.depth + 1
        value = ord(piece) if len(piece) == 1 else int.from_bytes(hashlib.blake2b(piece.encode(), digest_size=7).digest(), "big") + 256
        self.hash = (before.hash * 1_000_003 + value) % self.MODULUS

    def at(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def pieces(self) -> list[str]:
        out, node = [], self
        while node.depth:
            out.append(node.piece)
            node = node.up[0]
        return out[::-1]


def same(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth hold the same pieces; shared nodes end the walk."""
    while a is not b and a.depth:
        if a.piece != b.piece:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether audit ``a`` comes before ``b``: the piece after their longest common prefix decides."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash == y.hash:
        if same(x, y):
            return a.depth < b.depth
    else:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if x.piece != y.piece and same(x.up[0], y.up[0]):
            return x.piece < y.piece
    return a.pieces() < b.pieces()    # a hash collision


def better(old: tuple | None, cost: int, node: Node, piece: str, state: int = 0) -> tuple:
    """The better one of ``old`` and the audit ``node`` with ``piece`` after it: (cost, node)."""
    if old is not None and old[0] < cost:
        return old
    new = (cost, Node(node, piece, state))
    return new if old is None or cost < old[0] or less(new[1], old[1]) else old


def solve(rows: list[tuple[str, str]], start: int = 0) -> list[tuple[int, Node] | None]:
    """Per state the cheapest, then least audit of rows (initial, fault) from the state ``start``.

    Fault: "" or the first letter of blank, duplicate, truncated. Insertions after the last row are not among these.
    """
    now: list = [None] * 4
    now[start] = (0, Node())
    for initial, fault in rows:
        for s in (0, 1, 3):
            if now[s] is not None:
                now[2] = better(now[2], now[s][0] + INSERT, now[s][1], "I")
        if now[2] is not None:
            now[3] = better(now[3], now[2][0] + INSERT, now[2][1], "I")
        after: list = [None] * 4
        stays = CUT if fault == "t" else 0
        for s, found in enumerate(now):
            if found is None:
                continue
            cost, node = found
            after[s] = better(after[s], cost + DELETE, node, "D")
            if fault in ("b", "d"):
                continue
            kept = STEP.get((s, initial))
            if kept is not None:
                after[kept] = better(after[kept], cost + KEEP + stays, node, "K")
            after[NEXT[s]] = better(after[NEXT[s]], cost + REROLE + stays, node, "R")
        now = after
    return now


def finish(ends: list[tuple[int, Node] | None]) -> tuple[int, Node]:
    """The best of the states after the last row, with the insertions that close it."""
    best = ends[0]
    for s, pieces in ((3, ""), (2, "I"), (1, "II")):
        if ends[s] is not None:
            cost, node = ends[s][0] + INSERT * len(pieces), ends[s][1]
            for piece in pieces:
                node = Node(node, piece)
            if best is None or cost < best[0] or cost == best[0] and less(node, best[1]):
                best = (cost, node)
    return best


def applied(rows: list[dict], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """(role, text) of the repaired turns of rows that aren't dropped."""
    out, at = [], iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit == "K":
            out.append((row["role"], row["text"]))
            state = STEP[state, row["role"][0]]
        else:
            out.append((CHOSEN[state], row["text"] if row else ""))
            state = NEXT[state]
    return out


def fault(row: dict, duplicate: bool) -> str:
    text = row["text"].strip(SPACE)
    return "b" if not text else "d" if duplicate else "t" if text[-1] not in ".!?" else ""


def counts(rows: list[dict], faults: list[str]) -> dict:
    initials = [r["role"][:1] for r in rows]
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))}


def gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


class Batches:
    """Rows collected into Arrow batches of bounded size."""

    def __init__(self, target: pa.Schema):
        self.target, self.rows, self.bytes = target, [], 0

    def add(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size + 200
        if self.bytes > BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array([r.get(f.name) for r in self.rows], f.type) for f in self.target]
            yield pa.RecordBatch.from_arrays(columns, schema=self.target)
        self.rows, self.bytes = [], 0


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            yield from batch.slice(begin, 1000).to_pylist()


def scan(rows: DataFrame, chunk_rows: int, chunk_bytes: int, parts: int) -> DataFrame:
    """Repaired conversations that lie within a partition, chunks of all others."""
    out = schema(rows, "id", _SCANNED)
    keys = ["id", "turn", "role", "digest", "tie"]
    fields = ["turn", "role", "text", "digest", "dropped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sent, done = TaskContext.get().partitionId(), 0, None
        now, size, whole, first = [], 0, False, True

        def closed(complete: bool) -> tuple[dict, int]:
            row = {"id": now[0]["id"], "part": part, "chunk": sent, "single": complete}
            if not complete:
                return row | {"rows": [{f: r[f] for f in fields} for r in now]}, size
            left, seen, faults = [r for r in now if not r["dropped"]], set(), []
            for r in left:
                key = (r["role"], r["digest"])
                faults.append(fault(r, key in seen))
                seen.add(key)
            cost, node = finish(solve([(r["role"][:1], f) for r, f in zip(left, faults)]))
            audit = "".join(node.pieces())
            return row | counts(left, faults) | {
                "gaps": gaps([r["turn"] for r in left if r["turn"] is not None]), "cost": cost, "audit": audit,
                "turns": [{"role": a, "text": b} for a, b in applied(left, audit)]}, size

        def rows_of():
            nonlocal done
            for batch in batches:
                done = done or Batches(arrow_schema(out, batch.schema.field("id").type))
                yield from each_row([batch])

        for r in rows_of():
            if now and (r["id"] != now[0]["id"] or len(now) >= chunk_rows or size >= chunk_bytes):
                ends = r["id"] != now[0]["id"]
                yield from done.add(*closed(whole and ends))
                sent += 1
                whole, now, size = ends, [], 0      # what follows begins a conversation
            now.append(r)
            size += len(r["text"]) + len(r["role"])
        if now:
            yield from done.add(*closed(False))
        if done:
            yield from done.rest()

    spread = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("tie")
    return spread.mapInArrow(run, out)


def summaries(chunks: DataFrame) -> DataFrame:
    """Per chunk its counts and the best audits between every two states."""
    rows = chunks.select("part", "chunk", "id", F.posexplode("rows").alias("pos", "row")).filter("not row.dropped")
    firsts = rows.groupBy("id", "row.role", "row.digest").agg(F.min(F.struct("part", "chunk", "pos")).alias("at"))
    firsts = firsts.groupBy("at.part", "at.chunk").agg(F.collect_list("at.pos").alias("firsts"))
    both = chunks.select("id", "part", "chunk", "rows").join(firsts, ["part", "chunk"], "left")
    both = both.select("id", "part", "chunk", "rows", "firsts")
    out = schema(both, "id", _SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = Batches(arrow_schema(out, batch.schema.field("id").type))
            for c in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                fresh = set(c["firsts"] or ())
                left = [(r, pos not in fresh) for pos, r in enumerate(c["rows"]) if not r["dropped"]]
                faults = [fault(r, repeated) for r, repeated in left]
                left = [r for r, _ in left]
                items = [(r["role"][:1], f) for r, f in zip(left, faults)]
                turns = [r["turn"] for r in left if r["turn"] is not None]
                paths = [{"start": s, "stop": t, "cost": end[0], "audit": "".join(end[1].pieces())}
                         for s in range(4) for t, end in enumerate(solve(items, s)) if end]
                yield from done.add(
                    {k: c[k] for k in ("id", "part", "chunk")} | counts(left, faults) |
                    {"first_role": left[0]["role"][:1] if left else None, "last_role": left[-1]["role"][:1] if left else None,
                     "n": len(left), "least": min(turns, default=None), "most": max(turns, default=None),
                     "distinct_turns": len(set(turns)), "paths": paths}, sum(len(p["audit"]) for p in paths))
            yield from done.rest()

    return both.mapInArrow(run, out)


def combine(found: DataFrame) -> DataFrame:
    """Per conversation its report (part null), per chunk the piece of the audit and the state it begins in."""
    out = schema(found, "id", _COMBINED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = None, None
        for batch in batches:
            done = done or Batches(arrow_schema(out, batch.schema.field("id").type))
            for i in range(batch.num_rows):
                c = batch.slice(i, 1).to_pylist()[0]
                if now is None or now.id != c["id"]:
                    yield from now.rows(done) if now else ()
                    now = Joined(c["id"])
                now.add(c)
        if now:
            yield from now.rows(done)
            yield from done.rest()

    ordered = found.repartition(partitions(found.sparkSession), "id").sortWithinPartitions("id", "part", "chunk")
    return ordered.mapInArrow(run, out)


class Joined:
    """A conversation read chunk by chunk."""

    def __init__(self, key):
        self.id, self.chunks = key, []
        self.ends: list = [(0, Node()), None, None, None]
        self.totals = dict.fromkeys(COUNTS, 0)
        self.last_role = self.least = self.most = None
        self.distinct = 0

    def add(self, c: dict) -> None:
        self.chunks.append((c["part"], c["chunk"]))
        for k in COUNTS:
            self.totals[k] += c[k]
        if c["n"]:
            if self.last_role is not None and self.last_role + c["first_role"] not in LEGAL:
                self.totals["illegal"] += 1
            self.last_role = c["last_role"]
        if c["least"] is not None:
            # turns ascend, so only the greatest so far can occur again
            self.distinct += c["distinct_turns"] - (self.most == c["least"])
            self.least = c["least"] if self.least is None else self.least
            self.most = c["most"]
        after: list = [None] * 4
        for p in c["paths"]:
            before = self.ends[p["start"]]
            if before is not None:
                after[p["stop"]] = better(after[p["stop"]], before[0] + p["cost"], before[1], p["audit"], p["stop"])
        self.ends = after

    def rows(self, done: Batches) -> Iterator[pa.RecordBatch]:
        cost, node = finish(self.ends)
        pieces = node.pieces()
        closing, n = "".join(pieces[len(self.chunks):]), len(self.chunks)
        span = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        for k, ((part, chunk), piece) in enumerate(zip(self.chunks, pieces)):
            piece += closing if k == n - 1 else ""
            yield from done.add({"id": self.id, "part": part, "chunk": chunk, "state": node.at(k).state, "piece": piece}, len(piece))
        audit = "".join(pieces)
        yield from done.add({"id": self.id, "gaps": span, "cost": cost, "audit": audit} | self.totals, len(audit))


def repaired_chunks(chunks: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns that each chunk becomes."""
    both = chunks.select("id", "part", "chunk", "rows").join(audits.select("part", "chunk", "state", "piece"), ["part", "chunk"])
    both = both.select("id", "part", "chunk", "rows", "state", "piece")
    out = schema(both, "id", f"part long, chunk long, turns {_TURNS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = Batches(arrow_schema(out, batch.schema.field("id").type))
            for c in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                turns = applied([r for r in c["rows"] if not r["dropped"]], c["piece"], c["state"])
                yield from done.add({k: c[k] for k in ("id", "part", "chunk")} | {
                    "turns": [{"role": a, "text": b} for a, b in turns]}, sum(len(b) for _, b in turns))
            yield from done.rest()

    return both.mapInArrow(run, out)


class Repaired(NamedTuple):
    """``small``: report and repaired turns, one row per conversation done in one piece; of the others ``large`` has the
    report, and ``turns`` the repaired turns of each chunk (ascending part, chunk)."""

    small: DataFrame
    large: DataFrame
    turns: DataFrame


REPORT = ["id", "gaps", *COUNTS, "cost", "audit"]


def repair(rows: DataFrame, chunk_rows: int = CHUNK, chunk_bytes: int = CHUNK_BYTES, parts: int | None = None) -> Repaired:
    """Repairs the conversations of ``conversation_rows`` (or ``damaged`` ones)."""
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        scanned = store(scan(rows, chunk_rows, chunk_bytes, parts or partitions(rows.sparkSession)))
        chunks = scanned.filter("not single")
        found = store(combine(summaries(chunks)))
        turns = store(repaired_chunks(chunks, found.filter("part is not null")))
    return Repaired(scanned.filter("single").select(*REPORT, "turns"), found.filter("part is null").select(*REPORT), turns)


def conversation_rows(df: DataFrame) -> DataFrame:
    """(id, turn, role, text, digest, dropped, tie) of a table (conv_id, turn, role, text)."""
    one_space = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = df.select(F.col("conv_id").alias("id"), F.col("turn").cast("long").alias("turn"), *one_space)
    return keyed(rows.withColumn("dropped", F.lit(False)))


def keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.sha2("text", 256)).withColumn("tie", F.monotonically_increasing_id())


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with the faults that crc32 of ``id:turn`` picks (modulo 20): 0 drops, 1 empties, 2 takes the ends of
    sentences away, 3 repeats, 4 gives the row to the user. Dropped rows stay, marked, for their conversation's sake."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    rows = rows.drop("digest", "tie").withColumn("kind", kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select(
        "id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("dropped") | (F.col("kind") == 0)).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return keyed(rows.drop("copy"))


def digests(repaired: Repaired, id_name: str = "conv_id") -> DataFrame:
    """The reports with the SHA-256 of the repaired turns (``role:text``, joined by line ends)."""
    def text(turns):
        return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")

    small = repaired.small.select(*REPORT, F.sha2(text("turns"), 256).alias("repaired_sha256"))
    pieces = repaired.turns.select("id", "part", "chunk", text("turns").alias("text"))
    out = schema(pieces, "id", "repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, empty, target = None, None, True, None
        for batch in batches:
            target = target or arrow_schema(out, batch.schema.field("id").type)
            for i in range(batch.num_rows):
                c = batch.slice(i, 1).to_pylist()[0]
                if sha is None or key != c["id"]:
                    if sha is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key], target[0].type), pa.array([sha.hexdigest()])], schema=target)
                    key, sha, empty = c["id"], hashlib.sha256(), True
                if c["text"]:
                    sha.update(("" if empty else "\n").encode() + c["text"].encode())
                    empty = False
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], target[0].type), pa.array([sha.hexdigest()])], schema=target)

    ordered = pieces.repartition(partitions(pieces.sparkSession), "id").sortWithinPartitions("id", "part", "chunk")
    hashed = ordered.mapInArrow(run, out).withColumnRenamed("id", "of")
    large = repaired.large.join(hashed, F.col("id").eqNullSafe(F.col("of"))).select(*small.columns)
    return small.unionByName(large).withColumnRenamed("id", id_name)


def repair_digests(df: DataFrame, **bounds) -> DataFrame:
    """Damages, repairs and digests the table (conv_id, turn, role, text)."""
    return digests(repair(damaged(conversation_rows(df)), **bounds))
