"""Conversation repair against a search over all edits, chunked and whole; linked audits on their own."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from cohortline.llm import conversations as cv

SPACE = "[^\\x20\\x09-\\x0D]"
SCHEMA = "conv_id long, turn long, role string, text string, id long, part string, digest string, cost double"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (c, t)).encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        last = re.findall(SPACE, text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks, most_inserts):
    """All edits: whole audits compared, without sharing of prefixes."""
    best = None
    todo = {("", "", 0, 0)}      # initials, audit, cost, rows used
    pattern = re.compile("(s?(ua)+)?")
    prefix = re.compile("s?(ua)*u?")
    while todo:
        after = set()
        for initials, audit, cost, i in todo:
            if best and cost > best[0]:
                continue
            if i == len(rows) and pattern.fullmatch(initials):
                best = min(best or (cost, audit, initials), (cost, audit, initials))
            if audit.count("I") < most_inserts:
                after |= {(initials + x, audit + "I", cost + 5, i) for x in "ua"}
            if i < len(rows):
                after.add((initials, audit + "D", cost + 2, i + 1))
                if marks[i] not in ("b", "d"):
                    stays = cost + 5 * (marks[i] == "t")
                    after.add((initials + (rows[i][2][:1] or "-"), audit + "K", stays, i + 1))
                    after |= {(initials + x, audit + "R", stays + 1, i + 1) for x in "ua"}
        todo = {x for x in after if prefix.fullmatch(x[0])}
    return best


def report(c, rows, marks, cost, audit):
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    out, at, state = [], iter(rows), 0
    want = iter("s" + "ua" * len(audit) if (len(audit) - audit.count("D")) % 2 else "ua" * len(audit))
    for e in audit:
        row = None if e == "I" else next(at)
        if e != "D":
            role = {"s": "system", "u": "user", "a": "assistant"}[next(want)]
            out.append((row[2] if e == "K" else role) + ":" + (row[3] if row else ""))
    return (c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(k) for k in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def ordered(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    return {c: sorted((r for r in rows if r[0] == c), key=key) for c in {r[0] for r in rows}}


def brute(rows, best):
    left = ordered(damage(rows))
    out = []
    for c in {r[0] for r in rows}:
        mine = left.get(c, [])
        marks = faults(mine)
        out.append(report(c, mine, marks, *best(mine, marks)))
    return sorted(out, key=str)


def by_search(rows, marks):
    return cheapest(rows, marks, 4)[:2]


def by_strings(rows, marks):
    """The dynamic program with plain strings, for longer conversations."""
    now = {0: (0, "")}
    for (_, _, role, _), mark in zip(rows, marks):
        for s, t in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if s in now:
                now[t] = min(now.get(t, (9e9, "")), (now[s][0] + 5, now[s][1] + "I"))
        after = {}
        for s, (cost, audit) in now.items():
            moves = [(s, cost + 2, "D")]
            if mark not in ("b", "d"):
                stays = cost + 5 * (mark == "t")
                moves.append(({0: 2, 1: 2, 2: 3, 3: 2}[s], stays + 1, "R"))
                t = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, role[:1]))
                moves += [(t, stays, "K")] if t else []
            for t, c, e in moves:
                after[t] = min(after.get(t, (9e9, "")), (c, audit + e))
        now = after
    ends = [(c + 5 * n, a + "I" * n) for s, n in ((0, 0), (3, 0), (2, 1), (1, 2)) if s in now for c, a in [now[s]]]
    return min(ends)


def talk(rng, c, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "unknown", None]
    texts = ["yes.", "no!", "why?", "cut", " ", "", "a.b", None, "yes.", "x" * 30 + "."]
    rows = [(c, t, rng.choice(roles[:4] if rng.random() < 0.7 else roles), rng.choice(texts)) for t in range(n)]
    return [(c, None if rng.random() < 0.05 else t + 3 * (rng.random() < 0.1), r, x) for c, t, r, x in rows]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", "d", 0.5) for r in rows], SCHEMA).repartition(5)


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def small():
    rng = random.Random(8)
    rows = [r for c in range(120) for r in talk(rng, c, rng.randint(1, 6))]
    rows += [(None, None, None, None), (None, 0, "user", "a."), (None, 1, "assistant", "b.")]
    return rows + rows[:7]


def test_repair_against_all_edits(spark):
    rows = small()
    assert got(cv.repair_digests(table(spark, rows))) == brute(rows, by_search)


@pytest.mark.parametrize("chunk", [2, 7])
def test_chunks_give_the_same(spark, chunk):
    rng = random.Random(chunk)
    rows = small() + talk(rng, 1000, 300) + [(1001, 5, "user", "again.")] * 60 + [(1002, t, "user", "same.") for t in range(80)]
    whole = brute(rows, by_strings)
    assert got(cv.repair_digests(table(spark, rows), chunk_rows=chunk, parts=9)) == whole
    assert got(cv.repair_digests(table(spark, rows), chunk_bytes=40, parts=3)) == whole


def test_empty_table(spark):
    assert got(cv.repair_digests(table(spark, []))) == []


def test_both_searches_agree():
    rng = random.Random(2)
    for c in range(150):
        rows = ordered(damage(talk(rng, c, rng.randint(0, 6)))).get(c, [])
        assert by_search(rows, faults(rows)) == by_strings(rows, faults(rows))


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7, 1])
def test_ties_are_settled_with_and_without_collisions(monkeypatch, modulus):
    monkeypatch.setattr(cv.Node, "MODULUS", modulus)
    rng = random.Random(modulus % 1000)
    for _ in range(60):
        items = [(rng.choice("uuaasx"), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(rng.randint(0, 60))]
        cost, node = cv.finish(cv.solve(items))
        rows = [(0, 0, i, "") for i, _ in items]
        assert (cost, "".join(node.pieces())) == by_strings(rows, [f for _, f in items])
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("DK", repeat=n)]
    nodes = {}
    for w in words:
        node = cv.Node()
        for x in w:
            node = cv.Node(node, x)
        nodes[w] = node
    for a, b in itertools.product(words[::3], words):
        assert cv.less(nodes[a], nodes[b]) == (a < b)


def test_a_text_of_several_megabytes(spark):
    long = "word " * 1_000_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 2, "user", "yes."), (1, 3, "assistant", "no.")]
    assert got(cv.repair_digests(table(spark, rows))) == brute(rows, by_strings)
