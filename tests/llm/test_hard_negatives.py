"""Hard negatives against all pairs, small cells, huge components, and the ranges of a bucket on their own."""

import math
import random

import numpy as np
import pytest

from cohortline.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score double, dim int, text string"


def brute(rows):
    seen = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(x)) for x in np.array(v, np.float32).astype(float)])
        seen[i] = min(seen.get(i, one), one)
    out = []
    for a, (label, v) in seen.items():
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, (other, w) in seen.items() if len(w) == len(v)]
        for ps, p, _ in sorted(s for s in scored if s[2] == label and s[1] != a)[:5]:
            band = sorted(s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:5]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(band, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 0.5, 3, "x") for i, v, label in rows], SCHEMA)


def awkward(n, dim=8, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c, scale = rng.choice(centres), rng.choice([0.01, 1, 1, 5])
        rows.append((i * rng.choice([1, 1, 2]) if i % 50 else i * 2, [scale * (x + rng.gauss(0, 0.3)) for x in c], rng.randrange(4)))
    rows += [(100000 + i, centres[0], 1) for i in range(40)] + [(200000 + i, centres[0], 2) for i in range(40)]
    rows += [(300000, None, 1), (300100, [1.0, None, 2.0], 1), (300200, [math.nan] * dim, 1), (300300, [math.inf] * dim, 1),
             (300400, [0.0] * dim, 1), (300401, [0.0] * dim, 2), (300500, [], 3), (300501, [], 3), (300502, [], 1),
             (None, [1.0] * dim, 1), (300600, [1.0] * dim, None), (300700, [1.0] * 3, 1), (300701, [1.0] * 3, 1), (300702, [1.0] * 3, 2)]
    return rows + rows[:5] + [(rows[100][0], centres[1], 3)]


@pytest.mark.parametrize("n,anchors,size", [(300, 512, 16384), (900, 4, 60), (600, 1, 7)])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, n, anchors, size):
    rows = awkward(n)
    label = "case when vec_id % 7 = 0 then (label + 1) % 10 else label end"
    from pyspark.sql import functions as F
    df = table(spark, rows)
    got = hn.mine(hn.prepare(df, "vec_id", F.expr(label), F.when(hn.usable(F.col("embedding")), hn.quantised(F.col("embedding")))),
                  F.col("id") % 100 == 0, anchors_per_cell=anchors, rows_per_cell=size)
    got = sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    assert got == brute(rows) and len(got) > 30


def test_huge_components_stay_exact_and_saturate(spark):
    rows = [(0, [1e9, 1e9], 1), (1, [1e9, 1e9 + 64], 1), (2, [1e9, 1e9 - 64], 2), (3, [1e9, 9e8], 2), (4, [3e38, 3e38], 3)]
    got = sorted(map(tuple, hn.hard_negatives(table(spark, rows)).collect()))
    assert got == [r for r in brute(rows) if max(abs(r[4]), abs(r[5])) < 2 ** 63]


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1, [1.0], 1)], [(100, [1.0], 1)]])
def test_hard_negatives_without_pairs(spark, rows):
    df = hn.hard_negatives(table(spark, rows))
    assert df.collect() == []
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    vecs = np.floor(256 * rng.normal(size=(4000, 6)) * rng.uniform(0.2, 2, size=(4000, 1))).astype(np.int64)
    floats = vecs.astype(float)
    lengths = np.sqrt((floats ** 2).sum(1))
    order = np.argsort(-lengths)[:2048]
    bucket = hn.Bucket(np.arange(4000), np.zeros(4000, np.int64), vecs, floats, lengths, order)
    read = 0
    for a in range(50):
        anchor = hn.Anchor(a, 0, vecs[a], [hn.Found(5, least=0.9 * lengths[a] * bucket.longest * 0.9)])
        cosine = anchor.cosine(bucket.longest)
        at = set(bucket.feasible(anchor.unit, anchor.focus, cosine).tolist())
        true = np.flatnonzero(bucket.floats @ anchor.floats >= anchor.lists[0].least)
        assert set(true.tolist()) <= at
        read += len(at)
    assert read < 50 * 2048 * 0.4
