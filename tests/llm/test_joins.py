"""n-gram join, substring dedup and embeddings against brute force; prefix tree and components on their own."""

import hashlib
import random
import re

import numpy as np
import pytest

from cohortline.llm import embeddings, ngram_join, substrings
from cohortline.llm.components import components

from inputs import awkward, documents


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    u = Union()
    for a in range(len(rows)):
        for b in range(a):
            i, j, both = rows[a][0], rows[b][0], len(sets[a] & sets[b])
            if i is not None and j is not None and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                u.link(i, j)
    return sorted(((i, len(s), None if i is None else u.find(i)) for (i, _), s in zip(rows, sets)), key=str)


@pytest.mark.parametrize("block", [1000, 7])
def test_ngram_join(spark, block):
    rows = awkward()
    got = ngram_join.join_documents(documents(spark, rows), block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute_classes(rows)


def test_ngram_join_empty_table(spark):
    assert ngram_join.join_documents(documents(spark, [])).collect() == []


def test_prefix_tree_finds_what_brute_force_finds():
    rng = random.Random(1)
    for _ in range(200):
        sets = [np.array(sorted(rng.sample(range(40), rng.randint(1, 30)))) for _ in range(rng.randint(1, 6))]
        sets += [np.array(sorted(set(sets[0]) ^ set(rng.sample(range(40), 2)))) for _ in range(4)]
        sets = [s for s in sets if len(s)]
        sizes = np.array([len(s) + rng.randint(0, 2) for s in sets])
        tree = ngram_join.PrefixTree(sets, sizes, 75)
        ask, size = sets[0], int(sizes[0])
        want = [i for i, s in enumerate(sets) if 175 * len(set(s) & set(ask)) >= 75 * (size + sizes[i])]
        assert sorted(tree.lookup(ask, size, 40)) == want


def brute_removal(rows, n):
    first, out = {}, []
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[k:k + n])
                first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_removal(spark):
    rows = awkward()
    got = substrings.removal_digests(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_removal(rows, 13)


def test_substring_removal_keeps_rows_and_columns(spark):
    rows = awkward()
    docs = documents(spark, rows)
    got = substrings.remove_repeats(docs)
    assert got.columns == docs.columns
    texts = sorted(((r["doc_id"], hashlib.sha256(" ".join(words(r["text"])).encode()).hexdigest()) for r in got.collect()), key=str)
    assert texts == sorted(((i, digest) for i, _, _, digest in brute_removal(rows, 13)), key=str)
    assert substrings.remove_repeats(documents(spark, [])).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(k, 200 + (k - 199) % 30) for k in range(200, 230)]
    edges += [(300, 300)] + [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(80)]
    rng.shuffle(edges)
    u = Union()
    for a, b in edges:
        u.link(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {x: u.find(x) for e in edges if e[0] != e[1] for x in e}
    assert got == want


def vectors():
    rng = np.random.default_rng(5)
    out = []
    for k in range(60):
        v = rng.normal(size=16)
        out.append(v.tolist())
        for _ in range(k % 5):
            out.append((v + rng.normal(size=16) * 0.08).tolist())
    out += [out[3]] * 30 + [(2 * np.array(out[5])).tolist()]
    out += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [1.0, 0.0], [1.0, 0.1], [2.0]]
    return [(i, v, 0, 1) for i, v in enumerate(out)]


@pytest.mark.parametrize("block", [2000, 8])
def test_embeddings_against_all_pairs(spark, block):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep long, links long")
    got = sorted(map(tuple, embeddings.near_duplicates(table, block=block).collect()))
    u, links = Union(), {i: 0 for i, *_ in rows}
    good = [(i, np.array(v)) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    for a, x in good:
        for b, y in good:
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[a] += 1
                u.link(a, b)
    want = [(i, links[i], u.find(i), u.find(i) == i) for i in sorted(links)]
    found, all_links = sum(g[1] for g in got), sum(links.values())
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert found >= 0.9 * all_links
    assert got == want      # these are all found
    assert embeddings.near_duplicates(table.limit(0)).collect() == []


def test_embedding_plan_reaches_recall():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(300, 64))
    plan = embeddings.calibrated(sample, 100_000, 0.9)
    x = embeddings.unit(rng.normal(size=(3000, 64)))
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    d = plan.directions(64)
    met = (plan.cells(x @ d) == plan.cells(y @ d)).any(1)
    near = np.array([embeddings.collisions(embeddings.quantized(a[None] @ d), embeddings.quantized(b[None] @ d), plan.window)[0, 0]
                     for a, b in zip(x, y)]) >= plan.least
    assert (met & near).mean() > 0.95


def test_items_keep_48_bits_beside_their_bucket():
    from cohortline.llm import exchange
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2 ** 64, 5000, dtype=np.uint64)
    for n in (1, 7, 1000, 60000):
        codes, bucket = exchange.code(h, n), exchange.bucket_of(h, n)
        assert bucket.min() >= 0 and bucket.max() < n
        assert (exchange.unpacked(exchange.packed(codes)) == (h & exchange.LOW)).all()
        assert (exchange.named(bucket, exchange.unpacked(exchange.packed(codes))) == codes).all()
    close = np.array([5, 5 + 2 ** 33, 5 + 2 ** 47], np.uint64)      # alike in their last 32 bits
    assert len(np.unique(exchange.code(close, 48))) == 3


def test_buckets_follow_the_texts(spark):
    from cohortline.llm import exchange
    df = spark.range(64).selectExpr("id", "repeat('word ', 20000) as text")
    assert exchange.buckets(df) == 2 * 8 and exchange.buckets(df.limit(0)) == 2 * 8
    before, exchange.BUCKET_BYTES = exchange.BUCKET_BYTES, 100_000
    try:
        assert exchange.buckets(df) == 64
    finally:
        exchange.BUCKET_BYTES = before


def test_windows_differ_where_either_hash_does():
    a, b = np.array([1, 1, 1, 2, 2], np.uint64), np.array([1, 1, 3, 3, 3], np.uint64)
    assert substrings.first_of_equal(a, b).tolist() == [True, False, True, True, False]
