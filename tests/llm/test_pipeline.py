"""The stages one after the other, each against brute force on what the one before kept."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from cohortline.llm import pii, toxicity
from cohortline.llm.common import store

from inputs import awkward, documents
from test_joins import brute_classes, words
from test_texts import toxic_corpus


def corpus():
    rows, labels = toxic_corpus(400)
    rng = random.Random(3)
    secret = hashlib.sha1(b"x").hexdigest()
    rows = [(i + 1000, t + (f" mail a{i}@b.example.com" if i % 50 == 0 else "")) for i, t in rows]
    rows += [(i, t) for i, t in awkward() if i not in (5, 10, None)]
    rows += [(2000 + i, f"unique{i} words " + " ".join(f"t{rng.randint(0, 999)}" for _ in range(30)) + f' token = "{secret}" end') for i in range(4)]
    return rows + [(None, "a row without an id")], [(i + 1000, q, y) for i, q, y in labels]


def kept_words(rows, n=13):
    first, out = {}, {}
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
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_stages_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, labels = corpus()
    folder = f"file://{tmp_path}"
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_join", "substring_dedup", "pii", "packing"]

    clean = store(stages["toxicity"](spark, docs, folder))
    assert clean.columns == docs.columns
    model = toxicity.fit_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r["doc_id"]: (r["score"], r["threshold"]) for r in toxicity.classify(docs, model).collect()}
    text = dict(rows)
    want = {i for i in text if scores[i][0] < scores[i][1]}
    assert {r["doc_id"] for r in clean.collect()} == want
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & want) < 0.1 * len(toxic) and len(want) > 0.9 * (len(text) - len(toxic))

    one = store(stages["ngram_join"](spark, clean, folder))
    left = [(i, text[i]) for i in want]
    want = {i for i, _, c in brute_classes(left) if c == i or i is None}
    assert {r["doc_id"] for r in one.collect()} == want and one.columns == docs.columns

    cut = store(stages["substring_dedup"](spark, one, folder))
    left = [(i, text[i]) for i in want]
    kept = kept_words(left)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert {i: words(t) for i, (t, _) in got.items()} == kept
    assert all(n == len(t or "") for t, n in got.values())

    masked = store(stages["pii"](spark, cut, folder))
    after = {r["doc_id"]: r["text"] for r in masked.collect()}
    trees = pii.fit_trees(cut)
    for i, (t, _) in got.items():
        base = pii.base_spans(t or "")
        spans = sorted(base + pii.added_spans([t or ""], [base], trees)[0])
        assert after[i] == pii.masked(t or "", spans)
    assert not any("@" in t for t in after.values()) and sum("[KEY]" in t for t in after.values()) == 4

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    packed = stages["packing"](spark, masked, folder).collect()
    want = {}
    for i, t in after.items():
        ids = plain.encode(t, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            want[(i, k // 4096)] = zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes())
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in packed} == want

    whole = corpus_pipeline.run(spark, folder)
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in whole.collect()} == want


def test_stages_of_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}"
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).filter(F.lit(True)).collect() == []
