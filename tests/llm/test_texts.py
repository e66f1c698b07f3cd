"""Operators on single texts: licenses, tokens, personal data, toxicity, fingerprints, packing, archives."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timezone

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortline.llm import byte_bpe, fingerprints, licenses, packing, pii, toxicity, warc
from cohortline.llm.common import store
from cohortline.llm.licenses import Notice

from inputs import awkward, documents

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", " ", "  ", "\n", "é", "É", "'s", "'", "1", "23", "語", "́", "\x1c", "\x85", "　", "​", "😀", "!",
       "the", " and", "\t", "\r\n", "ß", "\x00", "\xa0", "<|endoftext|>", "Σ", "İ", "하", "aaaaaaaaaaaaaaaaaaaa"]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(n)]


# ---------------------------------------------------------------- tokens

@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(tiktoken_encoding):
    codec = byte_bpe.Codec(BPE, public_tokenizers.PATTERN)
    texts = odd_texts(3000) + ["a" * 3000, "ab" * 700, " " * 2000, "xyzq" * 300, ""]
    for begin in (0, 1500):
        for text, ids in zip(texts[begin:begin + 1505], codec.encode(texts[begin:begin + 1505])):
            assert ids.tolist() == tiktoken_encoding.encode_ordinary(text), text
            assert codec.decode(ids.tolist()) == text.encode()


def test_byte_bpe_documents(spark, tiktoken_encoding):
    rows = awkward()
    docs = documents(spark, rows)
    got = sorted(map(tuple, byte_bpe.round_trip_digests(docs, BPE, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    ids = byte_bpe.encode_documents(docs, BPE, public_tokenizers.PATTERN)
    back = byte_bpe.decode_documents(ids, BPE, public_tokenizers.PATTERN)
    assert sorted(((r[0], bytes(r[1])) for r in back.collect()), key=str) == sorted(((i, (t or "").encode()) for i, t in rows), key=str)
    assert byte_bpe.round_trip_digests(docs.limit(0), BPE, public_tokenizers.PATTERN).collect() == []


def test_pair_table_finds_all_pairs_and_no_others():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 500, (4000, 2)), axis=0).astype(np.int32)
    table = byte_bpe.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (table.get(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    assert (table.get(pairs[:, 0] + 1000, pairs[:, 1]) == 2 ** 31 - 1).all()


# ---------------------------------------------------------------- packing

def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD)
    plain.encode_special_tokens = True
    texts = odd_texts(3000, 9)
    own = packing.WordIds(WORD)
    for begin in (0, 1000, 2000):
        part = texts[begin:begin + 1000]
        want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(part, add_special_tokens=False)]
        assert own.encode(part) == want


def test_special_tokens_are_read_as_the_library_does(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD)
    texts = ["hello <|endoftext|> x", "in<|endoftext|>side a word", "<|startoftext|>", "Two<|endoftext|><|startoftext|>. <|EndOfText|>",
             "<|endoftext|", "é<|endoftext|>\u0301 (<|endoftext|>)", "x" * 50 + "<|endoftext|>" * 300] + odd_texts(2000, 10)
    assert plain.encode(texts[0], add_special_tokens=False).ids == [3306, 49407, 343]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert packing.WordIds(WORD, literal=False).encode(texts) == want
    got = packing.tokenized_pieces(documents(spark, list(enumerate(texts))), WORD, with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: [*np.frombuffer(w, "<u4").tolist(), 1] for i, w in enumerate(want)}


def plain_best_fit(lengths, capacity):
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps[gaps.index(min(fits))] -= x
        else:
            gaps.append(capacity - x)
    return gaps


def test_best_fit_is_that_of_one_piece_at_a_time():
    rng = random.Random(1)
    for _ in range(50):
        lengths = sorted((rng.choice([rng.randint(1, 64), rng.randint(1, 9)]) for _ in range(rng.randint(0, 200))), reverse=True)
        gaps = plain_best_fit(lengths, 64)
        rows = packing.best_fit(Counter(lengths), 64)
        held = defaultdict(int)
        for rank, x in enumerate(lengths):
            first, each, sequence, offset, length = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            k = rank - first
            assert length == x and held[sequence + k // each] == offset + k % each * length
            held[sequence + k // each] += length
        assert sorted(64 - n for n in held.values()) == sorted(gaps)


def test_packing_documents(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD)
    plain.encode_special_tokens = True
    rows = awkward()
    got = packing.pack_documents(documents(spark, rows), WORD, capacity=256, with_ids=True).collect()
    want = Counter()
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            part = ids[k:k + 256]
            want[(i, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) == len(plain_best_fit([r["length"] for r in got], 256))
    assert packing.pack_documents(documents(spark, []), WORD).collect() == []


# ---------------------------------------------------------------- licenses

def plain_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_phrases(spark):
    rows = awkward() + [(900, "Released under the MIT License."), (901, "mit MIT license-LICENSE General\nPublic license"),
                        (902, "the Apachelicense apache  license é"), (903, "submit license")]
    got = licenses.scan_licenses(documents(spark, rows)).collect()
    cut = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) for r in got), key=str)
    assert cut == sorted(((i, *plain_scan(t)) for i, t in rows), key=str)
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)
    assert licenses.scan_licenses(documents(spark, [])).collect() == []


def test_notices_with_edits_are_found_and_others_not():
    scan = licenses.scanner(tuple(licenses.PHRASES.items()), licenses.NOTICES).scan
    rng = random.Random(4)
    for notice in licenses.NOTICES:
        for _ in range(30):
            s = list(notice.text)
            for _ in range(rng.randint(0, notice.errors)):
                k = rng.randrange(1, len(s) - 1)
                if rng.random() < 0.5:
                    s[k] = "z"
                else:
                    s.insert(k, "q")
            found = scan("some words " + "".join(s) + " and more")[7]
            assert any(label == notice.label for label, *_ in found), (notice, "".join(s))
    assert scan("the license of this car is valid and released in public")[5] == ""
    assert scan("Licensed under the Apache Licence, Version 2.0")[7] == [("apache", 0, 8, 1)]


def test_notices_beside_better_ones_are_found():
    scan = licenses.scanner(tuple(licenses.PHRASES.items()), licenses.NOTICES).scan
    edited, exact = "Licensed under the Apache Licenze, Version 2.0", "Licensed under the Apache License, Version 2.0"
    assert scan(f"{edited} {exact}")[7] == [("apache", 0, 8, 1), ("apache", 8, 16, 0)]
    assert scan(f"{exact} {edited}")[7] == [("apache", 0, 8, 0), ("apache", 8, 16, 1)]
    rng = random.Random(5)
    for notice in licenses.NOTICES:
        scan = licenses.scanner((), (notice,)).scan
        inner, n = [k for k, c in enumerate(notice.text) if c != " " and k], len(notice.text.split())
        for _ in range(20):
            words, want = [], []
            for _ in range(rng.randint(2, 6)):
                s, errors = list(notice.text), rng.randint(0, notice.errors)
                for k in rng.sample(inner, errors):
                    s[k] = "é"
                words += ["xyzzy"] * rng.choice([0, 0, 1, 30])
                want.append((notice.label, len(words), len(words) + n, errors))
                words += "".join(s).split(" ")
            assert scan(" ".join(words))[7] == want
    assert len(licenses.scanner((), licenses.NOTICES).scan((edited + "\n") * 3000)[7]) == 3000


def test_many_places_in_one_text_take_time_in_proportion():
    import time
    scan, times = licenses.scanner(tuple(licenses.PHRASES.items()), licenses.NOTICES).scan, []
    for n in (20_000, 80_000):
        began = time.thread_time()
        found = scan("the mit license of words " * n)
        times.append(time.thread_time() - began)
        assert found[1] == n and found[2:4] == (1, 5 * n - 4)
    assert times[1] < 10 * times[0] + 0.5


def test_seeds_cover_the_notice():
    for notice in (*licenses.NOTICES, Notice("x", "abc", 1)):
        assert "".join(s for s, _ in licenses.seeds(notice)) == notice.text
        assert len(licenses.seeds(notice)) == notice.errors + 1


# ---------------------------------------------------------------- personal data

def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    bits = list("ab@@..11 -+()%") + ["1.2.3.4", "4539578763621486", "+1 (416) 555-4060", "a@b.c", "00255", "é"]
    for _ in range(8000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii_documents(spark):
    secret = "0641917ea4e9feb9cda83477b57ac2654884f485"
    rows = awkward() + [(900, f'😀 token = "{secret}" and a@b.example.com, +1 (416) 555-4060'), (901, "call 4539578763621486 9.9.9.9 now"),
                        (902, "plain words without any of it")]
    docs = documents(spark, rows)
    model = pii.fit_trees(docs)
    got = pii.find_pii(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in rows:
        base = plain_spans(t or "")
        if i not in (5, 10, None):      # ids of one row
            r, n = by_id[i], Counter(k for _, k, _ in base)
            assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [n[k] for k in range(4)]
            assert r["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest()
            assert set(filter(None, pii.listed(base).split(","))) <= set(r["spans"].split(","))
    assert f"key:{rows[-3][1].index(secret)}:{rows[-3][1].index(secret) + 40}" in by_id[900]["spans"]
    assert by_id[902]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs, model).collect()}
    assert masked[900] == '😀 token = "[KEY]" and [EMAIL], [PHONE]' and masked[902] == rows[-1][1]
    assert pii.redact(docs, model).columns == docs.columns
    assert pii.find_pii(docs.limit(0), pii.fit_trees(docs.limit(0))).collect() == []


def test_valid_account_numbers_outside_the_fit_sample_are_found(spark):
    rng = random.Random(12)
    ibans = ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606", "NL91 ABNA 0417 1643 00"]
    assert all(pii.iban_ok(s) for s in ibans)
    plain = [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(20))) for i in range(60)]
    rows = plain + [(100 + i, f"please pay to {s} by monday") for i, s in enumerate(ibans)]
    rows += [(200 + i, f"part AB{rng.randint(10, 99)}{rng.randint(10 ** 15, 10 ** 16 - 1)} by monday") for i in range(20)]
    docs = documents(spark, rows)
    model = pii.fit_trees(docs.filter("doc_id < 100"))
    spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs, model).collect()}
    assert [f"iban:14:{14 + len(s)}" in spans[100 + i] for i, s in enumerate(ibans)] == [True] * len(ibans)
    assert sum("iban" in spans[200 + i] for i in range(20)) == sum(pii.iban_ok(t.split()[1]) for i, t in rows if i >= 200)


def test_pii_thresholds_count_the_candidates_of_all_documents(spark):
    rows = [(i, f"ssn 123-45-{i:04d} of") for i in range(1000, 1300)] + [(None, "ssn 123-45-6789 of")]
    model = pii.Trees(0.0, [], 3, {})
    src = pii.with_text(documents(spark, rows), "doc_id", "text")
    key = src.selectExpr("xxhash64(id) as key").filter("id = 1000").first()["key"]
    assert pii.counted(src, model, [(key, 0)]) == {(6, 0, 1): 300}
    assert pii.threshold(Counter({(6, 64, 1): 97, (6, 64, 0): 3, (6, 32, 0): 1, (6, -5, 1): 99}), 6, pii.Fit()) == pytest.approx(1 / (1 + np.exp(-2)))
    assert pii.threshold(Counter({(6, 64, 1): 9, (6, 64, 0): 3}), 6, pii.Fit()) == 1.1


def test_generators_are_broad():
    for text, found in (('password = "correcthorsebatterystaple"', "correcthorsebatterystaple"),
                        ("api_key: abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz"),
                        ("bob (AT) example (DOT) com", "bob (AT) example (DOT) com"), ("ann[at]mail.example.org", "ann[at]mail.example.org"),
                        ("'secret': \"QwErTyUiOpAsDfGhJkLz\"", "QwErTyUiOpAsDfGhJkLz"), ("token abc1def2ghi3jkl4mno5", "abc1def2ghi3jkl4mno5")):
        assert found in [text[a:b] for a, _, b in pii.candidates(text)], text
    assert pii.candidates("a key: short and other words, no assignment of internationalization") == []


def test_pii_precision_and_recall_on_written_truth(spark):
    rng = random.Random(3)
    docs = documents(spark, [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(30))) for i in range(50)])
    model = pii.fit_trees(docs)
    lines = [(t, truth) for t, truth in pii.written(seed=77) if truth is not None]       # another draw than the fitted one
    spans = pii.added_spans([t for t, _ in lines], [[] for _ in lines], model)
    got = [(bool([s for s in found if s[1] in (0, 5)]), truth) for (_, truth), found in zip(lines, spans)]
    chosen = [truth for found, truth in got if found]
    assert sum(chosen) / len(chosen) > 0.93 and sum(chosen) / sum(t for _, t in lines) > 0.9
    masked = {r["doc_id"]: r["text"] for r in pii.redact(documents(spark, [
        (1, 'password = "correcthorsebatterystaple" x'), (2, "bob.smith (AT) example (DOT) com x")]), model).collect()}
    assert masked == {1: 'password = "[KEY]" x', 2: "[EMAIL] x"}


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 1] > 0.2) & (x[:, 3] < 0.5) | (x[:, 4] > 1.5)).astype(float)
    model = pii.boost(x[:3000], y[:3000], pii.Fit())
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


# ---------------------------------------------------------------- toxicity

def toxic_corpus(n=900, seed=6):
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in "ba de mi ro tu la".split() for b in "no ra ki so ve ple".split()]
    bad = ["nasty", "vilestuff", "vilething", "rotten"]
    docs, labels = [], []
    for i in range(n):
        w, toxic = rng.choices(clean, k=rng.randint(1, 120)), int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad) + rng.choice(["", "!!", "**"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxicity_learns_from_a_few_dozen_toxic_rows(spark):
    rows, labels = toxic_corpus(1500, seed=9)
    few = [(i, q, y) for k, (i, q, y) in enumerate(labels) if not y or k % 9 == 0 or zlib.crc32(str(i).encode()) % 3 == 1]
    assert 20 <= sum(y for i, _, y in few if zlib.crc32(str(i).encode()) % 3 != 1) <= 45
    docs = documents(spark, rows)
    model = toxicity.fit_model(docs, spark.createDataFrame(few, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    held = [(got[i], y) for i, _, y in few if zlib.crc32(str(i).encode()) % 3 == 1]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a, y in held if y for b, z in held if not z])
    assert auc > 0.95


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = documents(spark, rows + [(5000, None), (5001, ""), (5002, "nasty " * 9000), (None, "barano")])
    labelled = spark.createDataFrame(labels + [(7777, 1, 1), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_model(docs, labelled)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    assert len(got) == len(rows) + 4 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.95
    assert got[5002] > 0.7 > got[5001]
    flagged = {r["doc_id"]: r["rejected"] for r in toxicity.classify(docs, model).collect()}
    assert np.mean([flagged[i] == y for i, _, y in labels]) > 0.95


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = toxic_corpus(300)
    docs = documents(spark, rows)
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    scores = []
    for some in (labels, turned):
        model = toxicity.fit_model(docs, spark.createDataFrame(some, "doc_id long, quality int, toxic int"))
        scores.append(sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(docs, model).collect()))
    assert scores[0] == scores[1]


def test_thresholds_do_not_switch_with_the_number_of_labels():
    fit = toxicity.Fit()
    # over 0.52, "en" and "de" reach the precision; "xx" has clean rows up to 0.65
    rows = {("en", 400, 0): 900, ("en", 520, 0): 100, ("en", 560, 1): 300, ("en", 800, 1): 600}
    few = {("de", 520, 0): 2, ("de", 560, 1): 5, ("de", 800, 1): 5}
    many = {k: 100 * v for k, v in few.items()}
    clean = {("xx", 640, 0): 200, ("xx", 900, 1): 40}
    base, of_few = toxicity.thresholds({**rows, **few}, fit)
    _, of_many = toxicity.thresholds({**rows, **many}, fit)
    assert of_few["de"] == of_many["de"] == of_few["en"] == base < 0.57
    assert toxicity.thresholds({**rows, **clean}, fit)[1]["xx"] > 0.64
    # one row more or less moves nothing by the whole width
    for n in range(1, 60):
        assert toxicity.thresholds({**rows, ("fr", 800, 1): n}, fit)[1]["fr"] <= base
    assert toxicity.thresholds({}, fit) == (fit.base_threshold, {})


def test_thresholds_count_all_labelled_rows_outside_the_fit(spark):
    rows, labels = toxic_corpus()
    rows = [(i, t + " barano" * (2500 if i % 10 == 0 else 0)) for i, t in rows]      # long texts too
    fit = toxicity.Fit(max_positive=60, max_negative=100)
    seen = []

    def kept(src, known, fitted, model, real=toxicity.labelled_logits):
        rows = real(src, known, fitted, model)
        seen.append((Counter(r["y"] for r in rows.collect()), len(fitted)))
        return rows

    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "labelled_logits", kept)
        model = toxicity.fit_model(documents(spark, rows), labelled, fit)
    learnable = Counter(y for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 != 1)
    (counts, fitted), = seen
    assert 0 < fitted < 160 and sum(counts.values()) == sum(learnable.values()) - fitted
    assert counts[1] >= learnable[1] - fit.max_positive and "en" in model.thresholds
    flagged = {r["doc_id"]: r["threshold"] for r in toxicity.classify(documents(spark, rows), model).collect()}
    assert set(flagged.values()) == {model.thresholds["en"]}


def test_scale_is_set_on_long_texts_too(spark):
    rows, labels = toxic_corpus()
    # the long texts hold clean words only; every third is labelled toxic, so their odds are 1 to 2
    long = [(5000 + i, "barano" + " baranoso" * 2500) for i in range(300)]
    more = [(i, 1, int(i % 3 == 0)) for i, _ in long]
    models = [toxicity.fit_model(documents(spark, rows + long), spark.createDataFrame(some, "doc_id long, quality int, toxic int"))
              for some in (labels, labels + more)]
    assert models[0].scale != models[1].scale
    scores = [toxicity.score_documents(documents(spark, long[:1]), m).first()["score"] for m in models]
    assert scores[0] + 0.05 < scores[1] < 0.5


def test_toxicity_without_labels_or_rows(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit_model(docs, none) is None
    assert {r["score"] for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.classify(documents(spark, []), None).collect() == []


# ---------------------------------------------------------------- fingerprints

def shingles(text):
    w = re.split(r"[ \t\n\x0B\f\r]+", text.lower())
    w = [x for x in w if x]
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    rows = [(i, t) for i, t in awkward() if i not in (5, 10, None)]
    got = {r["doc_id"]: r for r in fingerprints.compare_edited(documents(spark, rows), k=4096).collect()}
    rows.sort()
    for at, (i, t) in enumerate(rows):
        t, after = t or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        # sketches this large hold every shingle, so the estimates are exact
        assert r["near_edited"] == pytest.approx(likeness(shingles(t), shingles(edited)))
        assert r["near_next"] == pytest.approx(likeness(shingles(t), shingles(after)))


def test_fingerprints_of_repeated_null_and_single_rows(spark):
    got = fingerprints.compare_edited(documents(spark, awkward())).collect()
    assert len(got) == len(awkward())
    one = fingerprints.compare_edited(documents(spark, [(4, "a b c d e f g")])).collect()
    assert [(r["near_next"], r["n_chars"]) for r in one] == [(1.0, 13)]
    assert fingerprints.compare_edited(documents(spark, [])).collect() == []


def test_sketch_estimates_and_merging(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    a = [f"w{rng.randint(0, 5000)}" for _ in range(4000)]
    b = a[:2000] + [f"v{rng.randint(0, 5000)}" for _ in range(2000)]
    df = spark.createDataFrame([(1, " ".join(a), " ".join(b))], "id long, a string, b string")
    s = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "x", 1024), "b", "y", 1024)
    x, y = F.col("x"), F.col("y")
    r = s.select(fingerprints.resemblance(x, y, 1024), fingerprints.containment(x, y, 1024), fingerprints.distinct_count(x, 1024),
                 fingerprints.merged(x, y, 1024)).first()
    A, B = shingles(" ".join(a)), shingles(" ".join(b))
    assert r[0] == pytest.approx(likeness(A, B), abs=0.06) and r[1] == pytest.approx(len(A & B) / len(A), abs=0.1)
    assert r[2] == pytest.approx(len(A), rel=0.15)
    parts = s.select(F.lit(7).alias("key"), F.explode(F.array("x", "y")).alias("sketch"))
    assert fingerprints.merge_parts(parts, "key", k=1024).first()["sketch"] == r[3]


# ---------------------------------------------------------------- archives

def test_loser_tree():
    rng = random.Random(1)
    lists = [sorted(rng.choices(range(50), k=rng.randint(0, 9))) for _ in range(13)]
    for k in range(14):
        assert [x for _, x in warc.LoserTree(lists[:k])] == sorted(sum(lists[:k], []))


def test_url_key_order():
    assert warc.url_key("HTTPS://www.Example.com:443/a?b#c") == "com,example)/a?b"
    assert warc.url_key("http://u:p@m.example.org:8080") == "org,example,m:8080)/"


def test_archives_round_trip(spark, tmp_path):
    rows = [(9, "http://a.example.com/x", "<p>é</p>", 1), (3, "http://b.example.com/\r\nx", "<p>é</p>", 1), (4, None, None, 1),
            (5, "", "", 1), (6, "http://a.example.com/x", "long " * 40000, 1), (7, "http://a.example.com/", "<p>é</p>", 1), (8, "ftp://z", "z", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")
    index, folder = warc.archive_pages(pages, f"file://{tmp_path}/archives")
    back = {r["page_id"]: r for r in warc.read_records(index, folder).collect()}
    least = {}
    for i, _, html, _ in sorted(rows):
        least.setdefault(html or "", i)
    for i, url, html, _ in rows:
        r, data = back[i], (html or "").encode()
        first = least[html or ""]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
        assert r["payload"] is None if first != i else bytes(r["payload"]) == data
    entries = index.orderBy("shard", "position").collect()
    keys = [(r["url_key"], r["capture"], r["page_id"]) for r in entries]
    assert keys == sorted(keys) and len(keys) == len(rows)


def test_archives_of_repeated_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (None, "u", "x")], "page_id long, url string, html string")
    index, folder = warc.archive_pages(pages)
    got = sorted(((r["page_id"], r["refers_to"]) for r in warc.read_records(index, folder).collect()), key=str)
    assert got == [(1, None), (1, None), (2, 1), (None, 1)]
    index, folder = warc.archive_pages(pages.limit(0))
    assert warc.read_records(index, folder).collect() == []


@pytest.mark.parametrize("k, block", [(1, 4), (7, 3), (40, 8)])
def test_merge_holds_a_block_of_each_run(k, block):
    rng = random.Random(k)
    blocks, whole = [], []
    for run in range(k):
        entries = sorted((f"u{rng.randrange(9)}", f"t{rng.randrange(5)}", True, rng.randrange(30)) for _ in range(rng.randint(1, 120)))
        keys = [(0, *e, run, i) for i, e in enumerate(entries)]
        whole += keys
        # a range may begin or end within a block
        low = rng.randrange(block)
        parts = [(keys[i], keys[max(i, low):i + block]) for i in range(0, len(keys), block)]
        blocks += [(head, part, part) for head, part in parts if part]
        whole = [x for x in whole if x[5] != run or x[6] >= low]
    taken = 0

    def reading():
        nonlocal taken
        for b in sorted(blocks, key=lambda b: b[0]):
            taken += len(b[1])
            yield b

    got = []
    for row in warc.merged(reading()):
        got.append(row)
        assert taken - len(got) <= (k + 1) * block
    assert got == sorted(whole)


def test_many_runs_and_times(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "http://hot.example.com/" if i % 3 == 0 else f"http://h{rng.randrange(9)}.example.com/{rng.randrange(40)}",
             f"page {rng.randrange(300)}", rng.randrange(2000)) for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, s long").withColumn("at", F.expr("timestamp_seconds(s * 60)"))
    index, folder = warc.archive_pages(pages.repartition(5), f"file://{tmp_path}/archives", "at", archive_bytes=8000, run_entries=16)
    entries = index.orderBy("shard", "position").collect()
    assert len({r["archive"] for r in entries}) > 5 and len({r["run"] for r in entries}) >= 44
    when = {i: datetime.fromtimestamp(60 * s, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for i, _, _, s in rows}
    want = sorted((warc.url_key(u), when[i], i) for i, u, _, _ in rows)
    assert [(r["url_key"], r["capture"], r["page_id"]) for r in entries] == want
    assert sorted(r["page_id"] for r in warc.read_records(index, folder).collect()) == list(range(700))
    # the same in several passes, from the same runs
    src = pages.select("page_id", "url", "html", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("capture"))
    runs = store(warc.write_archives(warc.with_responses(src), f"file://{tmp_path}/more", 8000, 16, block=4))
    passes = warc.merge_runs(runs, ranges=3, fan_in=4, block=4).orderBy("shard", "position").collect()
    assert [(r["url_key"], r["capture"], r["page_id"]) for r in passes] == want
    assert 1 < len({r["run"] for r in passes}) <= 4 and len({r["shard"] for r in passes}) > 1


def test_archives_of_string_ids(spark):
    ids = ["None", "a\r\nb", "", "é / %41>", "urn:page:1", None]
    pages = spark.createDataFrame([(x, "u", "same") for x in ids], "page_id string, url string, html string")
    index, folder = warc.archive_pages(pages)
    got = warc.read_records(index, folder).collect()
    assert sorted(map(str, [r["page_id"] for r in got])) == sorted(map(str, ids)) and None in {r["page_id"] for r in got}
    assert {r["refers_to"] for r in got if r["page_id"] != ""} == {""}
