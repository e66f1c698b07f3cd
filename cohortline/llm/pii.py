"""Personal data in whole texts: generators propose spans, boosted trees and thresholds choose.

The base kinds (email, ip, card, phone) are exact patterns with checks and are always kept. Further
generators propose overlapping candidates with high recall (obfuscated addresses, grouped numbers,
account numbers, keys). Boosted trees score each candidate by format (length, character classes,
grouping, checksums) and context (cue words, quotes and assignment signs beside it); a threshold
per kind, calibrated to a precision, selects what is added. Added spans never overlap base spans.

The trees are fitted on candidates of a bounded sample of documents (``max_documents`` of at most
``max_chars``, ``max_candidates``, both chosen by a hash) and on written lines. The
thresholds are set on the candidates of all documents that were not fitted, scored and counted on the
executors, and on the written examples that were held back. The
tables hold no labels for spans, so checkable formats supply them there: a checksum, an octet range, a key
format or an assignment makes a candidate positive. The written lines carry their own truth, which the features do not hold.

Defined results: a null text counts as empty and has no spans; every input row has one output row.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_texts, map_texts, with_text

# Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "key", "ssn")
BASE = 4
# Bins of the margin, in which candidates are counted for the thresholds: so many to 1, from -LIMIT to LIMIT.
FINE, LIMIT = 32, 30

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, i = [], 0, text.find("@")
    while i >= 0:
        begin = i
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, i) if begin < i else None
        if m:
            out.append((begin, m.end()))
            done = m.end()
        i = text.find("@", max(i + 1, done))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CHAIN.finditer(text):
        runs = m[0].split(".")
        at = m.start()
        for k in range(0, len(runs) - 3, 4):
            four = runs[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(r.lstrip("0")) <= 3 and int(r.lstrip("0") or 0) <= 255 for r in four):
                out.append((at, end))
            at = end + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(text)
            if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, ordered by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(a, 1, b) for a, b in addresses(text)] if "." in text else []
        out += [(a, 2, b) for a, b in cards(text)]
        out += [(a, 3, b) for a, b in phones(text)] if "+" in text else []
    return sorted(out)


# ------------------------------------------------------------------ candidates

# Broad forms by kind. A key needs a digit, or a cue word and an assignment sign before it; an address an at sign in
# brackets; the others digits; so most texts are passed over.
GENERATORS = (
    (0, re.compile(r"[\w.%+-]{1,64}[ ]?[(\[{<]at[)\]}>][ ]?[\w-]{1,63}(?:[ ]?(?:\.|[(\[{<]dot[)\]}>])[ ]?[\w-]{1,63}){1,5}", re.I)),
    (2, re.compile(r"(?<![0-9])[0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}[ .-][0-9]{2,7}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])(?:00[ ]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    (4, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}=*(?![A-Za-z0-9_+/-])")),
    (6, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
)
_WITH_DIGIT = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*")
_CUES = re.compile(r"token|key|secret|passw|api|auth|iban|account|konto|ssn|social|phone|tel|call|mobile|card|mail|kontakt|contact", re.I)
_ASSIGNED = re.compile(r"""[=:]\s*["']?$""")
_AT = re.compile(r"[(\[{<]at[)\]}>]", re.I)
# a secret of letters only: 16 or more of them after a cue word and an assignment sign
_LETTERS = re.compile(r"""(?:token|key|secret|passw(?:or)?d|passphrase|pwd|auth)["']?[ \t]{0,4}(?:=|:|:=|=>)[ \t]{0,4}["']?([A-Za-z_+/-]{16,}=*)(?![A-Za-z0-9_+/-])""", re.I)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything the broad generators propose; spans may overlap."""
    out = []
    if _AT.search(text):
        out += [(m.start(), 0, m.end()) for m in GENERATORS[0][1].finditer(text)]
    if "=" in text or ":" in text:
        out += [(m.start(1), 5, m.end(1)) for m in _LETTERS.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for kind, pattern in GENERATORS[1:]:
        if kind == 5:
            for word in _WITH_DIGIT.finditer(text):
                if word.end() - word.start() >= 16:
                    out += [(word.start() + m.start(), 5, word.start() + m.end()) for m in pattern.finditer(word[0])
                            if _DIGIT.search(m[0])]
        else:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return out


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(text: str, begin: int, kind: int, end: int) -> list[float]:
    s, before, after = text[begin:end], text[max(0, begin - 32):begin], text[end:end + 2]
    n = len(s)
    counts = Counter(s)
    digits = digits_of(s)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    upper, lower = sum(c.isupper() for c in s), sum(c.islower() for c in s)
    return [kind, n, len(digits) / n, upper / n, lower / n, entropy, len(counts) / n, len(digits),
            sum(c in " -.()" for c in s), sum(c in "0123456789abcdefABCDEF" for c in s) / n,
            float(14 <= len(digits) <= 19 and luhn(digits)), float(kind == 4 and iban_ok(s)),
            float(s[:4] in ("AKIA", "ASIA", "ghp_", "AIza")), float(s.startswith("+")),
            float(bool(_CUES.search(before))), float(bool(_ASSIGNED.search(before))),
            float(before[-1:] in ('"', "'")), float(after[:1] in ('"', "'")), float(before[-1:].isalnum()),
            float(after[:1].isalnum()), float("/" in s), float("_" in s or "-" in s), float(digits[:1] in ("0", "9"))]


def weak_label(text: str, begin: int, kind: int, end: int) -> int:
    """What a checkable format says of a candidate."""
    s, before = text[begin:end], text[max(0, begin - 32):begin]
    digits = digits_of(s)
    if kind == 0:
        return int(bool(re.search(r"[A-Za-z]{2,}$", s)))
    if kind == 2:
        return int(14 <= len(digits) <= 19 and luhn(digits))
    if kind == 3:
        return int(digits[-10:-7] not in ("000", "911") and digits[-10] not in "01")
    if kind == 4:
        return int(iban_ok(s))
    if kind == 5:
        named = re.fullmatch(r"(?:AKIA|ASIA)[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|AIza[\w-]{35}", s)
        return int(bool(named) or bool(_ASSIGNED.search(before)) and bool(_CUES.search(before)))
    return int(digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000")


# ------------------------------------------------------------------ boosted trees

@dataclass(frozen=True)
class Fit:
    """Parameters of the fit."""

    max_documents: int = 4000
    max_chars: int = 100_000
    max_candidates: int = 20_000
    trees: int = 40
    depth: int = 3
    bins: int = 32
    rate: float = 0.25
    ridge: float = 1.0
    precision: float = 0.97
    seed: int = 11


@dataclass
class Trees:
    base: float
    nodes: list            # per tree: (feature, cut) per inner node in breadth order, then leaf values
    depth: int
    thresholds: dict

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (2 ** self.depth - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, fit: Fit) -> Trees:
    """Gradient boosting on the logistic loss: histogram trees of a fixed depth."""
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(rate / (1 - rate))), [], fit.depth, {})
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, fit.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    margin = np.full(len(y), model.base)
    inner = 2 ** fit.depth - 1
    for _ in range(fit.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-6, None, None)
            for j, c in enumerate(cuts):
                if len(rows) < 10 or not len(c):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, j], g[rows], len(c) + 1))
                hs = np.cumsum(np.bincount(binned[rows, j], h[rows], len(c) + 1))
                gain = (gs ** 2 / (hs + fit.ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + fit.ridge)
                        - gs[-1] ** 2 / (hs[-1] + fit.ridge))[:-1]
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
            if best[1] is not None:
                feature[node], cut[node] = best[1], cuts[best[1]][best[2]]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        g_leaf = np.bincount(at - inner, g, inner + 1)
        h_leaf = np.bincount(at - inner, h, inner + 1)
        leaf = -fit.rate * g_leaf / (h_leaf + fit.ridge)
        model.nodes.append((feature, cut, leaf))
        margin += leaf[at - inner]
    return model


def iban(country: str, account: str) -> str:
    """An account number with its check digits."""
    rest = int("".join(str(int(c, 36)) for c in account + country + "00")) % 97
    return f"{country}{98 - rest:02d}{account}"


def written(seed: int = 5, n: int = 60) -> list[tuple[str, int | None]]:
    """Written lines, each with the truth of its candidates as whoever wrote the line knows it (None: the format's
    checksum or rule is the truth). Features do not hold it: names after a cue word look like secrets, secrets stand without one."""
    rng = np.random.default_rng(seed)
    word = lambda n, s=string.ascii_lowercase: "".join(rng.choice(list(s), n))
    num = lambda n: word(n, string.digits)
    said = ("internationalization", "configuration_name", "responsibilities", "usr/local/share/documents", "getApplicationContext",
            "authentication-provider", "straightforwardly", "primary_key_constraint")
    lines: list[tuple[str, int | None]] = []
    for i in range(n):
        mixed = word(24, string.ascii_letters)
        lines += [(f'token = "{word(40, "0123456789abcdef")}" set', 1), (f"key AKIA{word(16, string.ascii_uppercase + '234567')} in", 1),
                  (f"api_key: {word(32, string.ascii_letters + string.digits)} ok", 1), (f"see {word(12)}{num(3)}-{word(6)} and so", 0),
                  (f'password = "{word(24) if i % 2 else mixed}" for', 1), (f"secret: {word(int(rng.integers(18, 30)))} now", 1),
                  (f"{('token', 'key', 'secret', 'auth')[i % 4]}: {said[i % len(said)]} is", 0),
                  (f"mail {word(6)} (at) {word(7)} (dot) com", 1), (f"bob.{word(5)} [AT] {word(6)} (DOT) org", 1),
                  (f"meet {word(4)} (at) {num(1)}.{num(2)} pm", 0),
                  (f"ssn {num(3)}-{num(2)}-{num(4)} of", None), (f"call ({num(3)}) {num(3)}-{num(4)} now", None),
                  (f"id {num(4)} {num(4)} {num(4)} {num(4)} x", None), (f"part {word(4)}{num(14)} of", 0),
                  (f"/{word(8)}/{num(8)}/{word(9)}.html x", 0), (f"iban DE{num(20)} here", None),
                  (f"code {word(2, string.ascii_uppercase)}{num(16)} there", None), (f"build-{num(8)}-{word(8)}-{num(6)} is", 0)]
    banks = (("DE", 0, 18), ("FR", 0, 23), ("ES", 0, 20), ("GB", 4, 14), ("NL", 4, 10), ("CH", 0, 17))
    for i in range(2 * n):
        country, letters, k = banks[i % len(banks)]
        s = iban(country, word(letters, string.ascii_uppercase) + num(k))
        s = s if i // len(banks) % 2 else " ".join(s[k:k + 4] for k in range(0, len(s), 4))
        lines.append(((f"iban {s} here", f"pay to {s}, please", f"konto: {s}.")[i % 5 % 3], None))
    return lines


def examples(seed: int = 5) -> list[tuple[list[float], int]]:
    """Features and truth of the candidates of the written lines."""
    return [(features(t, *c), truth if truth is not None and c[1] in (0, 5) else weak_label(t, *c))
            for t, truth in written(seed) for c in candidates(t)]


def fit_trees(docs: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees and thresholds from candidates of a bounded sample of documents and the written examples."""
    src = with_text(docs, id_col, text_col)
    mixed = F.xxhash64("id", F.lit(fit.seed))
    ids = src.select("id").filter("id is not null").orderBy(mixed, "id").limit(fit.max_documents).distinct()
    rows = (src.join(F.broadcast(ids), "id").filter(F.length("text") <= fit.max_chars))
    kinds = "found array<struct<x:array<double>,y:int>>"

    def propose(texts: list[str]) -> list[tuple]:
        return [([(features(t, *c), weak_label(t, *c)) for c in candidates(t)],) for t in texts]

    each = (map_texts(rows, "id", kinds, propose).select("id", F.posexplode("found").alias("i", "c"))
            .select("id", "i", "c.x", "c.y", F.xxhash64("id").alias("key"))
            .orderBy(F.xxhash64("id", "i"), "id", "i").limit(fit.max_candidates))
    got = [(r["x"], r["y"], (r["key"], r["i"])) for r in each.collect()]
    known = [(*e, None) for e in examples()]
    held = np.random.default_rng(fit.seed).random(len(got) + len(known)) < 0.3
    got += known
    x, y = np.array([g[0] for g in got]), np.array([g[1] for g in got], float)
    model = boost(x[~held], y[~held], fit)
    counts = counted(src, model, [g[2] for g, z in zip(got, held) if g[2] and not z])
    for g, z, at in zip(got, held, bins(model.margin(x))):
        if z and not g[2]:
            counts[(int(g[0][0]), at, g[1])] += 1
    model.thresholds = {kind: threshold(counts, kind, fit) for kind in range(len(KINDS))}
    return model


def bins(margin: np.ndarray) -> list[int]:
    return np.floor(np.clip(margin, -LIMIT, LIMIT) * FINE).astype(int).tolist()


def counted(src: DataFrame, model: Trees, fitted: list[tuple[int, int]]) -> Counter:
    """{(kind, bin of the margin, weak label): candidates} over all documents, without the fitted ones."""
    spark = src.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def each(texts: list[str]) -> list[tuple]:
        found = [candidates(t) for t in texts]
        flat = [(t, c) for t, cs in zip(texts, found) for c in cs]
        if not flat:
            return [([],)] * len(texts)
        at = iter(bins(shared.value.margin(np.array([features(t, *c) for t, c in flat]))))
        return [([(c[1], next(at), weak_label(t, *c)) for c in cs],) for t, cs in zip(texts, found)]

    rows = (map_texts(src, "id", "found array<struct<kind:int,bin:int,y:int>>", each)
            .select(F.xxhash64("id").alias("key"), F.posexplode("found").alias("i", "c")))
    gone = F.broadcast(spark.createDataFrame(fitted, "key long, i int"))
    found = rows.join(gone, ["key", "i"], "left_anti").groupBy("c.kind", "c.bin", "c.y").count()
    return Counter({(r["kind"], r["bin"], r["y"]): r["count"] for r in found.collect()})


def threshold(counts: Counter, kind: int, fit: Fit) -> float:
    """The least score, of 0.5 or more, at or over which the wanted precision holds; 1.1 if there is none."""
    best, right, total = 1.1, 0, 0
    for at in sorted({a for k, a, _ in counts if k == kind and a >= 0}, reverse=True):
        right += counts[(kind, at, 1)]
        total += counts[(kind, at, 0)] + counts[(kind, at, 1)]
        if right >= fit.precision * total:
            best = 1 / (1 + math.exp(-at / FINE))
    return best


# ------------------------------------------------------------------ operator

def added_spans(texts: list[str], base: list[list], model: Trees) -> list[list[tuple[int, int, int]]]:
    """Candidates over their kind's threshold that overlap neither a base span nor a better candidate."""
    found = [[c for c in candidates(t)] for t in texts]
    out: list[list] = [[] for _ in texts]
    flat = [(i, c) for i, cs in enumerate(found) for c in cs]
    if not flat:
        return out
    p = model.score(np.array([features(texts[i], *c) for i, c in flat]))
    limit = np.array([model.thresholds.get(c[1], 1.1) for _, c in flat])
    used = [stretches(spans) for spans in base]
    for k in np.argsort(-p, kind="stable").tolist():
        i, (a, kind, b) = flat[k]
        if p[k] >= limit[k]:
            begins, ends = used[i]
            at = bisect_right(begins, a)
            if (at == 0 or ends[at - 1] <= a) and (at == len(begins) or b <= begins[at]):
                begins.insert(at, a), ends.insert(at, b)
                out[i].append((a, kind, b))
    return out


def stretches(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Begins and ends of the disjoint stretches that spans, ordered by start, cover."""
    begins, ends = [], []
    for a, _, b in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a), ends.append(b)
    return begins, ends


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def finder(docs: DataFrame, model: Trees):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def find(texts: list[str]) -> list[tuple[list, list]]:
        base = [base_spans(t) for t in texts]
        return [(b, sorted(b + more)) for b, more in zip(base, added_spans(texts, base, shared.value))]

    return find


def find_pii(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts and digest of the base spans, and all spans."""
    find = finder(docs, model)

    def each(texts: list[str]) -> list[tuple]:
        out = []
        for base, spans in find(texts):
            counts = Counter(k for _, k, _ in base)
            out.append((*(counts[k] for k in range(BASE)),
                        hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        return out

    return map_texts(with_text(docs, id_col, text_col), id_col,
                     "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", each)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced by the name of its first kind."""
    parts, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, model: Trees, text_col: str = "text") -> DataFrame:
    """The rows with every span masked in the text; a null text becomes empty."""
    find = finder(docs, model)
    return append_texts(docs, text_col, f"`{text_col}` string",
                        lambda texts: [(masked(t, s),) for t, (_, s) in zip(texts, find(texts))]).select(docs.columns)
