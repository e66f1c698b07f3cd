"""Convolutional text classifier for toxicity, trained and applied in numpy.

A word is the sum of hashed embeddings (of the word, and of its first four and five bytes, which
inflected forms share). Filters of several widths run over the words of a whole text; the largest response of
each filter is kept, and a logistic layer turns these into a probability. Its scale and the thresholds by
language are calibrated on all learnable labelled rows
that took no part in the fit, long ones too: the executors score and count them. A language's precision is
shrunk towards that of all languages together, so a language of few or no labels has about the pooled threshold.

The fit reads a bounded sample of the labelled rows (``max_positive``, ``max_negative``, rows of at
most ``max_words`` words, chosen by a hash of the id; at most 100 MB of word ids); every other
step covers all rows.

Defined results: a null or empty text counts as a text without words and has a score too; labels that
are null or of unknown ids are not used; if an id is labelled twice, any label above 0 makes it
toxic; without both kinds of labels every score is 0; every input row has one output row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, append_texts, map_texts, store, with_text
from .hashing import NON_WORD, SMALL, Words

BITS = 16          # size of the embedding table
PREFIXES = (4, 5)  # bytes of a word that have an embedding of their own
PAD = 3            # words of padding after each text: the width of the widest filter
BINS = 1000        # of the scores from 0 to 1, for the thresholds
START = 0.3        # of the log-odds, in the embedding that the fit starts from
FINE, LIMIT = 64, 32   # bins of the logits, for the scale: so many to 1, from -LIMIT to LIMIT


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit."""

    max_positive: int = 3000
    max_negative: int = 5000
    max_words: int = 2000
    dims: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-5
    seed: int = 7
    calibration_share: float = 0.25
    blank_share: float = 0.02
    precision: float = 0.95
    base_threshold: float = 0.7
    pooled_weight: float = 20.0   # rows that the pooled precision counts as in a language's own
    smoothing: float = 2.0        # documents of each label that every word counts as more, where the fit starts


@dataclass
class Model:
    widths: tuple[int, ...]
    embedding: np.ndarray
    conv: list[np.ndarray]                # for each width: (width, dims, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)
    threshold: float | None = None        # of languages without labels; None: the base threshold

    def pooled(self, ids: np.ndarray, bounds: np.ndarray, where: bool = False):
        """Largest response of each filter in each text (and its word), from padded word ids."""
        x = self.embedding[ids[0]]
        for more in ids[1:]:
            x += self.embedding[more]
        x[ids[0] == 0] = 0
        best, at = [], []
        for w, kernel, bias in zip(self.widths, self.conv, self.bias):
            y = x @ kernel[0]
            for j in range(1, w):
                y[:-j] += x[j:] @ kernel[j]
            y += bias
            for j in range(1, w):      # these windows would reach into the next text
                y[bounds[1:] - j] = -np.inf
            top = np.maximum.reduceat(y, bounds[:-1], axis=0)
            best.append(top)
            if where:
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                found = np.zeros(top.shape, np.int64)
                r, c = np.nonzero(y == top[doc])
                found[doc[r[::-1]], c[::-1]] = r[::-1]
                at.append(found)
        return np.concatenate(best, 1), (x, at)

    def logits(self, ids, bounds) -> np.ndarray:
        return np.maximum(self.pooled(ids, bounds)[0], 0) @ self.out + self.out_bias

    def score(self, ids, bounds) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.logits(ids, bounds) + self.scale[1], -30, 30)))


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids per word, one row for each kind of embedding (0: padding), and the bounds of the texts."""
    small = [t.lower().encode("utf-8", "surrogatepass").translate(SMALL) for t in texts]
    words = Words(small, NON_WORD, PREFIXES)
    bounds = np.concatenate([[0], np.cumsum(np.diff(words.bounds) + PAD)])
    place = np.arange(len(words.hash)) + PAD * words.doc()
    ids = np.zeros((1 + len(PREFIXES), bounds[-1]), np.int32)
    for row, h in zip(ids, [words.hash, *words.prefixes]):
        row[place] = 1 + (h >> np.uint64(33)).astype(np.int32) % ((1 << BITS) - 1)
    return ids, bounds


def log_odds(texts: list[np.ndarray], y: np.ndarray, smoothing: float) -> np.ndarray:
    """Of every id of the table: how much likelier a toxic text holds it than a clean one, as a share of a word's kinds of ids."""
    seen = np.zeros((2, 1 << BITS))
    for ids, label in zip(texts, y):
        seen[int(label > 0), np.unique(ids)] += 1
    n = np.array([[(y <= 0).sum()], [(y > 0).sum()]])
    rate = np.log((seen + smoothing) / (n + 2 * smoothing))
    odds = np.where(seen.sum(0) > 0, rate[1] - rate[0], 0.0) / (1 + len(PREFIXES))
    odds[0] = 0.0
    return odds.astype(np.float32)


def train(texts: list[np.ndarray], y: np.ndarray, fit: Fit) -> Model:
    """Fit by Adam on texts given as padded id arrays."""
    rng = np.random.default_rng(fit.seed)
    model = Model(fit.widths, rng.normal(0, 0.1, (1 << BITS, fit.dims)).astype(np.float32),
                  [rng.normal(0, (w * fit.dims) ** -0.5, (w, fit.dims, fit.filters)).astype(np.float32) for w in fit.widths],
                  [np.zeros(fit.filters, np.float32) for _ in fit.widths],
                  rng.normal(0, 0.3, fit.filters * len(fit.widths)).astype(np.float32), 0.0)
    # one filter of one word starts as the log-odds of the words: with few labels, rare cue words would drown otherwise
    model.embedding[:, 0] = START * log_odds(texts, y, fit.smoothing)
    model.conv[0][0, :, 0] = np.eye(fit.dims, dtype=np.float32)[0]
    model.out[0] = 1.0
    bias = np.zeros(1, np.float32)
    weights = [model.embedding, *model.conv, *model.bias, model.out, bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, k = 0, len(fit.widths)
    for _ in range(fit.epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), fit.batch):
            rows = order[begin:begin + fit.batch]
            ids = np.concatenate([texts[i] for i in rows], axis=1)
            bounds = np.concatenate([[0], np.cumsum([texts[i].shape[1] for i in rows])])
            top, (x, at) = model.pooled(ids, bounds, where=True)
            act = np.maximum(top, 0)
            model.out_bias = float(bias[0])
            p = 1 / (1 + np.exp(-np.clip(act @ model.out + model.out_bias, -30, 30)))
            d = ((p - y[rows]) / len(rows)).astype(np.float32)
            grads = [np.zeros_like(w) for w in weights]
            grads[-1][0], grads[-2][:] = d.sum(), act.T @ d + fit.decay * model.out
            back = (d[:, None] * model.out) * (top > 0)
            for i, w in enumerate(fit.widths):
                g = back[:, i * fit.filters:(i + 1) * fit.filters]
                grads[1 + k + i][:] = g.sum(0)
                r, c = np.nonzero(g)
                for j in range(w):
                    pos = np.minimum(at[i][r, c] + j, ids.shape[1] - 1)
                    v = g[r, c][:, None]
                    np.add.at(grads[1 + i][j].T, c, v * x[pos])
                    into = v * model.conv[i][j].T[c] * (ids[0, pos] > 0)[:, None]
                    for row in ids:
                        np.add.at(grads[0], row[pos], into)
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= fit.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model.out_bias = float(bias[0])
    return model


def platt(logits: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic scaling, by gradient descent on smoothed targets; ``rows``: how many have each logit."""
    n1, n0 = rows[y > 0].sum(), rows[y == 0].sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    share = rows / rows.sum()
    spread = max(float(np.sqrt(share @ (logits - share @ logits) ** 2)), 1e-6)
    z, s, c = logits / spread, 1.0, 0.0
    for _ in range(2000):
        g = 1 / (1 + np.exp(-np.clip(s * z + c, -30, 30))) - t
        s, c = s - 0.5 * float(share @ (g * z)), c - 0.5 * float(share @ g)
    return max(s, 0.0) / spread, c


def thresholds(counts: dict, fit: Fit) -> tuple[float, dict]:
    """The pooled threshold, and that of each language, from {(language, bin, label): rows}.

    A threshold is the least labelled score, between 0.5 and the base threshold, at or over which the wanted precision
    holds. A language's precision counts the pooled one as ``pooled_weight`` rows more.
    """
    low, high = BINS // 2, round(BINS * fit.base_threshold)
    names = sorted({k[0] for k in counts})
    n = np.zeros((len(names), high - low + 1, 2))
    for (name, at, y), rows in counts.items():
        if at >= low:
            n[names.index(name), min(at, high) - low, y] += rows
    over = n[:, ::-1].cumsum(1)[:, ::-1]       # rows at or over each bin
    total, seen = over.sum(0), n.sum((0, 2)) > 0
    pooled = total[:, 1] / np.maximum(total.sum(1), 1)

    def least(precision: np.ndarray) -> float:
        good = np.flatnonzero((precision >= fit.precision) & seen)
        return (low + int(good[0])) / BINS if len(good) else fit.base_threshold

    own = (over[:, :, 1] + fit.pooled_weight * pooled) / (over.sum(2) + fit.pooled_weight)
    return least(pooled), {name: least(p) for name, p in zip(names, own) if name}


def labelled_logits(src: DataFrame, known: DataFrame, fitted: np.ndarray, model: Model) -> DataFrame:
    """(lang, y, logit) of all labelled rows but those of the fitted keys, stored. Texts are not shuffled."""
    keys = src.sparkSession.createDataFrame([(int(k),) for k in fitted], "key long")
    apart = known.join(F.broadcast(keys), F.xxhash64("id") == F.col("key"), "left_anti")
    shared = src.sparkSession.sparkContext.broadcast(model)

    def each(texts: list[str]) -> list[tuple]:
        return [(float(z),) for block in blocks(texts, STEP_BYTES // 16) for z in shared.value.logits(*word_ids(block))]

    rows = map_texts(src.select(F.struct("id", "lang").alias("id"), "text"), "id", "logit double", each)
    return store(rows.select("id.id", "id.lang", "logit").join(apart, "id").select("lang", "y", "logit"))


def counted_logits(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned logits, labels, and how many rows have them."""
    near = F.round(F.greatest(F.least("logit", F.lit(float(LIMIT))), F.lit(-float(LIMIT))) * FINE).cast("int")
    found = sorted((r["at"], r["y"], r["count"]) for r in rows.groupBy(near.alias("at"), "y").count().collect())
    at, y, n = np.array(found, float).T
    return at / FINE, y, n


def counted_scores(rows: DataFrame, scale: tuple[float, float]) -> dict:
    """{(language, score bin, label): rows} of the scores from 0.5 on."""
    score = 1 / (1 + F.exp(-(F.lit(scale[0]) * F.col("logit") + F.lit(scale[1]))))
    found = (rows.select(F.coalesce("lang", F.lit("")).alias("lang"), F.floor(score * BINS).cast("int").alias("at"), "y")
             .filter(F.col("at") >= BINS // 2).groupBy("lang", "at", "y").count())
    return {(r["lang"], r["at"], r["y"]): r["count"] for r in found.collect()}


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id",
              text_col: str = "text", lang_col: str | None = "lang", label_col: str = "toxic") -> Model | None:
    """The model from labelled rows that are not held out; None without both kinds of labels."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max((F.col("y") > 0).cast("int")).alias("y")))
    mixed = F.xxhash64("id", F.lit(fit.seed))
    # each limit is a parameter of the fit: the sample does not grow with the corpus
    sample = (known.filter("y = 1").orderBy(mixed, "id").limit(fit.max_positive)
              .unionByName(known.filter("y = 0").orderBy(mixed, "id").limit(fit.max_negative)))
    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      lang.alias("lang"))
    rows = src.join(F.broadcast(sample), "id").select("y", "lang", "text", F.xxhash64("id").alias("key"))
    most = fit.max_words

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            y, lg, key = batch.column("y"), batch.column("lang"), batch.column("key")
            packed = []
            for t in batch.column("text").to_pylist():
                ids, _ = word_ids([t])
                packed.append(ids.astype(np.uint16).tobytes() if ids.shape[1] <= most + PAD else None)
            yield pa.RecordBatch.from_arrays([y, lg, key, pa.array(packed, pa.binary())], names=["y", "lang", "key", "ids"])

    got = rows.mapInArrow(encode, "y int, lang string, key long, ids binary").filter("ids is not null").collect()
    got.sort(key=lambda r: (r["key"], r["y"], r["ids"]))
    if len({r["y"] for r in got}) < 2:
        return None
    texts = [np.frombuffer(r["ids"], np.uint16).astype(np.int32).reshape(1 + len(PREFIXES), -1) for r in got]
    y, langs = np.array([r["y"] for r in got], np.float32), np.array([r["lang"] or "" for r in got])
    apart = np.random.default_rng(fit.seed + 1).random(len(y)) < fit.calibration_share
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart = np.zeros(len(y), bool)
    # texts without words are clean: a few join the fit
    none = np.zeros((1 + len(PREFIXES), PAD), np.int32)
    blank = max(1, int(fit.blank_share * (~apart).sum()))
    model = train([x for x, z in zip(texts, apart) if not z] + [none] * blank,
                  np.concatenate([y[~apart], np.zeros(blank, np.float32)]), fit)
    fitted = np.array([r["key"] for r, z in zip(got, apart) if not z], np.int64) if apart.any() else np.zeros(0, np.int64)
    labelled = labelled_logits(src, known, fitted, model)
    model.scale = platt(*counted_logits(labelled))
    model.threshold, model.thresholds = thresholds(counted_scores(labelled, model.scale), fit)
    return model


def held_out(id_column):
    """Rows whose label is never learnt from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scorer(docs: DataFrame, model: Model | None):
    """Function from texts to scores that the tasks run; the model is of fixed size and broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: list[str]) -> list[tuple]:
        own = shared.value
        if own is None:
            return [(0.0,)] * len(texts)
        out: list[tuple] = []
        for block in blocks(texts, STEP_BYTES // 16):
            out += [(float(s),) for s in own.score(*word_ids(block))]
        return out

    return scores


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, score) for every whole text."""
    return map_texts(with_text(docs, id_col, text_col), id_col, "score double", scorer(docs, model))


def classify(docs: DataFrame, model: Model | None, fit: Fit = Fit(), text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """The rows with ``score``, the ``threshold`` of the row's language, and ``rejected``."""
    scored = append_texts(docs, text_col, "score double", scorer(docs, model))
    base = F.lit(fit.base_threshold if model is None or model.threshold is None else model.threshold)
    if model is not None and model.thresholds and lang_col in docs.columns:
        known = F.create_map(*[F.lit(x) for kv in sorted(model.thresholds.items()) for x in kv])
        base = F.coalesce(F.try_element_at(known, F.col(lang_col).cast("string")), base)
    return scored.withColumn("threshold", base).withColumn("rejected", F.col("score") >= F.col("threshold"))


def blocks(texts: list[str], limit: int):
    """Consecutive texts of at most ``limit`` characters together, or one text."""
    block, total = [], 0
    for t in texts:
        if block and total + len(t) > limit:
            yield block
            block, total = [], 0
        block.append(t)
        total += len(t)
    if block:
        yield block
