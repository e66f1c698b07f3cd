"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

A text's words are the runs between white space, in lower case; its shingles are runs of five words
(a shorter text is one shingle, a text without words has none). The sketch holds the ``k`` smallest
distinct 64-bit hashes in ascending order. Sketches of parts merge into the sketch of the whole;
from sketches alone follow estimates of resemblance, containment and the number of shingles, all of
them exact while a set has no more than ``k`` shingles.

Defined results: a null text counts as empty; its sketch is empty, its fingerprint the empty string.
Two empty sketches resemble each other fully, an empty and a non-empty one not at all. Rows with one
id follow each other in the order of a hash of their text; a null id comes before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, with_text

SHINGLE = 5
K = 128


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """Hashes of all runs of ``n`` words of an array (of the whole array, if it is shorter)."""
    runs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(1))),
                       lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, n)]))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(runs)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text_col: str, name: str, k: int = K, n: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of a text column; the words are a column of their own, so they are cut once."""
    return (df.withColumn("_words", words_of(F.col(text_col)))
            .withColumn(name, bottom(shingle_hashes(F.col("_words"), n), k)).drop("_words"))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of shared over all shingles."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimate of the number of distinct shingles: from the k-th smallest hash, if there are so many."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of ``a``'s shingles that ``b`` has too."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merge_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from any number of parts.

    Every task first keeps the ``k`` smallest hashes it holds of a key (a window limited by its rank), so a
    key with very many parts sends ``k`` rows per task.
    """
    hashes = parts.select(key, F.explode_outer(sketch).alias("h"))
    least = Window.partitionBy(key).orderBy(F.col("h").asc_nulls_last())
    return (hashes.withColumn("r", F.dense_rank().over(least)).filter(F.col("r") <= k).dropDuplicates([key, "h"])
            .groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch)))


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of (id, text, ...) with ``next_<column>`` of the row that follows by id; the first follows the last.

    The ids are cut into ranges of about equal numbers of rows; the first rows of a range also go to the range
    before it, so one shuffle by range is enough.
    """
    n = 1
    while n < 4 * partitions(df.sparkSession) and n < 4096:
        n *= 2
    key = F.coalesce(F.col("id").cast("long"), F.lit(-2 ** 63))
    cuts = df.select(F.percentile_approx(key, [i / n for i in range(1, n)] or [1.0], 20 * n)).first()[0]
    if cuts is None:      # an empty table
        cuts = []
    cuts = [*cuts[:n - 1], *[2 ** 63 - 1] * (n - 1 - len(cuts))]
    table, halves = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array(F.lit(2 ** 63 - 1)), []
    while n > 1:
        n //= 2
        halves.append(n)
    keyed = df.withColumn("_key", key)
    if halves:
        found = F.reduce(F.array(*[F.lit(h) for h in halves]), F.lit(0),
                         lambda low, h: F.when(F.get(table, low + h - 1) < F.col("_key"), low + h).otherwise(low))
    else:
        found = F.lit(0)
    keyed = keyed.withColumn("_range", found)
    # at most 4096 ranges: this window sees one row of each
    heads = keyed.groupBy("_range").agg(F.min("_key").alias("_head"))
    line = Window.orderBy("_range")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_head", F.coalesce(F.lag("_range").over(line), F.max("_range").over(whole)).alias("_before"))
    own = F.struct(F.col("_range").alias("r"), F.lit(0).alias("again"))
    again = F.struct(F.col("_before").alias("r"), F.lit(1).alias("again"))
    placed = (keyed.join(F.broadcast(heads), F.col("_key") == F.col("_head"), "left")
              .withColumn("_place", F.explode(F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, again)))))
    follow = Window.partitionBy("_place.r").orderBy("_place.again", "_key", F.xxhash64("text"))
    out = placed.select("*", *[F.lead(c).over(follow).alias(f"next_{c}") for c in columns])
    return out.filter("_place.again = 0").select(*df.columns, *[f"next_{c}" for c in columns])


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The edited text ends with the beginning of the next document: its last floor(n/2) code points are replaced by
    as many of the next text, or by all of it.
    """
    sketched = with_sketch(with_text(docs, id_col, text_col), "text", "sketch", k)
    rows = with_next(sketched, ["text", "sketch"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - half),
                                              F.substring("next_text", F.lit(1), half)))
    rows = with_sketch(rows, "edited", "edited_sketch", k)
    return rows.select(
        F.col("id").alias(id_col), F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
