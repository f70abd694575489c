"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (labelled good) and one of the raw
corpus, give every document the log ratio of its likelihoods. Gumbel noise on that weight and a
top-k cut draw ``k`` documents without replacement in proportion to the weights.

N-grams run over two streams: the words, and the words' shapes (runs of capitals, small letters,
digits or one same sign count once; a word equal to the one before it has a shape of its own).
Shapes are few, so they tell shouting, sign junk, tables and stuttering from prose in any
language, which buckets shared by rare words can't.

Counts cover all documents. Only labels are bounded: at most ``max_labels``, in hash order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import Scratch
from corpusmill.llm.words import Words, _Powers, mix, parts, word_slices

BUCKETS = 1 << 14            # of hashed n-grams
MAX_LABELS = 100_000
BINS = 4096                  # of a counting pass for the cut

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 65           # capitals
_CLASS[97:123] = 97          # small letters
_CLASS[48:58] = 48           # digits
_CLASS[128:] = 97            # letters beyond ASCII


def _shapes(words: Words) -> np.ndarray:
    shapes = np.empty(len(words.starts), np.uint64)
    with np.errstate(over="ignore"):
        for runs, at in parts(words.starts, words.ends):
            kind, begin, end = _CLASS[words.data[at]], words.starts[runs] - at.start, words.ends[runs] - at.start
            fresh = np.ones(len(kind), bool)
            fresh[1:] = kind[1:] != kind[:-1]
            fresh[begin] = True
            place = np.cumsum(fresh)
            up, down = _Powers.get(len(kind) + 2)
            prefix = np.zeros(len(kind) + 1, np.uint64)
            np.cumsum((kind.astype(np.uint64) + np.uint64(7)) * up[place] * fresh, out=prefix[1:])
            shapes[runs] = mix((prefix[end] - prefix[begin]) * down[place[begin]])
        again = np.zeros(len(shapes), bool)
        again[1:] = words.digests[1:] == words.digests[:-1]
        again[words.first[:-1][words.first[:-1] < len(again)]] = False
        return np.where(again, mix(shapes + np.uint64(99)), shapes)


def _ngrams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of each one- and two-gram of the words and of their shapes."""
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    within = np.flatnonzero(row[1:] == row[:-1])
    with np.errstate(over="ignore"):
        for salt, stream in ((1, words.digests), (2, mix(_shapes(words)))):
            yield (mix(stream + np.uint64(salt)) % np.uint64(BUCKETS)).astype(np.int64), row
            pairs = mix(stream[within] * np.uint64(31) + stream[within + 1] + np.uint64(salt + 4))
            yield (pairs % np.uint64(BUCKETS)).astype(np.int64), row[within]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per bucket of all rows, and of the rows whose ``good`` is true."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch.column("good").fill_null(False).to_numpy(zero_copy_only=False)
        for words in word_slices(batch.column("text")):
            chosen = good[words.rows]
            for bucket, row in _ngrams(words):
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[chosen[row]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                     ["bucket", "raw", "target"])


def weight_of(text: Column, ratio: np.ndarray) -> Column:
    """Log likelihood ratio of a text; 0 for a null text or one without words."""
    @F.arrow_udf("double")
    def weigh(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column))
        for words in word_slices(column):
            for bucket, row in _ngrams(words):
                out[words.rows] += np.bincount(row, ratio[bucket], len(words.first) - 1)
        return pa.array(out)
    return weigh(text)


def labels_sample(labels: DataFrame, key: str, label: str, max_labels: int) -> DataFrame:
    """(key, good) of at most ``max_labels`` labels in hash order; keys labelled both ways are out."""
    clean = labels.select(F.col(f"`{key}`").cast("long").alias("key"), (F.col(f"`{label}`") > 0).alias("good")).dropna()
    rows = clean.orderBy(F.xxhash64("key", "good"), "key", "good").limit(max_labels).collect()
    kinds: dict = {}
    for k, good in rows:
        kinds.setdefault(k, set()).add(good)
    return labels.sparkSession.createDataFrame(
        [(k, next(iter(v))) for k, v in kinds.items() if len(v) == 1], "key long, good boolean")


def log_ratio(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log of target over raw probability for every bucket, add-one smoothed."""
    counts = (docs.join(F.broadcast(sample), "key", "left").select("text", "good")
                  .mapInArrow(_count, "bucket long, raw long, target long")
                  .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return (np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS)))


def cut_between(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts labelled good from bad with fewest errors, mid-way in the widest such gap.

    Without bad labels nothing is cut; without good ones the raw model itself is the target.
    """
    if not len(good) or good.all():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, y = weights[order], good[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([[(~y).sum()], (~y).sum() - np.cumsum(~y)])
    edges = np.concatenate([[w[0] - 1], w, [w[-1] + 1]])
    gaps = np.diff(edges)
    gaps[errors > errors.min()] = -1
    at = int(np.argmax(gaps))
    return float((edges[at] + edges[at + 1]) / 2)


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The ``k``-th largest value, by passes that count rows per bin of an ever smaller range."""
    x = F.col(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    while low < high:
        width = (high - low) / BINS
        if width <= 0 or low + width <= low:
            width = high - low
        bins = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        found = df.where((x >= F.lit(low)) & (x <= F.lit(high))).groupBy(bins).agg(
            F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).orderBy(F.desc("bin")).collect()
        for r in found:
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             k: int | None = None, max_labels: int = MAX_LABELS, seed: int = 42) -> DataFrame:
    """``docs`` with ``log_weight``, ``score`` (weight plus Gumbel noise) and ``kept`` (in the top k).

    ``k`` defaults to the number of documents on the good side of the cut that parts the labelled
    rows best. Noise is a digest of key and text, so runs agree, and rows that repeat both are kept
    or dropped together (then more than ``k`` may stay). A null or blank text has weight 0. A null
    label, and a key with labels of both kinds, counts as no label. Columns of ``docs`` with one of
    the three new names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("log_weight", "score", "kept")
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    sample = labels_sample(labels, key, label, max_labels)
    ratio = log_ratio(narrow, sample)
    scored = _scored(docs, key, text, ratio, seed)
    table = Scratch(spark, "quality").write(
        scored.select(F.col(f"`{key}`").cast("long").alias("key"), "log_weight", "score"), "scores")
    if k is None:
        known = table.join(F.broadcast(sample), "key").select("log_weight", "good").limit(2 * max_labels).toPandas()
        cut = cut_between(known["log_weight"].to_numpy(float), known["good"].to_numpy(bool))
        k = table.where(F.col("log_weight") > F.lit(cut)).count()
    total = table.count()
    if k >= total:
        return scored.withColumn("kept", F.lit(True))
    if k <= 0:
        return scored.withColumn("kept", F.lit(False))
    return scored.withColumn("kept", F.col("score") >= F.lit(kth_largest(table, "score", k)))


def _scored(docs: DataFrame, key: str, text: str, ratio: np.ndarray, seed: int) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    digest = F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("string"), body)
    unit = (F.pmod(digest, F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    return (docs.withColumn("log_weight", weight_of(body, ratio))
                .withColumn("score", F.col("log_weight") - F.log(-F.log(unit))))
