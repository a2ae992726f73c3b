"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct 3-, 4- and 5-grams of a lower-cased text (UTF-8 bytes, white space runs as one space, a space
at either end), hashed into ``2**BITS`` buckets.  The log-count ratios are corpus statistics over all training rows:
each task counts the documents of either class for each bucket and Spark adds the counts.

Labels are noisy, and with as many n-grams as there are, any text can be told from all others by n-grams of its own: a
model of all features learns wrong labels by heart.  So a feature has a weight only where its counts are no chance: the
likelihood ratio (G) of its 2 x 2 table of documents must reach ``least_g`` (15: one in 9,000 by chance, so about a
hundred of ``2**BITS`` buckets).  Words that tell the classes apart pass with few documents; n-grams of single texts never do.

Logistic regression on the present features times their ratios is then fitted to a bounded sample of the training rows:
the ``sample_rows`` distinct (text, label) of each class with the smallest hashes, whole texts, each with the number of
its rows as weight, and at most ``sample_features`` features together.  The sample is chosen by hashes and counts alone;
the chosen texts become features where they are.  Scoring is one pass without a shuffle.

Defined cases: null and empty texts have only the bias (and the n-grams of a lone space: none), so they score the same
low prior; without training rows of both classes every score is the smoothed share of label 1; several labels of a
document with the same value count as one training row each; equal texts with equal labels are one sampled row (ties of
the hash cannot split them); null labels are ignored; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import alone, slices, stored, utf8

BITS = 20
SIZES = (3, 4, 5)
SAMPLE_ROWS = 5000
SAMPLE_FEATURES = 10_000_000
#: Features whose counts have a smaller likelihood ratio may be chance and get no weight.
LEAST_G = 15.0
THRESHOLD = 0.3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


class Features:
    """The distinct buckets of texts; one per task, as it keeps a table of 2**BITS places."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int32)

    def of(self, raw: np.ndarray) -> np.ndarray:
        text = _FOLD[raw]
        space = text == 32
        if space.any():
            text = text[~(space & np.concatenate([[False], space[:-1]]))]
        if not len(text) or (len(text) == 1 and text[0] == 32):
            return np.zeros(0, np.int64)
        text = np.pad(text, (int(text[0] != 32), int(text[-1] != 32)), constant_values=32).astype(np.uint32)
        parts = []
        key = text
        for size in range(2, max(SIZES) + 1):
            if len(text) < size:
                break
            key = key[:-1] * np.uint32(0x9E3779B1) + (text[size - 1 :] + np.uint32(1))
            if size in SIZES:
                parts.append(((key ^ (key >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
        at = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        here = np.arange(len(at), dtype=np.int32)
        self.last[at] = here
        return at[self.last[at] == here]


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offs = utf8(column)
    for i, j in slices(offs):
        for k in range(i, j):
            yield data[offs[k] : offs[k + 1]]


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 0 and 1 (rows), and of each bucket: arrays [2] and [2, 2**BITS]."""

    def count(batches):
        features, both, n = Features(), np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), _texts(batch.column("text")), strict=True):
                both[label, features.of(text)] += 1
                n[label] += 1
        if n.sum():
            at = np.flatnonzero(both.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), *(pa.array(np.append(both[k, at], n[k]).astype(np.int64)) for k in (0, 1))], names=["bucket", "n0", "n1"])

    got = rows.mapInArrow(alone(count), "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    bucket, n0, n1 = (got[c].to_numpy() for c in ("bucket", "n0", "n1"))  # at most 2**BITS + 1 rows
    totals, counts = np.zeros(2), np.zeros((2, 1 << BITS))
    real = bucket >= 0
    counts[0, bucket[real]], counts[1, bucket[real]] = n0[real], n1[real]
    if (~real).any():
        totals[:] = n0[~real][0], n1[~real][0]
    return totals, counts


def likelihood_ratio(totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """G of each bucket: twice the log-likelihood gained by counting it by class instead of alike in both."""
    here, n = counts.sum(axis=0), totals.sum()
    g = np.zeros(counts.shape[1])
    for k in (0, 1):
        for seen, expected in ((counts[k], here * totals[k] / n), (totals[k] - counts[k], (n - here) * totals[k] / n)):
            some = seen > 0
            g[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    return g


def _sample(rows: DataFrame, most: int, most_features: int, telling: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Telling features, labels and weights (rows) of the sampled texts; ``rows``: ``text, label, mark``."""
    sent = rows.sparkSession.sparkContext.broadcast(telling)  # 2**BITS bytes
    chosen = None
    for label in (0, 1):  # hashes and counts only
        part = rows.where(F.col("label") == label).groupBy("label", "mark").agg(F.count("*").alias("weight")).orderBy("mark").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    taken = rows.join(F.broadcast(chosen), ["label", "mark"]).select("label", "mark", "weight", "text")  # 2 * most rows

    def encode(batches):
        features, telling, met = Features(), sent.value, set()
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("mark").to_pylist(), strict=True))
            keep = [k for k, key in enumerate(keys) if key not in met and not met.add(key)]  # at most 2 * most
            some = batch.take(pa.array(keep, pa.int64()))
            found = (features.of(t) for t in _texts(some.column("text")))
            yield pa.RecordBatch.from_arrays([some.column("label"), some.column("mark"), some.column("weight"), pa.array([at[telling[at]].astype(np.int32).tobytes() for at in found], pa.binary())], names=["label", "mark", "weight", "at"])

    xs, ys, ws, used, last = [], [], [], 0, None
    found = taken.mapInArrow(alone(encode), "label int, mark long, weight long, at binary").orderBy("mark", "label")
    for row in found.toLocalIterator():
        if used >= most_features:
            break
        if last == (row["mark"], row["label"]):  # a copy from another task
            continue
        last = row["mark"], row["label"]
        xs.append(np.frombuffer(row["at"], np.int32))
        ys.append(row["label"])
        ws.append(row["weight"])
        used += len(xs[-1])
    return xs, np.array(ys, float), np.array(ws, float)


class Model:
    """score = logistic(bias + the sum of the weights of a text's buckets)."""

    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights = bias, weights.astype(np.float32)

    def scores(self, column: pa.Array) -> np.ndarray:
        features = Features()
        z = np.array([self.bias + float(self.weights[features.of(t)].sum(dtype=np.float64)) for t in _texts(column)])
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(rows: DataFrame, *, sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES, least_g: float = LEAST_G, smooth: float = 1.0, penalty: float = 1.0, rounds: int = 50) -> Model:
    """A model of rows ``text, label`` (label 0 or 1)."""
    rows = stored(rows.withColumn("mark", F.xxhash64("text", "label")), "training")
    totals, counts = bucket_counts(rows)
    prior = (totals[1] + smooth) / (totals.sum() + 2 * smooth)
    bias = float(np.log(prior / (1 - prior)))
    if not totals.all():
        return Model(bias, np.zeros(1 << BITS))
    share = (counts + smooth) / (totals[:, None] + 2 * smooth)
    ratio = np.log(share[1]) - np.log(share[0])
    xs, y, weight = _sample(rows, sample_rows, sample_features, likelihood_ratio(totals, counts) >= least_g)
    used, at = np.unique(np.concatenate(xs) if xs else np.zeros(0, np.int32), return_inverse=True)
    row = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    for label, part in ((0, 1 - prior), (1, prior)):  # the classes weigh as in all training rows
        weight[y == label] *= part * len(y) / max(1.0, weight[y == label].sum())
    value = ratio[used][at]
    v, b = np.zeros(len(used)), bias
    # gradient descent with per-feature steps (AdaGrad) and an L2 penalty, from the prior
    scale, scale_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(row, value * v[at], minlength=len(xs))
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        g = np.bincount(at, value * slope[row], minlength=len(used)) + penalty * v
        scale += g * g
        v -= 0.05 * g / np.sqrt(scale)
        scale_b += slope.sum() ** 2
        b -= 0.05 * slope.sum() / np.sqrt(scale_b)
    weights = np.zeros(1 << BITS)
    weights[used] = v * ratio[used]
    return Model(float(b), weights)


def score(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``score, predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 * 2**BITS bytes
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.col(text).alias("_text"))

    def run(batches):
        for batch in batches:
            s = sent.value.scores(batch.column("_text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(s, pa.float64())], names=[*(f"c{k}" for k in range(len(keep))), "score"])

    out = rows.mapInArrow(alone(run), rows.drop("_text").schema.add("score", "double"))
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id: str = "doc_id"):
    """True for the documents whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``text, label`` of the labelled documents that are not held out; the labels grow with the corpus, so the join shuffles at every size."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")).distinct()
    return docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(known.hint("merge"), "_id").select("text", "label")
