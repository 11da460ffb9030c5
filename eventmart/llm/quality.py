"""Text quality by naive Bayes support vectors over n-grams.

A text's features are indicators: which byte n-grams of ORDERS it holds, anywhere
in the whole text and with A-Z in either case apart, hashed to FEATURES numbers, and
whether it holds n-grams of REPEATS words that are all the same word. A feature is scaled by the logarithm of the ratio of its smoothed shares in good and
in bad texts (naive Bayes), and each text's vector then gets length one, so that
long texts don't outweigh short ones. A linear model of hinge loss is fitted to
the scaled vectors by dual coordinate descent, and its weights are drawn towards
their mean size by 1 - BETA, as naive Bayes would have it. The score is a logistic
function of the margin, fitted on margins of texts that a model has not seen.

Model and log-count ratios come from a sample: of each class at most SAMPLE
distinct texts, whole ones, in the order of the hash of the text, until they have
SAMPLE_CHARS together; the first text is taken whatever its length. Rows of the
sample are weighted so that both classes count as often as they are labelled.
Sample and model are all that the driver holds. Scoring reads whole texts where
they lie, without a shuffle.

Cases: a null or empty text has no features, and its score is that of the margin
that a text without any has. A text shorter than an order has no n-grams of it.
Rows with a null doc_id are scored, never learned from and never held out. Null
labels, labels without a document and documents without a label teach nothing; a
text that is labelled both ways counts for both. Where no text is labelled with a
class, every score is 0 (1 if all are good; 0.5 without any label). Rows that
repeat are scored as often, and equal texts count once for a class when learning.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from operator import and_, eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import by_batch, stored, utf8

ORDERS = (1, 2, 3)
FEATURES = 2**18
REPEATS = (2, 3, 4)
SAMPLE = 1500
SAMPLE_CHARS = 6_000_000  # of each class; the text that reaches it is still taken
SMOOTHING = 1.0
COST = 1.0
BETA = 0.5
EPOCHS = 12
CALIBRATION_FOLDS = 3
THRESHOLD = 0.5
# Documents held out from learning: this remainder of crc32(doc_id as text) mod FOLDS.
FOLDS, HELD_OUT = 3, 1
# Texts are looked at in pieces of this many bytes, so that arrays stay small.
PIECE = 2**20


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def _repeats(text: bytes) -> list[bool]:
    """Whether as many equal words as REPEATS says follow each other."""
    words = text.split()
    same = [*map(eq, words, words[1:])]
    runs = [same]
    while len(runs) < max(REPEATS) - 1:
        runs.append([*map(and_, runs[-1], same[len(runs) :])] if True in runs[-1] else [])
    return [True in runs[n - 2] for n in REPEATS]


def indicators(text: bytes | None) -> np.ndarray:
    """The distinct features of a whole text, sorted."""
    seen = np.zeros(FEATURES + len(REPEATS), bool)
    seen[FEATURES:] = _repeats(text or b"")
    codes = np.frombuffer(text or b"", np.uint8)
    longest = max(ORDERS)
    for at in range(0, len(codes), PIECE):
        piece = codes[at : at + PIECE + longest - 1].astype(np.uint32)
        for n in ORDERS:
            grams = np.full(max(0, min(PIECE, len(piece) - n + 1)), n, np.uint32)
            for k in range(n):
                grams = grams * np.uint32(0x01000193) + piece[k : k + len(grams)] + np.uint32(1)
            # The upper bits of a product by an odd constant depend on all lower ones.
            seen[(grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES.bit_length() + 1)] = True
    return np.flatnonzero(seen)


# --- learning -----------------------------------------------------------------


class Model:
    """Weights of the indicators before a text's vector is scaled to length one, and the logistic function."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.square, self.product = ratio.astype(np.float32) ** 2, (ratio * weights).astype(np.float32)
        self.bias, self.slope, self.offset = bias, slope, offset

    def margin(self, features: np.ndarray) -> float:
        length = float(self.square[features].sum(dtype=float))
        return self.bias + (float(self.product[features].sum(dtype=float)) / length**0.5 if length else 0.0)

    def score(self, texts: Sequence[bytes | None]) -> np.ndarray:
        margins = np.array([self.margin(indicators(t)) for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * margins, -500, 500)))


def _constant(probability: float) -> Model:
    none = np.zeros(FEATURES + len(REPEATS))
    return Model(none, none, 0.0, 0.0, {0.0: -800.0, 0.5: 0.0, 1.0: 800.0}[probability])


def log_count_ratios(rows: Sequence[np.ndarray], good: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each feature, the log of its share among the features of good texts over that among bad ones."""
    counts = [np.full(FEATURES + len(REPEATS), SMOOTHING), np.full(FEATURES + len(REPEATS), SMOOTHING)]
    for row, label, times in zip(rows, good, weight, strict=True):
        counts[int(label)][row] += times
    bad, fine = (c / c.sum() for c in counts)
    ratio = np.log(fine / bad)
    ratio[(counts[0] == SMOOTHING) & (counts[1] == SMOOTHING)] = 0.0  # never seen: tells nothing
    return ratio


def descend(
    rows: Sequence[np.ndarray], values: Sequence[np.ndarray], good: np.ndarray, cost: np.ndarray, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights and bias of the least hinge loss, by coordinate steps in the dual.

    Each text has one dual variable between 0 and its cost. A step sets one of them
    to its best value while the others stay, and moves the weights by as much.
    """
    sign = np.where(good, 1.0, -1.0)
    weights, bias = np.zeros(FEATURES + len(REPEATS)), 0.0
    dual = np.zeros(len(rows))
    curve = np.array([float(v @ v) for v in values]) + 1.0  # the bias is a feature of value one
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            row, value = rows[i], values[i]
            slope = sign[i] * (float(weights[row] @ value) + bias) - 1.0
            new = min(max(dual[i] - slope / curve[i], 0.0), cost[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weights[row] += step * value
                bias += step
                dual[i] = new
    return weights, bias


def _fit(rows: Sequence[np.ndarray], good: np.ndarray, weight: np.ndarray) -> Model:
    ratio = log_count_ratios(rows, good, weight)
    values = []
    for row in rows:
        value = ratio[row]
        values.append(value / (np.linalg.norm(value) or 1.0))
    weights, bias = descend(rows, values, good, COST * weight / weight.mean())
    even = np.abs(weights).mean()
    return Model(ratio, (1 - BETA) * even + BETA * weights, BETA * bias, 1.0, 0.0)


def _logistic(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps; targets a little inside 0 and 1 keep separable margins finite."""
    many, few = float(weight[good].sum()), float(weight[~good].sum())
    target = np.where(good, (many + 1) / (many + 2), 1 / (few + 2))
    center, scale = margins.mean(), margins.std() or 1.0
    design = np.column_stack([(margins - center) / scale, np.ones(len(margins))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta -= np.clip(np.linalg.solve(hessian, design.T @ (weight * (p - target)) + 1e-3 * beta), -2, 2)
    slope = max(0.0, beta[0]) / scale
    return float(slope), float(beta[1] - slope * center)


def learn(texts: Sequence[bytes], good: Sequence[bool], weight: Sequence[float] | None = None) -> Model:
    """Fit a model to labelled texts; ``weight`` says for how many rows each text stands."""
    labels = np.array(good, bool)
    if not len(labels):
        return _constant(0.5)
    if labels.all() or not labels.any():
        return _constant(float(labels.all()))
    times = np.ones(len(labels)) if weight is None else np.asarray(weight, float)
    times = times / times.mean()
    rows = [indicators(t) for t in texts]
    model = _fit(rows, labels, times)
    # Every class is dealt out over the folds, so that each fit has both where they have two texts.
    part = np.empty(len(labels), int)
    for label in (False, True):
        own = np.flatnonzero(labels == label)
        part[own] = np.arange(len(own)) % CALIBRATION_FOLDS
    margins = np.array([model.margin(r) for r in rows])
    for number in range(CALIBRATION_FOLDS):
        rest, held = np.flatnonzero(part != number), np.flatnonzero(part == number)
        if labels[rest].all() or not labels[rest].any():
            continue
        partial = _fit([rows[i] for i in rest], labels[rest], times[rest])
        margins[held] = [partial.margin(rows[i]) for i in held]
    model.slope, model.offset = _logistic(margins, labels, times)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from labelled texts that are not held out; of each class ``sample`` and about ``sample_chars`` at most."""
    learnable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("good"))
        .filter(F.col("good").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).distinct()
    )
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = named.filter("doc_id IS NOT NULL").withColumn("hash", F.xxhash64("text"))
    sizes = hashed.select("doc_id", "hash", F.length("text").alias("chars"))
    labelled = stored(sizes.join(learnable, "doc_id"), "quality-labelled", narrow=True)
    counts = {row.good: row.n for row in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    # One row stands for equal texts of a class.
    distinct = labelled.groupBy("good", "hash").agg(F.min("doc_id").alias("doc_id"), F.max("chars").alias("chars"))
    chosen = []
    for good in counts:
        total = 0
        for row in distinct.filter(F.col("good") == good).orderBy("hash").limit(sample).collect():
            if total >= sample_chars:
                break
            # A text that is longer than the whole sample may be is left to the end of its class.
            if total and row.chars > sample_chars:
                continue
            total += row.chars
            chosen.append((row.doc_id, row.hash, good))
    few = docs.sparkSession.createDataFrame(chosen, "doc_id long, hash long, good boolean")
    drawn = hashed.join(F.broadcast(few), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash", "good"]).toArrow()
    found = sorted(zip(drawn["good"].to_pylist(), drawn["hash"].to_pylist(), utf8(drawn["text"].combine_chunks()), strict=True))
    goods = [good for good, _, _ in found]
    share = {good: n / goods.count(good) for good, n in counts.items()}
    return learn([text for _, _, text in found], goods, [share[good] for good in goods])


# --- scoring ------------------------------------------------------------------


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, score, predicted."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(utf8(rows.column(1)))
        columns = [rows.column(0), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(plain, batch, "doc_id long, score double, predicted int")
