"""Toxicity by a linear-chain conditional random field over words.

A chain has two states, clean and toxic. A word's emission weight is the sum of
the weights of its features, the word itself and its prefixes of 3 to 6 bytes;
transitions have four weights. The marginals of forward and
backward passes say how likely each word is toxic.

Labels are given for documents, so words are labelled first: features are picked
greedily that occur in many toxic documents not explained yet and hardly in clean
ones, and the words of toxic documents that bear a picked feature count as toxic.
The field is then fitted to the labelled words by gradient steps.

A document's score is a logistic function of the logarithm of its expected
number of toxic words, fitted on the same rows; its spans are the runs of words
with a marginal of at least one half, as code point offsets, end exclusive.

Model and labelled words come from a sample of at most SAMPLE labelled texts of
each class, taken whole in the order of the hash of doc_id until they have
SAMPLE_CHARS together; equal texts count once. A text of over SAMPLE_CHARS by itself is
drawn where its class has no shorter one. The sample and the model, whose features are
hashed to a fixed number, are all that the driver holds. Scoring reads whole texts in
place, without a shuffle.

Cases: a null or empty text has no words and the lowest score. Rows with a null
doc_id are scored, never learned from and never held out. Labels without a
document, null labels, and doc_ids and texts that are labelled both ways are left out. Where
that leaves no text of a class, every score is next to 0 (to 1 if all are toxic). Rows that
repeat are scored as often. Other columns are ignored by ``scores`` and handed
through by ``without_toxic``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import by_batch, stored, utf8

SAMPLE = 600
SAMPLE_CHARS = 4_000_000  # of each class; the text that reaches it is still taken
PREFIXES = (3, 4, 5, 6)
FEATURES = 2**20
THRESHOLD = 0.3
# Documents held out from learning: this remainder of crc32(doc_id as text) mod FOLDS.
FOLDS, HELD_OUT = 4, 2
STEPS, RATE, DECAY = 40, 0.3, 1e-4
FLOOR = 1e-6
# Expected toxic words that count as none: this many are given to the logistic function as clean.
NONE = 0.4
CACHE_WORDS = 400_000

WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(word: bytes) -> list[int]:
    """The word, marked by a space, and its prefixes, each as one of FEATURES numbers."""
    names = [b" " + word, *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(name) % FEATURES for name in names]


# --- chains -------------------------------------------------------------------


def mobius(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, width: int = 256) -> np.ndarray:
    """x[i] = (a[i] x[i-1] + b[i]) / (c[i] x[i-1] + d[i]); the first ignores x (a = c = 0).

    The chain is cut into rows of ``width``. Each row's map is composed first, for
    all rows at once, then entry values are passed from row to row, and then the
    rows are run side by side.
    """
    n = len(a)
    rows = -(-n // width)
    pad = rows * width - n
    # Transposed, so that a step of all rows lies together in memory.
    m = [
        np.ascontiguousarray(np.pad(x, (0, pad), constant_values=k).reshape(rows, width).T)
        for x, k in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0))
    ]
    p, q, r, s = (x[0].copy() for x in m)
    for k in range(1, width):
        e, f, g, h = (x[k] for x in m)
        p, q, r, s = e * p + f * r, e * q + f * s, g * p + h * r, g * q + h * s
        scale = 1.0 / (p + q + r + s)
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    entry = np.empty(rows)
    x = 1.0
    for k, (e, f, g, h) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        entry[k] = x
        x = (e * x + f) / (g * x + h)
    out = np.empty((width, rows))
    for k in range(width):
        entry = (m[0][k] * entry + m[1][k]) / (m[2][k] * entry + m[3][k])
        out[k] = entry
    return out.T.ravel()[:n]


def marginals(
    emission: np.ndarray, first: np.ndarray, last: np.ndarray, trans: np.ndarray, start: float, expect: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Of concatenated chains: each word's probability to be toxic; if asked for, the expected number of each step.

    Steps are clean to clean, clean to toxic, toxic to clean, toxic to toxic.
    """
    e = np.exp(np.clip(emission, -30, 30))
    t = np.exp(trans)
    forward = mobius(
        np.where(first, 0.0, e * t[1, 1]), e * np.where(first, math.exp(start), t[0, 1]),
        np.where(first, 0.0, t[1, 0]), np.where(first, 1.0, t[0, 0]),
    )
    nxt = np.append(e[1:], 1.0)
    backward = mobius(
        np.where(last, 0.0, nxt * t[1, 1])[::-1], np.where(last, 1.0, t[1, 0])[::-1],
        np.where(last, 0.0, nxt * t[0, 1])[::-1], np.where(last, 1.0, t[0, 0])[::-1],
    )[::-1]
    odds = forward * backward
    probs = odds / (1 + odds)
    if not expect:
        return probs, None
    before, here = forward[:-1][~first[1:]], (e * backward)[1:][~first[1:]]
    parts = t[0, 0], t[0, 1] * here, before * t[1, 0], before * t[1, 1] * here
    total = sum(parts)
    return probs, np.array([(p / total).sum() for p in parts])


def word_probabilities(emission: np.ndarray, sizes: list[int], trans: np.ndarray, start: float) -> np.ndarray:
    first = np.zeros(len(emission), bool)
    ends = np.cumsum(np.array(sizes)[np.array(sizes) > 0])
    first[np.append(0, ends[:-1])] = True
    last = np.zeros(len(emission), bool)
    last[ends - 1] = True
    return marginals(emission, first, last, trans, start)[0]


# --- learning -----------------------------------------------------------------


class Model:
    """Feature weights, transitions, and the logistic function of documents."""

    def __init__(self, weights: dict[int, float], bias: float, trans, start: float, slope: float, offset: float):
        self.weights, self.bias, self.trans, self.start = weights, bias, np.asarray(trans), start
        self.slope, self.offset = slope, offset
        self.cache: dict[bytes, float] = {}

    def emission(self, words: list[bytes]) -> list[float]:
        cache = self.cache
        for word in set(words).difference(cache):
            weights = self.weights
            cache[word] = self.bias + sum(weights.get(f, 0.0) for f in features(word))
        out = [cache[w] for w in words]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        return out

    def judge(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[list[bytes]], np.ndarray]:
        """Scores of texts, their words, and all the words' probabilities one after the other."""
        split = [(t or b"").translate(WORDS).split() for t in texts]
        flat = np.array([x for words in split for x in self.emission(words)], float)
        sizes = [len(w) for w in split]
        probs = word_probabilities(flat, sizes, self.trans, self.start) if len(flat) else flat
        through = np.append(0.0, np.cumsum(probs))
        ends = np.cumsum(sizes, dtype=int)
        expected = np.maximum(through[ends] - through[ends - sizes], 0) if len(sizes) else flat
        return self.score(expected), split, probs

    def score(self, expected: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.log(FLOOR + expected), -500, 500)))


def _constant(value: float) -> Model:
    return Model({}, -20.0, np.zeros((2, 2)), -20.0, 0.0, 800.0 if value else -800.0)


def _pick(doc_of: np.ndarray, feature_of: np.ndarray, toxic: np.ndarray, n_features: int) -> set[int]:
    """Features that together explain the toxic documents; (doc_of, feature_of) are distinct pairs."""
    clean_docs = np.bincount(feature_of[~toxic[doc_of]], minlength=n_features)
    ratio = toxic.sum() / max(1, (~toxic).sum())
    least = max(2.0, 0.004 * toxic.sum())
    mine = toxic[doc_of]
    docs, feats = doc_of[mine], feature_of[mine]
    picked: set[int] = set()
    while len(docs):
        gain = np.bincount(feats, minlength=n_features) - 20 * ratio * clean_docs
        best = int(gain.argmax())
        if gain[best] < least:
            break
        picked.add(best)
        explained = np.isin(docs, docs[feats == best])
        docs, feats = docs[~explained], feats[~explained]
    # The greedy choice stops at the first explanation of a document; others that are as good follow.
    whole = np.bincount(feature_of[mine], minlength=n_features)
    known = np.zeros(n_features, bool)
    known[list(picked)] = True
    lead = np.sort(whole[known])[len(picked) // 4] if picked else np.inf
    picked |= set(np.flatnonzero((whole >= lead) & (20 * ratio * clean_docs < 0.05 * whole)).tolist())
    return picked


def learn(texts: list[bytes], toxic: list[bool], clean_weight: float = 1.0) -> Model:
    """Fit a model; ``clean_weight`` is how many rows each clean text of the sample stands for, against a toxic one."""
    labels = np.array(toxic, bool)
    if not len(labels) or labels.all() or not labels.any():
        return _constant(float(len(labels) > 0 and labels.all()))
    # Words become numbers text by text; no list of all words is held.
    number: dict[bytes, int] = {}
    each = [np.array([number.setdefault(w, len(number)) for w in t.translate(WORDS).split()], np.int32) for t in texts]
    ids = np.concatenate(each)
    if not len(ids):
        return _constant(0.0)
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in each])
    del each
    of_word = [features(word) for word in number]
    many = np.array([len(f) for f in of_word])
    word_of = np.repeat(np.arange(len(number), dtype=np.int32), many)
    feature_of = np.fromiter((f for own in of_word for f in own), np.int32, len(word_of))
    begin = np.append(0, np.cumsum(many))
    del of_word

    distinct = np.unique(doc * len(number) + ids)
    d, w = distinct // len(number), distinct % len(number)
    many = np.diff(begin)[w]
    at = np.repeat(begin[w], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    seen = np.unique(np.repeat(d, many) * FEATURES + feature_of[at])
    picked = _pick((seen // FEATURES).astype(np.int32), (seen % FEATURES).astype(np.int32), labels, FEATURES)
    del seen, at, distinct, d, w
    bears = np.zeros(len(number), bool)
    bears[word_of[np.isin(feature_of, list(picked))]] = True
    gold = bears[ids] & labels[doc]

    first = np.append(True, doc[1:] != doc[:-1])
    last = np.append(first[1:], True)
    inner = ~first
    target = np.array([[(gold[:-1] == x) & (gold[1:] == y) & inner[1:] for y in (0, 1)] for x in (0, 1)]).sum(axis=2)
    theta = np.zeros(FEATURES + 4)  # features, four transitions
    trans = slice(FEATURES, None)
    # Fixed at the share of toxic words, so that a word without any known feature is as likely toxic as words are.
    bias, start = math.log((gold.sum() + 1) / (len(gold) + 2)), 0.0
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        score = np.bincount(word_of, theta[feature_of], len(number)) + bias
        probs, steps = marginals(score[ids], first, last, theta[trans].reshape(2, 2), start, expect=True)
        residual = probs - gold
        per_word = np.bincount(ids, residual, len(number))
        grad = np.append(np.bincount(feature_of, per_word[word_of], FEATURES), steps - target.ravel())
        grad = grad / len(texts) + DECAY * theta
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        theta -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)

    kept = np.where(np.abs(theta) > 0.02, theta, 0.0)[:FEATURES]
    score = np.bincount(word_of, kept[feature_of], len(number)) + bias
    probs, _ = marginals(score[ids], first, last, theta[trans].reshape(2, 2), start)
    x = np.log(FLOOR + np.bincount(doc, probs, len(texts)))
    weight = np.where(labels, 1.0, clean_weight)
    anchor = np.log(FLOOR + NONE), False, weight.sum() / 10
    slope, offset = _logistic(*(np.append(a, b) for a, b in zip((x, labels, weight), anchor, strict=True)))
    weights = {int(f): float(kept[f]) for f in np.flatnonzero(kept)}
    return Model(weights, bias, theta[trans].reshape(2, 2), start, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a small penalty that keeps separable data finite."""
    center, scale = x.mean(), x.std() or 1.0
    design = np.column_stack([(x - center) / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta -= np.linalg.solve(h, design.T @ (weight * (p - y)) + 0.1 * beta)
    slope = max(0.0, beta[0]) / scale
    return float(slope), float(beta[1] - slope * center)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from labelled texts that are not held out, of each class ``sample`` and about ``sample_chars`` at most."""
    learnable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter(F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT))
        .groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
        .filter("low = high").select("doc_id", (F.col("low") > 0).alias("toxic"))
    )
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    hashed = named.withColumn("hash", F.xxhash64("text"))
    # Lengths are known before the draw, so what is drawn is what is used.
    labelled = stored(
        hashed.groupBy("doc_id", "hash").agg(F.max(F.length("text")).alias("chars")).join(learnable, "doc_id"),
        "toxicity-labelled", narrow=True,
    )
    both_ways = labelled.groupBy("hash").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high")).filter("low <> high")
    eligible = labelled.join(both_ways, "hash", "left_anti")
    counts = Counter({row.toxic: row.n for row in eligible.groupBy("toxic").agg(F.count("*").alias("n")).collect()})
    chosen = []
    for toxic in counts:
        total = 0
        # Those that are longer than the whole sample may be come last.
        order = (F.col("chars") > sample_chars, F.xxhash64("doc_id"), "doc_id", "hash")
        for row in eligible.filter(F.col("toxic") == toxic).orderBy(*order).limit(sample).collect():
            if total and (total >= sample_chars or row.chars > sample_chars):
                break
            total += row.chars
            chosen.append((row.doc_id, row.hash, toxic))
    # The sample has a bounded size, so it is broadcast, and its texts are all that comes to the driver.
    few = docs.sparkSession.createDataFrame(chosen, "doc_id long, hash long, toxic boolean")
    rows = hashed.join(F.broadcast(few), ["doc_id", "hash"]).dropDuplicates(["doc_id", "text"]).toArrow()
    by_text: dict[bytes, bool] = {}
    both = sorted(zip(rows["doc_id"].to_pylist(), utf8(rows["text"].combine_chunks()), rows["toxic"].to_pylist(), strict=True))
    for _, text, label in both:
        by_text.setdefault(text, label)
    used = Counter(by_text.values())
    ratio = (counts[False] / max(1, used[False])) / (counts[True] / max(1, used[True]) or 1.0)
    return learn(list(by_text), list(by_text.values()), ratio)


# --- scoring ------------------------------------------------------------------


def _spans(text: bytes, probs: np.ndarray) -> list[dict]:
    """Runs of toxic words as code point offsets."""
    if not (probs >= 0.5).any():
        return []
    spans: list[dict] = []
    follows = False
    at = chars = 0
    for found, p in zip(WORD.finditer(text.translate(WORDS)), probs, strict=True):
        if p >= 0.5:
            chars += len(text[at : found.start()].decode())
            at, begin = found.start(), chars
            chars += len(text[at : found.end()].decode())
            at = found.end()
            if follows:
                spans[-1]["end"] = chars
            else:
                spans.append({"start": begin, "end": chars})
        follows = p >= 0.5
    return spans


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, score, predicted, spans (array of start and end)."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(rows.column(1))
        found, split, probs = model.judge(texts)
        spans, at = [], 0
        for text, words in zip(texts, split, strict=True):
            spans.append(_spans(text or b"", probs[at : at + len(words)]))
            at += len(words)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = [rows.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32)), pa.array(spans, kind)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    return by_batch(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), batch,
        "doc_id long, score double, predicted int, spans array<struct<start: int, end: int>>",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below the threshold."""
    model = train(docs, labels, sample)
    at = docs.columns.index("text")

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found, _, _ = model.judge(utf8(rows.column(at)))
        return rows.filter(pa.array(found < threshold))

    return by_batch(docs, batch, docs.schema)
