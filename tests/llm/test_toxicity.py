import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import toxicity as T


def by_enumeration(emission, trans, start):
    """Marginals and expected steps by summing over all state sequences."""
    n = len(emission)
    total, probs, steps = 0.0, np.zeros(n), np.zeros((2, 2))
    for states in itertools.product((0, 1), repeat=n):
        weight = math.exp(start * states[0] + sum(e for e, s in zip(emission, states) if s) + sum(trans[a][b] for a, b in zip(states, states[1:])))
        total += weight
        probs += weight * np.array(states)
        for a, b in zip(states, states[1:]):
            steps[a, b] += weight
    return probs / total, steps / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    trans, start = rng.normal(size=(2, 2)), 0.3
    chains = [rng.normal(size=k) for k in (1, 5, 2, 8, 3)]
    first = np.concatenate([np.arange(len(c)) == 0 for c in chains])
    last = np.concatenate([np.arange(len(c)) == len(c) - 1 for c in chains])
    probs, steps = T.marginals(np.concatenate(chains), first, last, trans, start, expect=True)
    each = [by_enumeration(c, trans, start) for c in chains]
    assert np.allclose(probs, np.concatenate([p for p, _ in each]))
    assert np.allclose(steps, sum(s for _, s in each).ravel())


def test_cut_of_a_chain_changes_nothing():
    rng = np.random.default_rng(2)
    a, b, c, d = rng.uniform(0.1, 2, size=(4, 1000))
    a[0] = c[0] = 0
    x, out = 0.0, []
    for k in range(1000):
        x = (a[k] * x + b[k]) / (c[k] * x + d[k])
        out.append(x)
    for width in (1, 7, 256, 2000):
        assert np.allclose(T.mobius(a, b, c, d, width), out)


def corpus(n=400):
    random.seed(9)
    clean = [f"word{k}" for k in range(200)] + ["Größe", "été"]
    bad = ["Vile", "nasty", "zorkling", "zorkler", "zorkest"]
    texts = []
    for k in range(n):
        words = random.choices(clean, k=random.randint(5, 60))
        if k % 5 == 0:
            for _ in range(random.randint(1, 3)):
                words.insert(random.randint(0, len(words)), random.choice(bad))
        texts.append((k, " ".join(words), int(k % 5 == 0)))
    return texts


def test_held_out_accuracy_and_offsets(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = T.train(docs, labels)
    held = F.crc32(F.col("doc_id").cast("string")) % T.FOLDS == T.HELD_OUT
    found = {r.doc_id: r for r in T.scores(docs, model).withColumn("held", held).collect()}
    assert sum(r.held for r in found.values()) > 50
    wrong = [i for i, text, toxic in rows if found[i].held and found[i].predicted != toxic]
    assert len(wrong) <= 2
    texts = {i: text for i, text, _ in rows}
    named = {texts[i][s.start : s.end].lower() for i, r in found.items() if r.predicted for s in r.spans}
    assert named and all(w.startswith(("vile", "nasty", "zork")) for span in named for w in span.split())


def test_held_out_labels_change_nothing(spark):
    rows = corpus(150)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % T.FOLDS == T.HELD_OUT
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = T.train(docs, labels), T.train(docs, flipped)
    assert one.weights == two.weights and one.offset == two.offset


def test_odd_rows(spark):
    rows = corpus(100)
    odd = [(None, "Vile nasty"), (900, None), (901, ""), (902, "word1 " * 30_000), (1, rows[1][1]), (1, rows[1][1])]
    docs = spark.createDataFrame([(*r[:2], "s") for r in rows] + [(*o, "s") for o in odd], "doc_id long, text string, score string")
    odd_labels = [(None, 1), (900, 1), (7, None), (8, 0), (8, 1), (5555, 1)]
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + odd_labels, "doc_id long, toxic int")
    model = T.train(docs, labels)
    found = T.scores(docs, model).collect()
    assert len(found) == 106
    assert all(0 <= r.score <= 1 and (r.score >= T.THRESHOLD) == bool(r.predicted) for r in found)
    assert {r.predicted for r in found if r.doc_id is None} == {1}
    assert {r.predicted for r in found if r.doc_id in (900, 901)} == {0}
    kept = T.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.predicted for r in found)


def test_missing_classes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        assert all(r.score < 1e-9 for r in T.scores(docs, T.train(docs, given)).collect())
    assert T.without_toxic(docs.limit(0), labels).count() == 0


def test_long_texts_are_drawn_whole(spark):
    rows = [(k, f"{text} {'word1 word2 ' * 1700}{text}" if k % 4 else text, toxic) for k, text, toxic in corpus(120)]
    rows = [(k, text * 2 if toxic and not k % 4 and len(text) < 20_000 else text, toxic) for k, text, toxic in rows]
    rows = [(k, f"{text} {'word3 ' * 3400}" if toxic else text, toxic) for k, text, toxic in rows]
    assert all(len(text) > 20_000 for _, text, toxic in rows if toxic)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = T.train(docs, labels)
    found = {r.doc_id: r.predicted for r in T.scores(docs, model).collect()}
    assert sum(found[k] != toxic for k, _, toxic in rows) <= 2
    # Few long texts reach the budget, but none is cut or left out for its length.
    assert T.train(docs, labels, sample_chars=60_000).weights
    # A class without a shorter text gives its first one, whatever its length.
    assert T.train(docs, labels, sample_chars=10_000).weights


def test_texts_labelled_both_ways(spark):
    """They teach nothing; what is left of the classes decides."""
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, toxic int")
    for texts in (["same words"] * 8, [""] * 8, [None] * 8):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert [r.predicted for r in T.scores(docs, T.train(docs, labels)).collect()] == [0] * 8
    mixed = spark.createDataFrame(list(enumerate(["same"] * 6 + ["clean", "vile"])), "doc_id long, text string")
    assert {r.doc_id for r in T.scores(mixed, T.train(mixed, labels)).collect()} == set(range(8))
