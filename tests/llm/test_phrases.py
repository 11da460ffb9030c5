import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import phrases as P

SCHEMA = "doc_id long, lang string, text string, n long, phrase string, hash string"


def brute(rows, order=5, least=100, top=2000):
    totals, f = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und" if lang is None else lang, text or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, order + 1) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in f.items() if n >= least and len(key[1]) > 1}
    out = {}
    for (lang, words), a in frequent.items():
        if any(
            l == lang and len(w) > len(words) and n >= a and any(w[i : i + len(words)] == words for i in range(len(w)))
            for (l, w), n in frequent.items()
        ):
            continue
        cuts = [(1000 * a * totals[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        phrase = " ".join(words)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), (phrase, a, f[lang, words[:k]], f[lang, words[k:]], totals[lang], score)))
    return sorted((lang, n, *row[3]) for lang, own in out.items() for n, row in enumerate(sorted(own)[:top], 1))


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(25)] + ["Été", "NAÏVE", "ß", "a'b", "x\x00y", " "]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for k in range(150):
        words = []
        for _ in range(rng.randint(1, 60)):
            words += ["New", "york", "city", "hall"][: rng.randint(1, 4)] if rng.random() < 0.1 else rng.choices(vocabulary, weights)
            if rng.random() < 0.1:
                words[-1] += rng.choice([".", ",", "; ", "\n", "\r", "\v", "\f", "!?", ":"])
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(words)))
    return rows + [("en", None), ("en", ""), (None, " . \t"), ("fr", "alone"), ("", "same words same words")] + rows[:30]


def found(spark, rows, **settings):
    frame = spark.createDataFrame([(k, lang, text, 1, "p", "h") for k, (lang, text) in enumerate(rows)], SCHEMA)
    out = P.collocations(frame, **settings)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("least,top,bits", [(12, 2000, 27), (5, 6, 7)])
def test_equals_brute_force(spark, least, top, bits):
    """With few bits nearly all pairs count as frequent, with the same result."""
    rows = corpus()
    expected = brute(rows, least=least, top=top)
    assert found(spark, rows, least=least, top=top, bits=bits) == expected and len(expected) > 15


def test_a_passage_in_a_third_of_all_rows(spark):
    rows = [("en", "one two three four five six seven")] * 120 + corpus()
    expected = brute(rows, least=100)
    assert found(spark, rows) == expected
    # Whatever is shorter occurs as often as the five words around it.
    assert {"one two three four five", "three four five six seven"} <= {r[2] for r in expected}


def test_overlaps_and_one_very_long_text(spark):
    rows = [("en", "ha " * 30_000), ("en", "x" * 200_000 + " ha ha")]
    assert found(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert found(spark, []) == [] and found(spark, [("en", None)]) == []


def test_only_longest_windows_are_counted(spark):
    """Every place begins one window, cut at pieces and at rare pairs."""
    tokens = P.Tokens("en", [b"a b c d e f. a b", b"a b"])
    every = np.full(2, 2**64 - 1, np.uint64)
    windows, counts = tokens.windows(every, 5)
    named = {tuple(tokens.names[i].decode() for i in row if i): int(n) for row, n in zip(windows, counts)}
    assert named == {
        tuple("abcde"): 1, tuple("bcdef"): 1, tuple("cdef"): 1, tuple("def"): 1, tuple("ef"): 1, ("f",): 1, tuple("ab"): 2, ("b",): 2,
    }
    windows, counts = tokens.windows(np.zeros(2, np.uint64), 5)
    assert {(int((row > 0).sum()), int(n)) for row, n in zip(windows, counts)} == {(1, 3), (1, 1)}


def test_texts_of_several_batches_are_counted_together():
    """By language, until there are enough of one, or of all together; no text is lost."""
    batch = pa.record_batch({"lang": ["en", "de", "en", "und"], "text": ["a b", "a b", None, "c. a b"]})
    found = list(P._tokens(iter([batch] * 50)))
    assert sorted((lang, int((~tokens.stop).sum())) for lang, tokens in found) == [("de", 100), ("en", 100), ("und", 150)]


def test_held_texts_are_bounded_whatever_their_languages(monkeypatch):
    monkeypatch.setattr(P, "BATCH_BYTES", 40)
    monkeypatch.setattr(P, "HELD_BYTES", 60)
    batch = pa.record_batch({"lang": [f"l{k % 7}" for k in range(90)], "text": ["a b c"] * 89 + ["x " * 500]})
    found = list(P._tokens(iter([batch, batch])))
    assert sum(int((~tokens.stop).sum()) for _, tokens in found) == 2 * (89 * 3 + 500) and len(found) > 20


def test_pairs_are_sent_as_arrays_and_added_up(spark, monkeypatch):
    """Tasks send their counts in pieces, a row for each part and not for each pair; the sum over pieces and tasks decides."""
    monkeypatch.setattr(P, "PAIRS", 50)
    monkeypatch.setattr(P, "BATCH_BYTES", 60)
    rows = corpus()
    expected = brute(rows, least=12)
    assert found(spark, rows, least=12) == expected and expected
    hashes = np.arange(1, 2 * P.PARTS, dtype=np.uint64) << np.uint64(31)
    sent = P._counted_pairs([hashes, hashes, hashes[:5]], 3)
    assert sent.num_rows == P.PARTS and sum(len(p.as_py()) for p in sent.column(1)) == 4 * len(hashes)
    counts = np.concatenate([np.frombuffer(p.as_py(), np.uint32) for p in sent.column(2)])
    assert (counts == 3).sum() == 5 and counts.sum() == 2 * len(hashes) + 5
    both = np.array([1, 5, 9], np.uint32).tobytes(), np.array([2, 1, 2], np.uint32).tobytes()
    other = np.array([5, 9], np.uint32).tobytes(), np.array([1, 1], np.uint32).tobytes()
    assert P._frequent([both, other], 3).tolist() == [9]
