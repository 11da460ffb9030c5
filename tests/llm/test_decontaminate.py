import random
import re

import pytest

from eventmart.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, size=13):
    """Every window against every position."""
    windows = []
    for item, text in items:
        own = WORD.findall(lowered(text))
        n = min(size, len(own))
        windows += [(item, own[i : i + n]) for i in range(len(own) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        own = WORD.findall(lowered(text))
        hit, names = set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add(item)
        names = sorted(str(n) for n in names if n is not None)
        out.append((doc_id, len(own), len(hit), names, bool(hit) and 20 * len(hit) >= len(own)))
    return out


def tables():
    random.seed(3)
    words = ["Alpha", "beta", "été", "x1", "GAMMA", "o"]
    items = [(k, " ".join(random.choices(words, k=n))) for k, n in enumerate([20, 13, 14, 5, 1, 0, 40, 2])]
    items += [(3, "again beta beta beta"), (None, "nobody lists this"), (9, None), (10, items[0][1]), (11, "İstanbul")]
    docs = []
    for k in range(60):
        text = " ".join(random.choices(words, k=random.randint(0, 60)))
        if k % 4 == 0:
            text += " - " + items[k % len(items)][1] + "!" if items[k % len(items)][1] else ""
        docs.append((k, text))
    docs += [(60, None), (61, ""), (62, "..."), (5, "rows share an id x1"), (None, "nobody lists THIS"), (64, "q " * 50_000 + items[0][1])]
    return docs, items


@pytest.mark.parametrize("group_bytes", [2**20, 100])
def test_equals_brute_force(spark, group_bytes):
    docs, items = tables()
    given = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.contamination(given, benchmark, group_bytes=group_bytes).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(docs, items)))


@pytest.mark.parametrize("group_bytes", [2**20, 100])
def test_contaminated_rows_go_and_columns_stay(spark, group_bytes):
    docs, items = tables()
    bad = [not row[4] for row in brute(docs, items)]
    given = spark.createDataFrame([(*d, "e", "n", "t") for d in docs], "doc_id long, text string, n_words string, number string, __text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = D.decontaminated(given, benchmark, group_bytes=group_bytes)
    assert kept.columns == given.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr((*d, "e", "n", "t")) for d, keep in zip(docs, bad) if keep)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(docs.limit(0), items).count() == 0
    assert D.contamination(docs, items.limit(0)).first()[1:] == (2, 0, [], False)
    assert D.decontaminated(docs, items.limit(0)).count() == 1


def test_search_skips_and_finds_overlaps():
    one = D.WuManber(3, {(b"a", b"a", b"a"): {1}, (b"b", b"a", b"a"): {2}})
    assert [at for at, _ in one.search(b"b a a a a c".split())] == [0, 1, 2]
    assert one.shift[(b"b", b"a")] == 1 and one.most == 2
