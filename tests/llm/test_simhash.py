import random
import re

import numpy as np
import pytest
import xxhash

from eventmart.llm import components as K
from eventmart.llm import simhash as S


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius):
    """Smallest id reachable, by comparing all pairs."""
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                group[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return [(doc_id, fp, least.get(root(k))) for k, (doc_id, fp) in enumerate(rows)]


def near_texts():
    random.seed(8)
    base = [" ".join(random.choices([f"v{k}" for k in range(300)], k=150)) for _ in range(12)]
    out = list(base)
    for text in base:
        words = text.split()
        for _ in range(8):
            words[random.randrange(150)] = "edit"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("radius,tile", [(4, 65_536), (10, 7), (4, 3)])
def test_equals_brute_force(spark, docs, prose, radius, tile):
    rows = list(enumerate(prose + near_texts())) + [(3, prose[3]), (3, "other"), (None, prose[5]), (None, "nobody else says so")]
    found = S.near_duplicates(docs(*rows, extra=("fp", "root")), radius, tile).collect()
    expected = brute_components([(i, brute_print(t)) for i, t in rows], radius)
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert len({c for *_, c in got}) < len(rows) - 60


def test_one_row_of_each_group_stays(spark, docs, prose):
    rows = list(enumerate(prose + near_texts())) + [(3, prose[3]), (3, "other"), (None, prose[5]), (3, "one more of other words")]
    rows += [(None, "nobody else says so"), (None, "nobody else says so"), (None, "nobody  ELSE says so"), (400, "nobody says that")]
    given = docs(*rows, extra=("fp", "row", "stays"))
    found = S.without_near_duplicates(given, tile_rows=7)
    assert found.columns == given.columns
    # As rows of their own, in the order in which they should stay.
    ordered = sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0]))
    groups = brute_components([(k, brute_print(t)) for k, (_, (_, t)) in enumerate(ordered)], 4)
    expected = [ordered[k][1] for k, _, least in groups if k == least]
    assert sorted(repr((r.doc_id, r.text)) for r in found.collect()) == sorted(map(repr, expected))
    assert sum(i == 3 for i, _ in expected) == 3 and sum(i is None for i, _ in expected) == 1
    assert S.without_near_duplicates(given.limit(0)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(100, 163)] + [(200, k) for k in range(150 + 51, 260)]
    edges += [(300 + k, 300 + (k + 1) % 9) for k in range(9)] + [(5, 5), (400, 399), (399, 400)]
    random.seed(3)
    random.shuffle(edges)
    found = {r.node: r.root for r in K.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: 100 for k in range(100, 164)} | {k: 200 for k in range(200, 260)} | {k: 300 for k in range(300, 309)}
    assert found == expected | {399: 399, 400: 399}



def test_fingerprints(spark):
    for text in [None, "", " \t", "One", "a b c", "a b c d", "A  b\vC d e", "é É ß " * 50, "x y " * 9000, *near_texts()[:5]]:
        assert S.fingerprint(text.encode() if text is not None else None) == brute_print(text)


def test_forest_connects_what_is_linked():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 8, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(200)], np.uint64)
    prints = np.unique(np.concatenate([seeds, rng.choice(seeds, 200) ^ flips, rng.integers(0, 2**63, 200, dtype=np.uint64)]))
    rng.shuffle(prints)
    left, right = prints[:150], prints[150:]
    for a, b in ((prints, None), (left, right)):
        x, y = S.forest(a, b)
        pairs = [(int(p), int(q)) for p in a for q in (a if b is None else b) if (int(p) ^ int(q)).bit_count() <= 4 and p != q]
        group = {int(p): int(p) for p in prints}

        def root(k):
            while group[k] != k:
                k = group[k]
            return k

        for p, q in zip(x.tolist(), y.tolist()):
            assert root(p) != root(q)  # a forest
            group[root(p)] = root(q)
        assert all(root(p) == root(q) for p, q in pairs)


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(-40, 100)] + [(500 + k, 500) for k in range(1, 50)] + [(900, 901), (901, 900), (950, 950)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in K.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == -40 for k in range(-40, 101)) and all(found[k] == 500 for k in range(500, 550)) and found[901] == 900


def test_empty_table(spark, docs):
    assert S.near_duplicates(docs("a").limit(0)).count() == 0
