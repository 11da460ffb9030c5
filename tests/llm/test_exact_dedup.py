import re

from pyspark.sql import functions as F

from eventmart.llm import exact_dedup as E


def brute(rows):
    """One row for each input row, by comparing whole normalised texts."""
    groups = {}
    for k, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", text or ""), []).append((doc_id, len(text or ""), k))
    out = []
    for own in groups.values():
        best = min(own, key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))
        out += [(r[0], best[0], len(own), r is best) for r in own]
    return out


def test_equals_brute_force(spark, docs, prose):
    rows = list(enumerate(prose)) + [(5, prose[5]), (5, prose[5]), (None, prose[7]), (None, "alone"), (None, None), (700, "A b"), (701, "a b")]
    found = E.exact_duplicates(docs(*rows, extra=("norm", "size", "kept"))).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows)))


def test_same_length_and_prefix_is_not_enough(spark, docs):
    found = E.exact_duplicates(docs("x" * 100 + "a", "x" * 100 + "b", "y" * 101), chars_left=F.length("norm")).collect()
    assert [(r.group_size, r.kept, r.chars_left) for r in found] == [(1, True, 101)] * 3


def test_only_shared_lengths_and_prefixes_are_hashed(spark, docs):
    start = "x" * 100
    given = docs("abc", "a b c", "abd", "abcde", start + "a", start + "b", "y" * 101, "z" * 50)
    assert sorted(r.size for r in E.shared_lengths(given).collect()) == [3, 101]
    lengths = E._bitmap(E.shared_lengths(given))
    assert sorted(r.size for r in E.shared_prefixes(given, lengths).collect()) == [3, 101]
    found = E.hashed(given).orderBy("doc_id").collect()
    assert [r.prefix is not None for r in found] == [True, True, True, False, True, True, True, False]
    assert [r.full is not None for r in found] == [True, True, False, False, True, True, False, False]


def test_empty_table(spark, docs):
    assert E.exact_duplicates(docs("a").limit(0)).count() == 0
