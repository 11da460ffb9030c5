import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest

from eventmart.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, domain string"


def fill(budget, children):
    """Water filling by steps: (name, weight, capacity) to amounts."""
    given, open_, left = {}, dict((n, (w, c)) for n, w, c in children), budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if Fraction(c, w) <= Fraction(left, total)]
        if not full:
            given |= {n: left * w // total for n, (w, _) in open_.items()}
            break
        least = min(full, key=lambda n: Fraction(open_[n][1], open_[n][0]))
        given[least] = open_[least][1]
        left -= open_.pop(least)[1]
    return given


def brute(rows, weights, share, epochs, seed):
    leaf = defaultdict(list)
    for row in rows:
        doc_id, text, lang, source, domain = row
        leaf[(domain or "", lang or "", source or "")].append((doc_id, len((text or "").split()), row))
    tokens = {k: sum(t for _, t, _ in v) for k, v in leaf.items()}
    weight = lambda level, name: weights.get(level, {}).get(name, 1)
    total = sum(tokens.values())
    budgets = {(): min(total * share[0] // share[1], total * epochs)}
    for depth, level in enumerate(M.TREE):
        for parent in {k[:depth] for k in leaf}:
            names = {k[depth] for k in leaf if k[:depth] == parent}
            size = {n: epochs * sum(t for k, t in tokens.items() if k[: depth + 1] == (*parent, n)) for n in names}
            given = fill(budgets[parent], [(n, weight(level, n), size[n]) for n in names])
            budgets |= {(*parent, n): g for n, g in given.items()}
    out = []
    for key, own in leaf.items():
        whole, rest = divmod(budgets[key], tokens[key]) if tokens[key] else (0, 0)
        hashed = []
        for i, t, row in own:
            content = hashlib.md5((row[1] or "").encode()).hexdigest()
            hashed.append((hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}:{content}".encode()).hexdigest(), t, row))
        for h, _, row in hashed:
            before = sum(t for g, t, _ in hashed if g < h)
            times = whole + (1 if before < rest else 0)
            out += [(*row, k) for k in range(times)]
    return out, budgets


def rows():
    out = []
    for k in range(400):
        lang, source = ["en", "en", "de", None][k % 4], f"s{k % 7 if k % 3 else 0}"
        out.append((k, "tok " * (k * 7 % 23), lang, source, f"d{k % 7 % 3}"))
    return [*out, (None, "a b c", None, None, None), (7, "a b", "en", "s0", "d0"), (7, "a b", "en", "s0", "d0"), (401, None, "zz", "s9", "d0"), (402, "", "zz", "s9", "d0")]


@pytest.mark.parametrize("share", [(1, 2), (1, 10), (3, 2), (5, 1)])
def test_equals_brute_force(spark, share):
    given = spark.createDataFrame(rows(), SCHEMA)
    weights = {"domain": {"d0": 9, "d1": 1}, "language": {"en": 5}, "source": {"s0": 3}}
    found = M.mix(given, weights, share, 2, 11).collect()
    expected, _ = brute(rows(), weights, share, 2, 11)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_shortage_goes_to_siblings_first(spark):
    data = [(k, "t " * 10, "en", s, d) for k, (s, d) in enumerate([("a", "x")] + [("b", "x")] * 10 + [("c", "y")] * 20)]
    plan = M.plan(spark.createDataFrame(data, SCHEMA), {"source": {"a": 9}}, (1, 3), 1, 1)
    given = {r.source: r.given for r in plan.collect()}
    assert given == {"a": 10, "b": 41, "c": 51}  # x keeps its half: what a lacks goes to b


def test_leaves_of_one_document_are_not_empty(spark):
    given = spark.createDataFrame([(k, "t " * 50, "en", f"s{k}", "d") for k in range(3)], SCHEMA)
    assert sorted(r.source for r in M.mix(given, {}, (1, 2), 2, 1).collect()) == ["s0", "s1", "s2"]


def test_rows_without_an_id_are_taken_one_by_one(spark):
    given = spark.createDataFrame([(None if k % 3 else k, f"t{k} " * 4, "en", "s", "d") for k in range(900)], SCHEMA)
    found = M.mix(given, {}, (1, 2), 2, 1).collect()
    assert len(found) == 450 and 250 < sum(r.doc_id is None for r in found) < 350


def test_ends_by_buckets_equal_ends_by_documents(spark, monkeypatch):
    given = spark.createDataFrame(rows(), SCHEMA)
    wide = M.mix(given).collect()
    monkeypatch.setattr(M, "BUCKET_DIGITS", 1)
    assert sorted(map(repr, wide)) == sorted(map(repr, M.mix(given).collect()))


def test_odd_tables(spark):
    given = spark.createDataFrame(rows(), SCHEMA)
    assert M.mix(given.limit(0)).count() == 0
    clash = given.withColumnRenamed("domain", "epoch").selectExpr("*", "1 AS tokens", "2 AS budget", "3 AS `a.b`", "4 AS row")
    found = M.mix(clash)
    assert found.columns == ["doc_id", "text", "lang", "source", "tokens", "budget", "a.b", "row", "epoch"]
    assert found.count() > 0
    with pytest.raises(ValueError):
        M.mix(given, {"source": {"a": 0}})
