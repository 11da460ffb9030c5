import math
import random
import re

from eventmart.llm import token_counts as C


def brute(word, scores):
    """Fewest pieces of the best way to cut, by recursion over the whole word."""
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        ways = [
            (best[s][0] + scores[word[s:end]], -(best[s][1] + 1)) for s in range(end) if word[s:end] in scores
        ]
        top = max(ways)
        best[end] = (top[0], -top[1])
    return best[len(word)][1]


def small_scores():
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"ca", b"abcab", b" a", b" ab"]
    return {p: -math.log(k + 2) for k, p in enumerate(reversed(pieces))}


def test_trie_equals_brute_force():
    random.seed(2)
    scores = small_scores()
    words = ["".join(random.choices("abc ", k=random.randint(1, 14))).encode() for _ in range(400)]
    for nodes in (10**6, 40):
        trie = C.Trie(scores, nodes)
        assert [trie.count(w) for w in words] == [brute(w, scores) for w in words]


def test_long_words_need_no_nodes(monkeypatch):
    random.seed(3)
    monkeypatch.setattr(C, "LONG", 6)
    scores = small_scores()
    words = ["".join(random.choices("abc ", k=random.randint(1, 60))).encode() for _ in range(200)]
    trie = C.Trie(scores)
    assert [trie.count(w) for w in words] == [brute(w, scores) for w in words]
    assert max(map(len, trie.terminal)) <= 6


def test_prefixes_are_computed_once():
    trie = C.Trie(small_scores())
    trie.count(b"abcabc")
    nodes = len(trie.best)
    trie.count(b"abcab")
    assert len(trie.best) == nodes
    trie.count(b"abcaba")
    assert len(trie.best) == nodes + 1


def test_documents(spark, docs, prose):
    scores = C.read_vocabulary()
    texts = [t for t in prose if t != "long " * 40_000] + ["日本語 text  '' 's 12", "a" * 30_000]
    found = C.token_counts(docs(*texts, extra=("n_tokens",))).collect()
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for r in random.Random(1).sample(found, 20) + found[-8:-1]:
        parts = C.regex.findall(C.PATTERN, texts[r.doc_id] or "")
        assert "".join(parts) == (texts[r.doc_id] or "")
        assert (r.n_pretokens, r.n_tokens) == (len(parts), sum(brute(p.encode(), scores) for p in parts))


def test_odd_tables(spark, docs):
    assert C.token_counts(docs("a").limit(0)).count() == 0
    found = C.token_counts(docs((None, "a b"), (3, None), (3, ""), (3, ""))).collect()
    assert [tuple(r) for r in found] == [(None, 2, 2), (3, 0, 0), (3, 0, 0), (3, 0, 0)]
    assert re.match("^/", C.VOCABULARY)
