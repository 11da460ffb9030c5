"""Token counts of a unigram segmentation, by dynamic programming over a trie of pre-tokens.

A text is split into pre-tokens by the tokenizer's pattern. Of the ways to cut a
pre-token into pieces of the vocabulary, the one with the highest total score
counts; the score of a piece follows from its rank, as log-probabilities under
Zipf's law: -log(rank + 1) - log(H), H the sum of 1/(rank + 1). Of equally good
ways the one with fewer pieces counts.

In each task the distinct pre-tokens are inserted into a trie of bytes. The best
score of a prefix depends on the prefix alone, so it is computed once at its node
and shared by all pre-tokens that begin with it; the number of pieces at a
terminal node is the pre-token's count. A trie that outgrows MAX_NODES is begun
anew, and a pre-token of more than LONG bytes gets no nodes: the same recurrence
runs over a window as long as the longest piece. Both bound a task's memory and
change no result. Nothing is shuffled.

Every byte is a piece, so every text can be cut. Cases: a null or empty text has
no tokens. Rows are returned as often as given, with a null doc_id too. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import math
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import by_batch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_NODES = 300_000
LONG = 256


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Piece to score, from lines of base64 piece and rank."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    total = math.log(sum(1 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class Trie:
    """Nodes of inserted pre-tokens: children by byte, best score and its number of pieces."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.scores = scores
        self.longest = max(map(len, scores))
        # Lengths of the pieces of three bytes and more by their last three, shortest first.
        lengths: dict[bytes, set[int]] = {}
        for piece in scores:
            if len(piece) > 2:
                lengths.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths = {tail: sorted(found) for tail, found in lengths.items()}
        self.max_nodes = max_nodes
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[int, int]] = [{}]
        self.best: list[float] = [0.0]
        self.pieces: list[int] = [0]
        self.terminal: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        """Pieces of a pre-token; walks to its node and computes the nodes that are new."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(word) > LONG:
            return self._count_long(word)
        if len(self.best) + len(word) > self.max_nodes:
            self.clear()
        children, best, pieces, scores = self.children, self.best, self.pieces, self.scores
        path, node = [0], 0
        for end, byte in enumerate(word, 1):
            child = children[node].get(byte)
            if child is None:
                score, count = -math.inf, 0
                for start in self.starts(word, end):
                    piece = scores.get(word[start:end])
                    if piece is not None:
                        total = best[path[start]] + piece
                        number = pieces[path[start]] + 1
                        if total > score or (total == score and number < count):
                            score, count = total, number
                child = len(best)
                children[node][byte] = child
                children.append({})
                best.append(score)
                pieces.append(count)
            node = child
            path.append(node)
        self.terminal[word] = pieces[node]
        return pieces[node]

    def starts(self, word: bytes, end: int) -> list[int]:
        """Where a piece that ends at ``end`` can begin."""
        found = [end - 1, end - 2] if end > 1 else [0]
        for length in self.lengths.get(word[end - 3 : end], ()) if end > 2 else ():
            if length > end:
                break
            found.append(end - length)
        return found

    def _count_long(self, word: bytes) -> int:
        """Pieces of a pre-token that is too long for the trie; keeps as many positions as the longest piece has bytes."""
        scores, longest = self.scores, self.longest
        best, pieces = [0.0] * longest, [0] * longest  # of position p at p modulo their length
        for end in range(1, len(word) + 1):
            score, count = -math.inf, 0
            for start in self.starts(word, end):
                piece = scores.get(word[start:end])
                if piece is not None:
                    total = best[start % longest] + piece
                    number = pieces[start % longest] + 1
                    if total > score or (total == score and number < count):
                        score, count = total, number
            best[end % longest], pieces[end % longest] = score, count
        return pieces[len(word) % longest]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, max_nodes: int = MAX_NODES) -> DataFrame:
    """Per document row: doc_id, n_pretokens, n_tokens."""
    spark = docs.sparkSession
    scores = spark.sparkContext.broadcast(read_vocabulary(vocabulary))  # 50,000 pieces
    split = regex.compile(PATTERN)
    state: dict = {}

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        if "trie" not in state:
            state["trie"] = Trie(scores.value, max_nodes)
        trie = state["trie"]
        found = [Counter(split.findall(text or "")) for text in rows.column(1).to_pylist()]
        # Distinct pre-tokens first: each enters the trie once, whatever the number of texts it is in.
        counts = {word: trie.count(word.encode()) for word in set().union(*found)}
        tokens = [sum(counts[word] * n for word, n in own.items()) for own in found]
        columns = [rows.column(0), pa.array([own.total() for own in found], pa.int64()), pa.array(tokens, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pretokens", "n_tokens"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(narrow, batch, "doc_id long, n_pretokens long, n_tokens long")
