"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark: 13 consecutive words of an item, or
the whole item if it has fewer. Windows are searched for by length. The search
looks at blocks of two words: a shift table tells how far the text can be skipped
before the block could end a window; where it says zero, the bucket of that
block, split by the window's first block, selects windows to compare with the
text word by word.

Items are taken in groups of bounded size, and each group is searched for in all
documents: what is shipped to tasks is bounded however large the benchmark is.
Groups' hits are put together by word positions.

Cases: a null text has no words; a document without words is never contaminated.
An item without words has no windows. Items with a null item_id mark words, but
have no id to list. Repeated items and rows of one item_id count once. Rows of
documents that share a doc_id are judged one by one. Other columns are handed
through by ``decontaminated`` and ignored otherwise.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import by_batch, free_name, join_measured, stored, utf8

WINDOW = 13
# A document is contaminated if at least one word in SHARE lies in a window.
SHARE = 20
# Benchmark text that is searched for at once.
GROUP_BYTES = 4 * 2**20

# A-Z to a-z; other ASCII than letters and digits to spaces; all else as it is.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORDS).split()


class WuManber:
    """Windows of one length, with the items they come from."""

    def __init__(self, length: int, windows: dict[tuple, set]):
        self.length = length
        self.block = min(2, length)
        self.windows = windows
        self.most = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for window in windows:
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.most), length - end)
            self.buckets[window[-self.block :]][window[: self.block]].append(window)
        self.buckets = {suffix: dict(prefixes) for suffix, prefixes in self.buckets.items()}

    def search(self, text: list[bytes]) -> list[tuple[int, tuple]]:
        """(start, window) of every occurrence."""
        found = []
        length, block, most, shift = self.length, self.block, self.most, self.shift
        at, end = length, len(text)
        while at <= end:
            suffix = tuple(text[at - block : at])
            skip = shift.get(suffix, most)
            if skip:
                at += skip
                continue
            start = at - length
            for window in self.buckets[suffix].get(tuple(text[start : start + block]), ()):
                if text[start:at] == list(window):
                    found.append((start, window))
            at += 1
        return found


def searchers(items: list[tuple], window: int = WINDOW) -> list[WuManber]:
    """One search for each window length of the given (item_id, text bytes)."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            by_length[size][tuple(own[at : at + size])].add(item)
    return [WuManber(size, dict(found)) for size, found in sorted(by_length.items())]


def _item_groups(benchmark: DataFrame, group_bytes: int) -> DataFrame:
    """item_id, text, and a number such that the texts of a number have about group_bytes at most."""
    texts = benchmark.filter("text IS NOT NULL").select("item_id", "text")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_bytes))
    return texts.withColumn("number", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))), groups


def _positions(docs: DataFrame, items: list[tuple], window: int, key: str) -> DataFrame:
    """For one group of items: key, n_words, the hit words' positions, and the items found."""
    search = searchers(items, window)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        counts, hits, found = [], [], []
        for text in utf8(rows.column(1)):
            own = words(text)
            hit, names = set(), set()
            for one in search:
                for start, win in one.search(own):
                    hit.update(range(start, start + one.length))
                    names |= one.windows[win]
            counts.append(len(own))
            hits.append(sorted(hit))
            found.append(sorted(str(n) for n in names if n is not None))
        columns = [
            rows.column(0), pa.array(counts, pa.int64()),
            pa.array(hits, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, [key, "n_words", "hits", "items"])

    return by_batch(docs.select(key, "text"), batch, f"{key} long, n_words long, hits array<int>, items array<string>")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (ids as sorted strings), contaminated."""
    grouped, groups = _item_groups(benchmark, group_bytes)

    def items(number: int) -> list[tuple]:
        rows = grouped.filter(F.col("number") == number).toLocalIterator()
        return [(row.item_id, row.text.encode()) for row in rows]

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if groups == 1:
        found = _positions(narrow, items(0), window, "doc_id")
    else:
        # Rows get numbers in a stored copy, so each group finds the same row under the same number.
        rows = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
        parts = None
        for number in range(groups):
            part = stored(_positions(rows, items(number), window, "row"), "decontaminate-hits")
            parts = part if parts is None else parts.unionByName(part)
        merged = parts.groupBy("row").agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = rows.select("row", "doc_id").join(merged, "row")
    hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), "items",
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    With one group of items the rows are judged where they are read. Otherwise they get
    numbers in a stored copy, and each row is judged under its own.
    """
    grouped, groups = _item_groups(benchmark, group_bytes)
    if groups > 1:
        number = free_name("number", docs)
        rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "decontaminate-numbered")
        judged = contamination(rows.select(F.col(number).alias("doc_id"), "text"), benchmark, window, share, group_bytes)
        bad = stored(judged.filter("contaminated").select(F.col("doc_id").alias(number)), "decontaminate-bad")
        return join_measured(rows, bad, number, "left_anti", row_bytes=16).drop(number)
    search = searchers([(r.item_id, r.text.encode()) for r in grouped.toLocalIterator()], window)
    at = docs.columns.index("text")

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for text in utf8(rows.column(at)):
            own = words(text)
            hit = set()
            for one in search:
                for start, _ in one.search(own):
                    hit.update(range(start, start + one.length))
            keep.append(not hit or share * len(hit) < len(own))
        return rows.filter(pa.array(keep, pa.bool_()))

    return by_batch(docs, batch, docs.schema)
