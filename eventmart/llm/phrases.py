"""Phrase collocations by top-order marginalisation.

A window is a word with the ORDER - 1 that lead it in the same piece, filled up with
nulls where the piece ends. Only these longest windows are counted. What a shorter
phrase occurs is the sum over the windows that begin with it, so ROLLUP over the
window's columns sums ever shorter prefixes, down to the words of a language; no
n-gram of another length is ever written out.

Most windows of a corpus are unique, and a candidate can't hold two adjacent words that are
together fewer than LEAST times. So pairs are counted first, by a hash of language and
both words, and a window also ends before a pair whose hash is too rare. That is
exact: a hash is never rarer than its pairs, and every pair inside a candidate, or
inside a part of it, is as frequent as the candidate at least. The hashes that are
frequent enough travel as a bitmap of 2^BITS bits, whatever their number; where two
share a bit, some windows are longer than need be, with the same result. Each task counts
many texts' hashes together, cuts them into PARTS by their upper bits and sends each part
as one sorted array of the lower ones, in pieces; whoever has a part adds the arrays up.

A phrase is scored at each of its cuts by 1000 * a * n / (l * r), in decimals of 38
digits and rounded down; a and n up to 2^63 / 1000 and l, r up to 2^63 keep that exact. The lowest
score counts. A candidate goes where a longer one that holds it occurs as often
(COVER percent as often).

Cases: a null or empty text has no words; a null language is ``und``, one with that
name. Rows that repeat count as often. Very long texts are taken whole: memory is that
of HELD_BYTES of texts, or of one that is longer. Ties of the score go to the
more frequent, then to the first in the byte order of UTF-8. Empty tables give no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import by_partition, join_measured, stored, utf8

ORDER = 5
LEAST = 100
TOP = 2000
COVER = 100
UNKNOWN = "und"
BITS = 27
# Texts of a language are counted together until they have this many bytes, and the longest
# are counted once those of all languages have HELD_BYTES.
BATCH_BYTES = 4 * 2**20
HELD_BYTES = 16 * 2**20
# Hashes of pairs that a task holds before it sends what it has counted, and parts they are cut into.
PAIRS = 4 * 2**20
PARTS = 1024

STOP = b"."
# Lower case, tabs as spaces, and one mark for all that ends a piece.
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 9 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)
)


def _words(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of all texts, with STOP before, between and after pieces; STOP is the first of the dictionary."""
    joined = STOP.join(t.translate(BYTES) for t in texts).replace(STOP, b" . ")
    # No byte but a space is left that Python splits at.
    return pa.array([STOP, *joined.split()], pa.large_binary()).dictionary_encode()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number depends on every other."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _spread(x: np.ndarray) -> np.ndarray:
    return _mixed(_mixed((x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))


# A number for each byte.
OF_BYTE = _spread(np.arange(256))


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each of some words, none of which is empty."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    sizes, starts = np.diff(ends), ends[:-1] - ends[0]
    place = np.arange(len(letters)) - np.repeat(starts, sizes)
    factor = _spread(np.arange(sizes.max())) | np.uint64(1)
    return _mixed(np.add.reduceat(OF_BYTE[letters] * factor[place], starts))


def _numbered(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal values as equal numbers from 0 up, and how many there are."""
    encoded = pa.array(values).dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary)


class Tokens:
    """The words of some texts of one language as numbers; ``stop`` marks where no window passes."""

    def __init__(self, lang: str, texts: list[bytes]):
        words = _words(texts)
        self.ids = words.indices.to_numpy()[1:].astype(np.int64)
        self.words = words.dictionary  # STOP has number 0
        self.stop = self.ids == 0
        hashes = _hashes(self.words)
        self.before = _mixed(hashes + np.uint64(xxhash.xxh64_intdigest(lang)))
        self.after = hashes

    @property
    def names(self) -> list[bytes]:
        return self.words.to_pylist()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each place, whether it begins a pair, and the pair's hash."""
        inner = ~(self.stop | np.append(self.stop[1:], True)[: len(self.ids)])
        following = np.append(self.ids[1:], self.ids[:1])
        with np.errstate(over="ignore"):
            return inner, _mixed(self.before[self.ids] * np.uint64(0x9E3779B97F4A7C15) + self.after[following])

    def windows(self, frequent: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows as rows of word numbers, 0 where there is none, and their counts."""
        inner, hashes = self.pairs()
        bit = hashes & np.uint64(len(frequent) * 64 - 1)
        goes_on = inner & ((frequent[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0)
        rows, counts = [], []
        # Windows of a length are numbered by their words; those that go on are numbered again with the next word.
        at = np.flatnonzero(~self.stop)
        code, size = self.ids[at], len(self.words)
        for length in range(1, order + 1):
            on = goes_on[at + length - 1] if length < order else np.zeros(len(at), bool)
            first = np.zeros(size, np.int64)
            first[code[~on]] = at[~on]
            n = np.bincount(code[~on], minlength=size)
            ended = np.flatnonzero(n)
            row = np.zeros((len(ended), order), np.int64)
            row[:, :length] = self.ids[first[ended][:, None] + np.arange(length)]
            rows.append(row)
            counts.append(n[ended])
            at, code = at[on], code[on]
            if length < order:
                code, size = _numbered(code * len(self.words) + self.ids[at + length])
        return np.concatenate(rows), np.concatenate(counts)


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Tokens]]:
    """The words by language, of texts with BATCH_BYTES together, or one that is longer."""
    by_lang: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            by_lang.setdefault(lang, []).append(text or b"")
            sizes[lang] = sizes.get(lang, 0) + len(text or b"") + 1
            held += len(text or b"") + 1
            if sizes[lang] < BATCH_BYTES and held < HELD_BYTES:
                continue
            full = max(sizes, key=sizes.get)
            held -= sizes.pop(full)
            yield full, Tokens(full, by_lang.pop(full))
    for lang, texts in by_lang.items():
        yield lang, Tokens(lang, texts)


PAIRS_DDL = "part int, hashes binary, counts binary"


def _counted_pairs(found: list[np.ndarray], least: int) -> pa.RecordBatch:
    """Hashes by part, 42 bits of each, with how often they occur; whatever reaches ``least`` counts as that."""
    keys, counts = np.unique(np.concatenate(found) & np.uint64(PARTS * 2**32 - 1), return_counts=True)
    counts = np.minimum(counts, least).astype(np.uint32)
    parts = (keys >> np.uint64(32)).astype(np.int32)
    present, starts = np.unique(parts, return_index=True)
    columns = [[piece.tobytes() for piece in np.split(values, starts[1:])] for values in (keys.astype(np.uint32), counts)]
    arrays = [pa.array(present, pa.int32()), *(pa.array(column, pa.binary()) for column in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "hashes", "counts"])


def _frequent(pieces: list[tuple[bytes, bytes]], least: int) -> np.ndarray:
    """The hashes of a part that occur ``least`` times or more in all of its pieces."""
    low = np.concatenate([np.frombuffer(hashes, np.uint32) for hashes, _ in pieces])
    n = np.concatenate([np.frombuffer(counts, np.uint32) for _, counts in pieces])
    both = np.sort(low.astype(np.uint64) << np.uint64(32) | n)
    low = (both >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    sums = np.add.reduceat(both & np.uint64(2**32 - 1), starts)
    return low[starts][sums >= least]


def frequent_pairs(docs: DataFrame, least: int, bits: int = BITS) -> np.ndarray:
    """Bitmap of the hashes of pairs that occur ``least`` times or more; ``bits`` are 32 at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for _, tokens in _tokens(batches):
            inner, hashes = tokens.pairs()
            found.append(hashes[inner])
            size += len(found[-1])
            if size >= PAIRS:
                yield _counted_pairs(found, least)
                found, size = [], 0
        if size:
            yield _counted_pairs(found, least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces = None, []
        for batch in batches:
            for number, hashes, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if number != part and pieces:
                    yield pa.RecordBatch.from_arrays([pa.array(_frequent(pieces, least), pa.int64())], ["hash"])
                    pieces = []
                part = number
                pieces.append((hashes, counts))
        if pieces:
            yield pa.RecordBatch.from_arrays([pa.array(_frequent(pieces, least), pa.int64())], ["hash"])

    counted = by_partition(docs, count, PAIRS_DDL).repartition("part").sortWithinPartitions("part")
    bit = F.col("hash").bitwiseAND(F.lit(2**bits - 1))
    words = by_partition(counted, add, "hash bigint").select(
        F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("set")
    )
    # At most 2^(bits - 6) rows reach the driver.
    held = words.groupBy("word").agg(F.bit_or("set").alias("set")).toArrow()
    bitmap = np.zeros(2 ** (bits - 6), np.uint64)
    bitmap[held["word"].to_numpy()] = held["set"].to_numpy().view(np.uint64)
    return bitmap


def counted_windows(docs: DataFrame, frequent: np.ndarray, order: int = ORDER) -> DataFrame:
    """lang, w1 to w``order`` and n: how often each longest window occurs."""
    names = [f"w{k}" for k in range(1, order + 1)]
    handle = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens in _tokens(batches):
            windows, n = tokens.windows(handle.value, order)
            words = pc.if_else(pa.array(np.arange(len(tokens.words)) > 0), tokens.words.cast(pa.binary()), None).cast(pa.string())
            columns = [words.take(pa.array(ids)) for ids in windows.T]
            arrays = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), *columns, pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", *names, "n"])

    schema = ", ".join(["lang string", *(f"{name} string" for name in names), "n bigint"])
    return by_partition(docs, count, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """lang, words, f: the phrases of up to ``order`` words that occur ``least`` times; words null for all of a language.

    Level k of the rollup groups by the first k words; the windows that are shorter
    than k are null there and say nothing of phrases of k words.
    """
    names = [f"w{k}" for k in range(1, order + 1)]
    summed = windows.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The grouping number has a one for each column that is summed over.
    complete = reduce(
        Column.__or__, [(F.col("level") == 2 ** (order - k) - 1) & F.col(f"w{k}").isNotNull() for k in range(1, order + 1)]
    )
    total = F.col("level") == 2**order - 1
    words = F.when(~total, F.array_compact(F.array(*names)))
    return summed.filter(total | (complete & (F.col("f") >= least))).select("lang", words.alias("words"), "f")


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    docs: DataFrame, order: int = ORDER, least: int = LEAST, top: int = TOP, cover: int = COVER, bits: int = BITS
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    windows = counted_windows(texts, frequent_pairs(texts, least, bits), order)
    counts = stored(phrase_counts(stored(windows, "phrase-windows"), order, least), "phrase-counts")
    totals = stored(counts.filter("words IS NULL").select("lang", F.col("f").alias("n")), "phrase-totals")
    phrases = counts.filter("words IS NOT NULL").select("lang", "words", _joined(F.col("words")).alias("phrase"), "f")
    candidates = phrases.filter(F.size("words") > 1)

    # Of every phrase inside a longer candidate, how often the longest-lived of these occurs.
    size = F.size("words")
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda at: _joined(F.slice("words", at, n))),
        )
    )
    longer = candidates.filter(size > 2).select("lang", F.explode(inside).alias("phrase"), "f")
    covering = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(covering, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * cover)
    ).drop("longer")

    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = kept.select("lang", "words", "phrase", F.col("f").alias("a"), cut)
    cuts = cuts.withColumns(
        {"first": _joined(F.slice("words", 1, F.col("k"))), "rest": _joined(F.slice("words", F.col("k") + 1, F.size("words")))}
    ).drop("words")
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = join_measured(cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]), totals, "lang")
    wide = "decimal(19,0)"
    score = F.call_function(
        "div", (F.col("a") * 1000).cast(wide) * F.col("n").cast(wide), F.col("l").cast(wide) * F.col("r").cast(wide)
    )
    lowest = F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k"))
    scored = parts.withColumn("score", score).groupBy("lang", "phrase").agg(lowest.alias("best")).select("lang", "phrase", "best.*")
    order_by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order_by).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
