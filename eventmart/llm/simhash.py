"""SimHash near-duplicates: fingerprints, exact tiled comparison, components.

Every pair of distinct fingerprints within the radius is found. Fingerprints are
tiled by the population counts of their two halves: the counts of two
fingerprints within the radius differ by no more than the radius in total, so
pairs of tiles beyond it are never formed. A tile holds about TILE_ROWS
fingerprints; larger cells are cut into chunks. Inside a pair of tiles the
counts of the four quarters skip sub-tiles in the same way, and what is left is
compared by exclusive-or and bit count in numpy.

Copies share one fingerprint and are compared once. A pair of tiles returns a
spanning forest of its links, not the links, so a group of n near copies costs
about n edges for each pair of tiles that it touches.

Cases: a null or empty text, or one of white space only, has fingerprint zero,
which links like any other. Repeated rows are returned as often as given. A null
doc_id is kept; its component is the smallest doc_id of the group that has one,
else null. Other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.components import components
from eventmart.llm.tables import BATCH_ROWS, by_batch, free_name, join_measured, stored, utf8

RADIUS = 4
SHINGLE = 4
SEED = 42
TILE_ROWS = 65_536

# A-Z to a-z, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits: each set if it is set in over half of the shingles' hashes."""
    words = (text or b"").translate(LOWER).split()  # splits at 0x09-0x0D and 0x20
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-shingle]]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), 255):  # so that a byte holds each count
        counts += np.unpackbits(rows[at : at + 255], axis=1).sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a signed long) of every row."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle) for t in utf8(rows.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, fp long")


def _quarters(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by quarter counts; the distinct counts; where each begins in the order."""
    shifts = np.array([0, 16, 32, 48], np.uint64)
    counts = np.bitwise_count((prints[:, None] >> shifts) & np.uint64(0xFFFF)).astype(np.int64)
    key = counts @ np.array([17**3, 17**2, 17, 1])
    order = np.argsort(key, kind="stable")
    _, begins = np.unique(key[order], return_index=True)
    return order, counts[order][begins], np.append(begins, len(prints))


def forest(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or within one if right is None.

    Returns two arrays of fingerprints; at most one edge for each fingerprint.
    """
    other = left if right is None else right
    nodes = left if right is None else np.concatenate([left, right])
    shift = 0 if right is None else len(left)
    label = np.arange(len(nodes))
    order_l, counts_l, begins_l = _quarters(left)
    order_r, counts_r, begins_r = _quarters(other)
    sizes_r = np.diff(begins_r)
    for g, counts in enumerate(counts_l):
        near = np.abs(counts_r - counts).sum(axis=1) <= radius
        if right is None:
            near[:g] = False  # that pair of sub-tiles was compared before
        if not near.any():
            continue
        rows, cols = order_l[begins_l[g] : begins_l[g + 1]], order_r[np.repeat(near, sizes_r)]
        width = max(1, 1_000_000 // len(cols))
        for at in range(0, len(rows), width):
            some = rows[at : at + width]
            hit = np.bitwise_count(left[some][:, None] ^ other[cols][None, :]) <= radius
            a, b = np.nonzero(hit)
            a, b = some[a], cols[b] + shift
            while True:
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(nxt := label[label], label):
                    label = nxt
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within the radius; ``distinct`` is stored and holds each fp once."""
    half = F.lit(0xFFFFFFFF)
    celled = distinct.select(
        "fp",
        F.bit_count(F.col("fp").bitwiseAND(half)).alias("low"),
        F.bit_count(F.shiftrightunsigned("fp", 32).bitwiseAND(half)).alias("high"),
    )
    # At most 33 x 33 cells, so this table is small at any size.
    cells = stored(
        celled.groupBy("low", "high").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks")), "simhash-cells"
    )
    tiles = stored(
        celled.join(F.broadcast(cells), ["low", "high"])
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .groupBy("low", "high", "chunk")
        .agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    steps = [
        (x, y)
        for x in range(-radius, radius + 1)
        for y in range(-radius, radius + 1)
        if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)
    ]
    step = F.explode(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps)))
    names = ["low", "high", "chunk"]
    number = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    pairs = (
        cells.select("low", "high", number.alias("chunk"), step.alias("step"))
        .select(*names, (F.col("low") + F.col("step.x")).alias("low2"), (F.col("high") + F.col("step.y")).alias("high2"))
        .join(F.broadcast(cells.toDF("low2", "high2", "chunks")), ["low2", "high2"])
        .select(*names, "low2", "high2", number.alias("chunk2"))
        .filter("low != low2 OR high != high2 OR chunk <= chunk2")
    )
    others = tiles.toDF("low2", "high2", "chunk2", "fps2")
    same = F.expr("low = low2 AND high = high2 AND chunk = chunk2")
    compared = (
        pairs.join(tiles, names)
        .join(others, ["low2", "high2", "chunk2"])
        .select("fps", F.when(~same, F.col("fps2")).alias("fps2"))
    )

    def compare(batches):
        for rows in batches:
            for one, two in zip(rows.column(0), rows.column(1), strict=True):
                a = np.sort(one.values.to_numpy().view(np.uint64))
                b = np.sort(two.values.to_numpy().view(np.uint64)) if two.is_valid else None
                x, y = forest(a, b, radius)
                edges = [pa.array(x.view(np.int64)), pa.array(y.view(np.int64))]
                yield pa.RecordBatch.from_arrays(edges, ["a", "b"])

    conf = distinct.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # a row holds two whole tiles
    found = stored(compared.mapInArrow(compare, "a long, b long"), "simhash-links")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return found


def _chosen(prints: DataFrame, value: Column, radius: int, tile_rows: int) -> DataFrame:
    """fp and chosen, the smallest ``value`` of the rows that links reach from the fingerprint; ``prints`` is stored."""
    distinct = stored(prints.groupBy("fp").agg(F.min(value).alias("first")), "simhash-distinct")
    edges = links(distinct, radius, tile_rows)
    labels = components(edges)
    joined = join_measured(distinct, labels.toDF("fp", "root"), "fp", "left", row_bytes=16)
    grouped = joined.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    lowest = grouped.groupBy("root").agg(F.min("first").alias("chosen"))
    return stored(grouped.join(lowest, "root").select("fp", "chosen"), "simhash-components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links reach) of every row."""
    prints = stored(fingerprints(docs), "simhash-prints", narrow=True)
    named = _chosen(prints, F.col("doc_id"), radius, tile_rows).withColumnRenamed("chosen", "component_id")
    return join_measured(prints, named, "fp", row_bytes=16).select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the smallest doc_id.

    What stays is decided by row, not by doc_id. Of rows that share the smallest doc_id the first in the
    table's order stays; a row without a doc_id stays if no row of its group has one and it is the first.
    """
    fp, row = free_name("fp", docs), free_name("row", docs)
    names, at = docs.columns, docs.columns.index("text")

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t) for t in utf8(rows.column(at))], np.uint64)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(prints.view(np.int64))], [*names, fp])

    printed = by_batch(docs, batch, docs.withColumn(fp, F.lit(0).cast("long")).schema)
    numbered = stored(printed.withColumn(row, F.monotonically_increasing_id()), "simhash-numbered")
    prints = numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    chosen = _chosen(prints, order, radius, tile_rows).select("fp", F.col("chosen.row").alias("stays"))
    gone = join_measured(prints, chosen, "fp", row_bytes=16).filter("row != stays")
    gone = stored(gone.select(F.col("row").alias(row)), "simhash-gone", narrow=True)
    return join_measured(numbered, gone, row, "left_anti", row_bytes=8).select(*(F.col(f"`{name}`") for name in names))
