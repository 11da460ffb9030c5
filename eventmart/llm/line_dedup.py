"""Line de-duplication against levelled sorted runs of line hashes.

The runs (``line_runs``) hold, for each line hash, the number of documents seen with
it and the document that keeps the line. Documents are taken in batches of descending
doc_id, so a hash that no run knows yet is kept by a document of this batch: the
batch's sorted hashes are merge-anti-joined with the runs, the unknown ones bring
their keeper, the known ones only their count, and together they form the
batch's own run on level 0. Where a level has FAN_IN runs they are merged into
one on the next level, so the runs to search stay few.

Runs can be kept for documents that come later. Those lose a line once its documents,
earlier ones included, are MIN_DOCS; its keeper stays that of the call that saw it first,
because what an earlier call returned is not looked at again.

A line's key is the line without white space at both ends and with A-Z in lower
case; the hash has 128 bits. Keys of at least MIN_CHARS code points that are
found in at least MIN_DOCS documents lose all their lines but those of the
keeper, the largest doc_id.

Cases: a null text counts as empty, that is one empty line. A null doc_id sorts
below all others and counts as one document. Rows that share a doc_id are one
document: they keep or lose a line together. What a row loses is gathered by its
document and a hash of its own text, so a doc_id of many rows is no group of its own; a
line that two texts under one id and one hash lose together belongs to both. Other columns are
handed through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.line_runs import KEY, LineRuns, as_they_lie
from eventmart.llm.tables import by_batch, free_name, join_measured, stored, utf8

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = b" \t\n\x0b\x0c\r"
LEAST = -(2**63)


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits of the line's key; None if the key is too short."""
    key = line.strip(BLANK)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.translate(LOWER))


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each document row and distinct key: doc, body (a hash of the text), h1, h2 (halves of the line's hash)."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        docs, bodies, hashes = [], [], []
        for doc, body, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), utf8(rows.column(2)), strict=True):
            own = {h for line in (text or b"").split(b"\n") if (h := line_hash(line, min_chars))}
            docs += [doc] * len(own)
            bodies += [body] * len(own)
            hashes += own
        pairs = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
        columns = [pa.array(docs, pa.int64()), pa.array(bodies, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
        return pa.RecordBatch.from_arrays(columns, ["doc", "body", *KEY])

    narrow = docs.select(_doc().alias("doc"), F.xxhash64("text").alias("body"), "text")
    return by_batch(narrow, batch, "doc long, body long, h1 long, h2 long")


def drops(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, runs: LineRuns | None = None
) -> DataFrame:
    """doc, body and hashes (array of 16-byte keys) of the lines each text loses; texts that lose none are left out."""
    bare = docs.select(_doc().alias("doc"))
    cuts = bare.approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    batch = sum((F.when(F.col("doc") < F.lit(int(cut)), 1).otherwise(0) for cut in cuts), F.lit(0))
    lines = stored(line_hashes(docs, min_chars).withColumn("batch", batch), "lines", "batch", narrow=True)
    runs = runs or LineRuns(docs.sparkSession)
    expected = lines.count()
    try:
        for number in range(batches):
            runs.add(lines.filter(F.col("batch") == number).drop("batch"), expected)
        with as_they_lie(docs.sparkSession):
            frequent = runs.merged().filter(F.col("n_docs") >= min_docs).select(*KEY, "keeper")
            frequent = stored(frequent, "line-frequent")
    finally:
        runs.forget_tables()
    lost = join_measured(lines, frequent, KEY, row_bytes=24).filter(F.col("doc") != F.col("keeper"))
    keyed = lost.select("doc", "body", F.struct(*KEY).alias("h"))
    return stored(keyed.groupBy("doc", "body").agg(F.collect_set("h").alias("hashes")), "line-drops")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, runs: LineRuns | None = None
) -> DataFrame:
    """The documents with ``text`` less its repeated lines, and n_lines (before) and n_dropped.

    All columns of ``docs`` are handed through; input columns of those two names
    are replaced. ``runs`` are those of earlier documents; the lines of these ones are
    added, and stay once the caller publishes them.
    """
    gone = drops(docs, min_chars, min_docs, batches, runs)
    size = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
    given = docs.drop("n_lines", "n_dropped")
    names = given.columns
    doc, body, hashes = (free_name(name, given) for name in ("doc", "body", "hashes"))
    gone = gone.select(F.col("doc").alias(doc), F.col("body").alias(body), F.col("hashes").alias(hashes))
    keyed = given.withColumns({doc: _doc(), body: F.xxhash64("text")})
    joined = join_measured(keyed, gone, [doc, body], "left", row_bytes=16, rows=size[0] + size[1])
    at = names.index("text")

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, dropped = [], [], []
        lost = rows.column(len(names))
        for k, text in enumerate(utf8(rows.column(at))):
            lines = (text or b"").split(b"\n")
            counts.append(len(lines))
            if lost[k].is_valid:
                pairs = lost[k].values
                own = np.column_stack([pairs.field(0).to_numpy(), pairs.field(1).to_numpy()])
                hashes = {own[i].tobytes() for i in range(len(own))}
                lines = [line for line in lines if line_hash(line, min_chars) not in hashes]
            dropped.append(counts[-1] - len(lines))
            texts.append(b"\n".join(lines).decode())
        columns = [pa.array(texts, pa.string()) if i == at else rows.column(i) for i in range(len(names))]
        columns += [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    out = given.withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    whole = joined.select(*(F.col(f"`{c}`") for c in names), hashes)
    return by_batch(whole, batch, out)
