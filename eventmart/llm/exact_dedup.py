"""Exact de-duplication by progressive refinement: length, prefix hash, full hash.

Texts are equal if they are identical after deleting white space (0x09-0x0D and
0x20). The lengths of what is left are counted first. Only rows of a length that
occurs twice get a hash of their first characters, and only rows whose length and
prefix both occur twice are hashed in full. Which rows those are is told by bitmaps of
fixed size, so each scan hashes them in place and no text is shuffled; a
false hit costs a hash and changes nothing, because groups are formed by the
full hash. Groups are aggregated before they are shuffled, and a group of any
size is one row after that.

Of equal texts the row with the most code points stays, then the smallest
doc_id, then the first row read. Built-in functions only.

Cases: a null text counts as empty; all texts without content are equal. A null
doc_id loses against any other. Of repeated rows one stays. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import join_measured, stored

PREFIX_CHARS = 64
# Bits of the bitmap: 1,024 rows of 4,096 bytes, that is 4 MB at any size of the input.
BITMAP_BITS = 1024 * 32_768


def normalized(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")


def _measured(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        normalized().alias("norm"),
    ).select("*", F.length("norm").alias("size"))


def _bitmap(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` as bits, (bucket, bits), of their hashes."""
    bucket, bit = _spot(*keys.columns)
    rows = keys.select(bucket.alias("bucket"), bit.cast("long").alias("bit"))
    return stored(rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "exact-bitmap")


def _spot(*columns: str) -> tuple[Column, Column]:
    spot = F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS))
    return F.floor(spot / 32_768).cast("int"), F.pmod(spot, F.lit(32_768)).cast("int")


def _marked(rows: DataFrame, bitmap: DataFrame, *columns: str, name: str) -> DataFrame:
    """Whether the bit of a row's columns is set, as column ``name``."""
    bucket, bit = _spot(*columns)
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("int")
    shared = F.expr("bits IS NOT NULL") & (F.expr("shiftright(byte, bit % 8)").bitwiseAND(F.lit(1)) == 1)
    # A bitmap has at most 1,024 rows.
    held = rows.withColumns({"bucket": bucket, "bit": bit}).join(F.broadcast(bitmap), "bucket", "left")
    return held.withColumn("byte", byte).withColumn(name, shared).drop("bucket", "bit", "bits", "byte")


def shared_lengths(docs: DataFrame) -> DataFrame:
    """Lengths that at least two rows have in common."""
    return _measured(docs).groupBy("size").agg(F.count("*").alias("n")).filter("n > 1").select("size")


def _with_prefix(docs: DataFrame, lengths: DataFrame) -> DataFrame:
    """Measured rows with a hash of their first characters where their length is shared."""
    prefix = F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))
    rows = _marked(_measured(docs), lengths, "size", name="same_size")
    return rows.withColumn("prefix", F.when(F.col("same_size"), prefix))


def shared_prefixes(docs: DataFrame, lengths: DataFrame) -> DataFrame:
    """(size, prefix) that at least two rows have in common, given the bitmap of shared lengths."""
    rows = _with_prefix(docs, lengths).filter("same_size")
    return rows.groupBy("size", "prefix").agg(F.count("*").alias("n")).filter("n > 1").select("size", "prefix")


def hashed(docs: DataFrame, **extra: Column) -> DataFrame:
    """A row for each document row with the hashes it needed: ``prefix`` and ``full`` are null where one did not do it."""
    lengths = _bitmap(shared_lengths(docs))
    prefixes = _bitmap(shared_prefixes(docs, lengths))
    rows = _marked(_with_prefix(docs, lengths), prefixes, "size", "prefix", name="same_prefix")
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "chars", "size", "prefix",
            F.when(F.col("same_size") & F.col("same_prefix"), F.sha2("norm", 256)).alias("full"),
            *(column.alias(name) for name, column in extra.items()),
        ),
        "exact-rows",
    )


def exact_duplicates(docs: DataFrame, **extra: Column) -> DataFrame:
    """One row for each document row: doc_id, keep_id, group_size, kept.

    ``extra`` are further columns computed while the text is read; they may use
    ``norm``, the text without white space, and must not be named like a column used here.
    """
    rows = hashed(docs, **extra)
    groups = stored(
        rows.filter("full IS NOT NULL")
        .groupBy("size", "full")
        .agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("chars", (-F.col("doc_id")).alias("id"), (-F.col("row")).alias("row"))).alias("best"),
        )
        .filter("group_size > 1")
        .select("size", "full", "group_size", (-F.col("best.id")).alias("keep_id"), (-F.col("best.row")).alias("keep_row")),
        "exact-groups",
    )
    return join_measured(rows, groups, ["size", "full"], "left", row_bytes=120).select(
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        *extra,
    )
