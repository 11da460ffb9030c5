"""De-duplication within a batch, against earlier batches, and per dimension key."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows of a block of marks; a block has a bit for each of them, in words of 64.
BLOCK_BITS = 12
WORDS = 1 << (BLOCK_BITS - 6)
BLOCK_BYTES = 8 * WORDS


def first_per_key(
    events: DataFrame, key: str = "event_id", order: Sequence[Column | str] = ("kafka_timestamp",), keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``key``: the first by ``order``, then by a hash of the whole row.

    With ``keep``, of these columns only: the others take part in the hash, which is
    formed before rows are sorted and shuffled, and are not moved.

    Rows that tie on both are equal, so the result does not depend on row order.
    It is an aggregate and not a window: copies collapse before the shuffle, so
    an id that holds a third of all rows costs one row per task.
    """
    rest = [c for c in events.columns if c != key]
    kept = [c for c in rest if keep is None or c in keep]
    # Spark keeps a column that is used twice in a step of its own, below the sort.
    rows = events.withColumn("_tie", F.xxhash64(*rest))
    first = F.min_by(F.struct(*(kept or ["_tie"])), F.struct(*order, "_tie")).alias("_first")
    return rows.groupBy(key).agg(first).select(key, *[F.col("_first")[c].alias(c) for c in kept])


def key_hash(key: str) -> Column:
    """A whole number for a key: a third of the bytes of an id, and grouped and looked up faster."""
    return F.xxhash64(key).alias("key_hash")


def later_copies(
    rows: DataFrame, repeated: DataFrame, key: str = "event_id", arrival: str = "kafka_timestamp", row: str = "row", tie: str = "hash",
    hashed: bool = False, bitmap: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """The numbers of the rows that another one of the same key precedes.

    First is the earliest to arrive, then the least ``tie``, a hash of the whole row, then
    the least number. ``repeated`` holds the keys that occur more than once, or, ``hashed``,
    their :func:`key_hash`; a key that shares its hash with another is still judged by itself. Only a few
    columns of their rows are shuffled, and never a whole row. ``bitmap`` is :func:`hash_bitmap` of the
    repeated hashes: rows whose hash has no bit there are no copies, and are not shuffled at all.
    """
    place = F.struct(F.col(arrival).alias("at"), F.col(tie).alias("tie"), F.col(row).alias("row")).alias("place")
    by = "key_hash" if hashed else key
    copies = rows.filter(F.col(key).isNotNull()).select(key, place, *([key_hash(key)] if hashed else []))
    if bitmap:
        copies = in_bitmap(copies, *bitmap)
    # Each key is repeated once, and Spark would move a semi-join below the bitmap.
    copies = copies.join(repeated.select(by), by, "inner" if bitmap else "left_semi").select(key, "place")
    first = copies.groupBy(key).agg(F.min("place").alias("first"))
    return copies.join(first, key).filter("place.row <> first.row").select("place.row")


def marks_of(numbers: DataFrame, row: str = "row") -> DataFrame:
    """Row numbers as ``block, marks``: one row for each block of rows that holds any, with a bit for each of its rows.

    Numbers are those of ``monotonically_increasing_id``, dense within a task, so marks
    take about a bit for each row of the table they are numbers of, however many are marked.
    """
    place = F.col(row).bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    words = numbers.groupBy(F.shiftright(row, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    entry = F.struct(F.col("word").bitwiseAND(F.lit(WORDS - 1)).cast("int").alias("at"), "bits")
    blocks = words.groupBy(F.shiftright("word", BLOCK_BITS - 6).alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("set"))
    every = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda at: F.coalesce(F.try_element_at("set", at), F.lit(0).cast("bigint")))
    return blocks.select("block", every.alias("marks"))


def bitmap_bits(size: int, most_bytes: int) -> int | None:
    """Bits of a hash, that number the bits of a bitmap with 16 or more for each of ``size`` hashes.

    None where a bitmap of at most ``most_bytes`` would leave fewer than four: too many rows would pass it.
    """
    bits = min(max(BLOCK_BITS, (16 * size - 1).bit_length()), (8 * most_bytes).bit_length() - 1)
    return bits if bits >= BLOCK_BITS and 4 * size <= 1 << bits else None


def _low(bits: int) -> Column:
    return F.col("key_hash").bitwiseAND(F.lit((1 << bits) - 1))


def hash_bitmap(hashes: DataFrame, bits: int) -> tuple[DataFrame, int]:
    """``key_hash`` as marks at their lower ``bits``: a hash without a mark is not among them."""
    return marks_of(hashes.select(_low(bits).alias("row"))), bits


def in_bitmap(rows: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """Rows whose ``key_hash`` has a mark, where they lie; these are all that are among the hashes, and a few more."""
    marks = F.broadcast(marks.select(F.col("block").alias("_block"), F.col("marks").alias("_marks")))
    word = F.shiftright(_low(bits), 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    marked = F.call_function("bit_get", F.get("_marks", word), F.col("key_hash").bitwiseAND(F.lit(63)).cast("int"))
    joined = rows.withColumn("_block", F.shiftright(_low(bits), BLOCK_BITS)).join(marks, "_block")
    return joined.filter(marked == 1).drop("_block", "_marks")


def without_marked(rows: DataFrame, marks: DataFrame, row: str = "row", small: bool = True) -> DataFrame:
    """Rows whose number is not marked. Marks measured to be ``small`` are broadcast; rows then stay where they are."""
    marks = marks.select(F.col("block").alias("_block"), F.col("marks").alias("_marks"))
    marks = F.broadcast(marks) if small else marks.hint("shuffle_hash")
    word = F.shiftright(row, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    marked = F.call_function("bit_get", F.get("_marks", word), F.col(row).bitwiseAND(F.lit(63)).cast("int"))
    joined = rows.withColumn("_block", F.shiftright(row, BLOCK_BITS)).join(marks, "_block", "left")
    return joined.filter(F.coalesce(marked, F.lit(0)) == 0).drop("_block", "_marks")


def with_ranks(marks: DataFrame) -> DataFrame:
    """Marks with ``ranks``, how many rows of the block are marked before each of its words, and ``held``, how many are in all."""
    counts = F.transform("marks", F.bit_count)
    before = F.transform(counts, lambda _, at: F.aggregate(F.slice(counts, F.lit(1), at), F.lit(0), lambda sum, n: sum + n))
    held = F.aggregate(counts, F.lit(0).cast("bigint"), lambda sum, n: sum + n)
    return marks.select("block", "marks", before.alias("ranks"), held.alias("held"))


def only_marked(rows: DataFrame, places: DataFrame, row: str = "row", small: bool = True) -> DataFrame:
    """Rows whose number is marked, with ``_rank``, the marked rows before them in the whole table.

    ``places`` hold the blocks' marks and ranks, and with ``before`` the marked rows of all blocks
    before. Measured to be ``small`` they are broadcast; rows then stay where they are.
    """
    places = places.select(F.col("block").alias("_block"), F.col("marks").alias("_marks"), F.col("ranks").alias("_ranks"), F.col("before").alias("_before"))
    places = F.broadcast(places) if small else places.hint("shuffle_hash")
    word = F.shiftright(row, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    place = F.col(row).bitwiseAND(F.lit(63)).cast("int")
    joined = rows.withColumn("_block", F.shiftright(row, BLOCK_BITS)).join(places, "_block").withColumn("_word", F.get("_marks", word))
    below = F.col("_word").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), place)))
    kept = joined.filter(F.call_function("bit_get", F.col("_word"), place) == 1)
    rank = F.col("_before") + F.get("_ranks", word) + F.bit_count(below)
    return kept.withColumn("_rank", rank).drop("_block", "_marks", "_ranks", "_before", "_word")


def last_per_key(
    events: DataFrame, key: str, attributes: Sequence[str], at: str = "event_timestamp",
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """The attributes of every ``key`` at its latest time; ties go to the larger attributes.

    Rows collapse in two steps. The first keeps the latest time of every distinct
    version of a member. It groups by plain columns, so it is a hash aggregate,
    and it runs before the shuffle. The second picks one of the few versions.

    An attribute with an entry in ``defaults`` takes its last value other than
    the default, and the default only where there is no other.
    """
    if not attributes:
        return events.select(key).distinct()
    versions = events.groupBy(key, *attributes).agg(F.max(at).alias("_at"))
    known = {a: text for a, text in (defaults or {}).items() if a in attributes}
    others = [a for a in attributes if a not in known]
    picks = [F.max_by(F.struct(*others), F.struct("_at", *attributes)).alias("_last")]
    for attribute, text in known.items():
        value = F.when(F.col(attribute) != text, F.col(attribute))
        picks.append(F.max_by(value, F.when(value.isNotNull(), F.struct("_at", *attributes))).alias(attribute))
    last = versions.groupBy(key).agg(*picks).select(key, "_last.*", *known)
    filled = last.withColumns({a: F.coalesce(a, F.lit(text)) for a, text in known.items()}) if known else last
    return filled.select(key, *attributes)


def restrict_to(frame: DataFrame, keys: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows of ``frame`` whose key is in ``keys``.

    Where the caller has measured ``keys`` and found it ``small``, it is
    broadcast and ``frame`` is filtered where it lies, without a shuffle.
    Otherwise ``frame`` is returned whole: the join that follows shuffles anyway.
    """
    if not small:
        return frame
    return frame.join(F.broadcast(keys.select(key)), key, "left_semi")


def not_seen(events: DataFrame, seen: DataFrame, key: str = "event_id", small: bool = False) -> DataFrame:
    """Events whose key is not in ``seen``. Only the key column of ``seen`` is read."""
    return events.join(restrict_to(seen.select(key), events, key, small), key, "left_anti")
