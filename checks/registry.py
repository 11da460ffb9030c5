"""Every registered query: ``name -> f(spark, folder)``.

Timestamps are returned as text and money as doubles, so that results compare
the same way in any engine. Load times are left out.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import marts
from eventmart.domain import CATEGORIES, CHANNELS, RAW_EVENT_DDL, RAW_EVENT_FIELDS, VALID_YEARS, Domain
from eventmart.functions.cleaning import as_date, as_timestamp, nan_to_null, normalize
from eventmart.functions.enrichment import enrich
from eventmart.functions.rules import rejected, valid, validate
from eventmart.operators import merge
from eventmart.operators.constraints import check_constraints, check_tables, duplicate_keys, orphans, row_rules
from eventmart.operators.dedup import first_per_key, not_seen
from eventmart.operators.keys import next_key
from eventmart.operators.resolve import lacks_member, resolve_keys, sized
from eventmart.plans import reports
from eventmart.plans.audit import check_mart
from eventmart.plans.load import LOOKUP_ROWS
from eventmart.plans.load import dead_letters as dead_letter_rows
from eventmart.plans.load import fact_rows, incoming_members, load_batch
from eventmart.session import configure
from eventmart.sources import line_items
from eventmart.sources.envelope import to_messages

Query = Callable[[SparkSession, str], DataFrame]

AUDIT = ("created_at", "updated_at")


def plain(frame: DataFrame) -> DataFrame:
    """Money as double, timestamps as text."""
    changes = {}
    for field in frame.schema:
        kind = field.dataType.typeName()
        if kind == "decimal":
            changes[field.name] = F.col(field.name).cast("double")
        elif kind in ("timestamp", "timestamp_ntz"):
            changes[field.name] = F.col(field.name).cast("string")
    return frame.withColumns(changes) if changes else frame


def _normalized(spark, folder):
    return normalize(marts.events(spark, folder))


def _checked(spark, folder):
    return validate(_normalized(spark, folder))


# Columns that enrichment, and the lookup of keys, take something from.
ENRICHED = ("event_timestamp_ts", "event_type", "price", "discount", "quantity")
LOOKED_UP = ("customer_id", "product_id", "store_id", "marketing_channel")


def _unique(spark, folder, keep=None):
    return first_per_key(valid(_checked(spark, folder)).drop("raw_json", "ingestion_timestamp"), keep=keep)


def _enriched(spark, folder, keep=None):
    return enrich(_unique(spark, folder, keep))


# --- sources, normalisation, validation, enrichment ---------------------------


def parse_events(spark, folder):
    return plain(marts.events(spark, folder).select("kafka_key", "kafka_timestamp", *RAW_EVENT_FIELDS))


def publish_envelope(spark, folder):
    sent = to_messages(line_items.raw_events(configure(spark), folder), timestamp="arrival")
    return plain(sent.select("key", "timestamp", F.inline(F.array(F.from_json("value", RAW_EVENT_DDL)))))


def normalize_events(spark, folder):
    columns = (
        "event_id", "kafka_timestamp", "event_timestamp_ts", "event_type", "product_category", "customer_name",
        "product_name", "brand", "supplier", "payment_method", "discount", "price",
    )
    return plain(_normalized(spark, folder).select(*columns))


def nan_to_null_query(spark, folder):
    lines = configure(spark).read.parquet(f"{folder}/lineitem.parquet")
    holes = F.when(F.col("l_partkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return nan_to_null(lines.select(*keys, holes.alias("discount"), "l_tax"))


def coerce_dates(spark, folder):
    """Dates and timestamps from text, with nulls for text that is neither."""
    raw = line_items.raw_events(configure(spark), folder).select("event_id", "event_timestamp")
    return plain(
        raw.select("event_id", as_date("event_timestamp").alias("day"), as_timestamp("event_timestamp").alias("moment"))
    )


def validate_events(spark, folder):
    return plain(_checked(spark, folder).select("event_id", "kafka_timestamp", "reject_reason", "is_valid"))


def split_valid(spark, folder):
    return plain(valid(_checked(spark, folder)).select("event_id", "kafka_timestamp", "event_type", "quantity", "price"))


def split_invalid(spark, folder):
    return plain(rejected(_checked(spark, folder)).select("event_id", "kafka_timestamp", "reject_reason"))


def enrich_events(spark, folder):
    columns = (
        "event_id", "event_timestamp", "final_price", "revenue", "profit_estimate", "event_date", "event_month",
        "event_year", "event_hour", "week_number", "is_weekend", "date_key", "full_date", "quarter", "month_name",
        "day_of_month", "day_name",
    )
    return plain(_enriched(spark, folder, ENRICHED).select(*columns))


# --- de-duplication -----------------------------------------------------------


def dedup_in_batch(spark, folder):
    return plain(_unique(spark, folder).select("event_id", "kafka_timestamp", "product_name", "quantity"))


def dedup_across_batches(spark, folder):
    """Events of the second half that the first half does not hold."""
    first = first_per_key(valid(validate(normalize(marts.first_half(spark, folder)))).select("event_id", "kafka_timestamp"))
    second = first_per_key(valid(validate(normalize(marts.second_half(spark, folder)))).select("event_id", "kafka_timestamp"))
    return plain(not_seen(second, first))


def dim_last_wins(spark, folder):
    return incoming_members(_enriched(spark, folder), merge.CUSTOMER)


# --- stored tables ------------------------------------------------------------


def _table(name: str, *without: str) -> Query:
    return lambda spark, folder: plain(marts.single(spark, folder).table(name).drop(*without))


def scd1_change_only(spark, folder):
    """Customers after two batches, and whether the second one changed them."""
    stored = marts.halves(spark, folder).table("dim_customer")
    return stored.withColumn("changed", F.col("updated_at") > F.col("created_at")).drop(*AUDIT)


def scd1_products(spark, folder):
    stored = marts.halves(spark, folder).table("dim_product")
    return stored.withColumn("changed", F.col("updated_at") > F.col("created_at")).drop(*AUDIT)


def scd1_stores(spark, folder):
    stored = marts.halves(spark, folder).table("dim_store")
    return stored.withColumn("changed", F.col("updated_at") > F.col("created_at")).drop(*AUDIT)


def scd1_always(spark, folder):
    """Customers after two batches of which the second rewrites every customer in it."""
    stored = marts.halves_always(spark, folder).table("dim_customer")
    return stored.withColumn("changed", F.col("updated_at") > F.col("created_at")).drop(*AUDIT)


def dim_keep_known(spark, folder):
    """Customers where a default name does not replace a known one."""
    return incoming_members(_enriched(spark, folder), merge.CUSTOMER, keep_known=True)


def fact_two_batches(spark, folder):
    """Facts per load, after two overlapping batches."""
    facts = marts.halves(spark, folder).table("fact_sales")
    loads = facts.groupBy("loaded_at").agg(
        F.count("*").alias("facts"), F.countDistinct("event_id").alias("events"), F.sum("revenue").alias("revenue")
    )
    return plain(loads.drop("loaded_at"))


def dead_letters(spark, folder):
    stored = marts.single(spark, folder).table("dead_letter_events")
    sent_id = F.get_json_object("raw_payload", "$.event_id")
    empty = (F.col("raw_payload") == "").alias("empty")
    return stored.select("event_id", "reject_reason", "batch_id", sent_id.alias("sent_id"), empty)


def surrogate_keys(spark, folder):
    """Rows, lowest, highest and distinct keys of the tables whose keys follow no order."""
    mart = marts.single(spark, folder)

    def of(table: str, key: str) -> DataFrame:
        return mart.table(table).agg(
            F.count("*").alias("row_count"), F.min(key).alias("lowest"), F.max(key).alias("highest"),
            F.countDistinct(key).alias("keys"),
        ).select(F.lit(table).alias("table_name"), "*")

    return of("fact_sales", "sales_key").unionByName(of("dead_letter_events", "dead_letter_key"))


def highest_keys(spark, folder):
    mart = marts.single(spark, folder)
    dims = [d for d in merge.DIMENSIONS if d.key]
    parts = [next_key(mart.table(d.table), d.key).select(F.lit(d.table).alias("table_name"), "max_key") for d in dims]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- constraints --------------------------------------------------------------


def constraint_violations(spark, folder):
    """How often the stored tables' constraints would break if nothing were rejected."""
    rows, rules = _normalized(spark, folder), []
    rows = rows.withColumn("event_timestamp", F.col("event_timestamp_ts"))
    for table in ("dim_customer", "dim_product", "dim_store", "dim_channel", "fact_sales"):
        of_table = row_rules(table, lengths=True, columns=rows.columns)
        rules += [(f"{table}/{name}", bad) for name, bad in of_table]
    counted = check_constraints(rows, rules).filter("violations > 0")
    return counted.select(
        F.substring_index("rule", "/", 1).alias("table_name"), F.substring_index("rule", "/", -1).alias("rule"), "violations"
    )


def table_constraints(spark, folder):
    """Constraints of all stored tables that break once less is allowed, stores are doubled and products are lost."""
    mart = marts.single(spark, folder)
    at = mart.commit_record()
    tables = {name: mart.table(name, at) for name in at.snapshots}
    stores = tables["dim_store"]
    tables["dim_store"] = stores.unionByName(stores.filter("store_key % 5 = 0"))
    tables["dim_product"] = tables["dim_product"].filter("product_key % 11 <> 0")
    narrow = Domain(VALID_YEARS[:3], ("purchase", "return", "review"), CATEGORIES[1:], CHANNELS[1:])
    return check_tables(tables, lengths=True, domain=narrow).filter("violations > 0")


def constraints_since(spark, folder):
    """Constraints that a load past all rules has broken, found by a check of that load alone."""
    return check_mart(marts.damaged(spark, folder)).filter("violations > 0")


def repeated_ids(spark, folder):
    """Event ids sent more than once."""
    return duplicate_keys(marts.events(spark, folder), "event_id")


def fk_orphans(spark, folder):
    """Facts whose customer is missing once every seventh customer is removed."""
    mart = marts.single(spark, folder)
    kept = mart.table("dim_customer").filter("customer_key % 7 <> 0")
    return orphans(mart.table("fact_sales"), kept, "customer_key")


def _lookups(mart):
    """Dimensions as lookups, sized by the keys they have given out."""
    at = mart.commit_record()
    return {d.table: sized(mart.table(d.table, at), at.max_keys[d.table], LOOKUP_ROWS) for d in merge.DIMENSIONS}


def missing_members(spark, folder):
    """Events per store that resolve and that do not, once every third store is removed."""
    mart = marts.single(spark, folder)
    tables = _lookups(mart)
    tables["dim_store"] = tables["dim_store"].filter("store_key % 3 <> 0")
    resolved = resolve_keys(_enriched(spark, folder, (*ENRICHED, *LOOKED_UP)), tables)
    found = F.col("store_key").isNotNull()
    return resolved.groupBy("store_id").agg(
        F.count_if(found).alias("resolved"), F.count_if(~found).alias("missing"),
        F.count_if(F.col("customer_key").isNull() | F.col("date_key").isNull()).alias("others_missing"),
    )


def facts_without_members(spark, folder):
    """Facts per event type that a load would make if every third store were unknown; events of those stores make none."""
    mart = marts.single(spark, folder)
    tables = _lookups(mart)
    tables["dim_store"] = tables["dim_store"].filter("store_key % 3 <> 0")
    kept = resolve_keys(_enriched(spark, folder, (*ENRICHED, *LOOKED_UP)), tables).filter(~lacks_member())
    facts = fact_rows(kept, datetime.now(timezone.utc))
    return plain(facts.groupBy("event_type").agg(F.count("*").alias("facts"), F.sum("revenue").alias("revenue")))


def dead_letter_fallbacks(spark, folder):
    """Dead letters of rejected events of which some have lost their reason and some their text."""
    rejects = rejected(_checked(spark, folder))
    rejects = rejects.withColumns(
        {
            "reject_reason": F.when(F.col("product_id").isNotNull(), F.col("reject_reason")),
            "raw_json": F.when(F.col("store_id").isNotNull(), F.col("raw_json")),
        }
    )
    letters = dead_letter_rows(rejects, 5, datetime.now(timezone.utc))
    empty = F.col("raw_payload") == ""
    return letters.groupBy("reject_reason", "batch_id").agg(F.count("*").alias("letters"), F.count_if(empty).alias("empty"))


def range_violations(spark, folder):
    """Every range of facts and dates that breaks once their values are moved out of it."""
    mart = marts.single(spark, folder)
    facts = mart.table("fact_sales").select(
        (F.col("event_hour") + 20).alias("event_hour"), (F.col("rating") + 2).alias("rating"),
        (F.col("final_price") - 1000).alias("final_price"), (F.col("quantity") - 5).alias("quantity"), (-F.col("discount")).alias("discount"),
    )
    dates = mart.table("dim_date").select(*[(F.col(c) + 1).alias(c) for c in ("quarter", "month", "week_number", "day_of_month")])
    broken = [
        check_constraints(frame, row_rules(table, columns=frame.columns)).select(F.lit(table).alias("table_name"), "rule", "violations")
        for table, frame in (("fact_sales", facts), ("dim_date", dates))
    ]
    return broken[0].unionByName(broken[1]).filter("violations > 0")


def length_violations(spark, folder):
    """Texts of customers and products that are too long once they are repeated."""
    mart, parts = marts.single(spark, folder), []
    for table, columns in (("dim_customer", ("customer_name", "customer_country")), ("dim_product", ("product_name", "brand"))):
        longer = mart.table(table).select(*[F.repeat(c, F.lit(9)).alias(c) for c in columns])
        rules = [rule for rule in row_rules(table, lengths=True, columns=columns) if "long" in rule[0]]
        parts.append(check_constraints(longer, rules).select(F.lit(table).alias("table_name"), "rule", "violations"))
    return parts[0].unionByName(parts[1])


def ingestion_times(spark, folder):
    """Messages with a time of ingestion, and how many such times one reading has."""
    read = marts.events(spark, folder)
    return read.agg(F.count("ingestion_timestamp").alias("messages"), F.countDistinct("ingestion_timestamp").alias("moments"))


def table_listing(spark, folder):
    """Names of the stored tables, with the columns each has."""
    mart = marts.single(spark, folder)
    names = [row.table_name for row in mart.list_tables().collect()]
    return spark.createDataFrame([(n, len(mart.table(n).columns)) for n in names], "table_name string, columns bigint")


# --- loads --------------------------------------------------------------------


def replay_is_noop(spark, folder):
    """Row counts after the same batch was offered again."""
    mart = marts.single(spark, folder)
    again = load_batch(mart, marts.events(spark, folder), 0)
    return reports.row_counts(mart).withColumn("replayed", F.lit(again.replayed))


def stream_load(spark, folder):
    """Facts per type and category, from a mart filled by a stream."""
    mart = marts.streamed(spark, folder)
    per_product = mart.table("fact_sales").groupBy("event_type", "product_key").agg(
        F.count("*").alias("n"), F.sum("revenue").alias("total")
    )
    joined = per_product.join(mart.table("dim_product").select("product_key", "product_category"), "product_key")
    return plain(
        joined.groupBy("event_type", "product_category").agg(F.sum("n").alias("facts"), F.sum("total").alias("revenue"))
    )


def stream_restart(spark, folder):
    """What the stream has loaded after it lost a load that was written and not published."""
    mart = marts.restarted(spark, folder)
    facts = mart.table("fact_sales").groupBy("event_type").agg(
        F.count("*").alias("facts"), F.countDistinct("event_id").alias("events"), F.sum("revenue").alias("revenue")
    )
    dead = mart.table("dead_letter_events").agg(F.count("*").alias("dead_letters"))
    return plain(facts.join(F.broadcast(dead)))


def stream_dead_letters(spark, folder):
    return reports.rejection_summary(marts.streamed(spark, folder))


def load_counts(spark, folder):
    """What each of two overlapping loads did."""
    mart = marts.halves(spark, folder)
    names = ("valid", "rejected", "inserted", "skipped", "missing_key")
    rows = [(n - 1, *(mart.commit_record(n).counts[name] for name in names)) for n in (1, 2)]
    return spark.createDataFrame(rows, "batch_id bigint, " + ", ".join(f"{name} bigint" for name in names))


def load_two_sources(spark, folder):
    """Facts and dead letters of two sources that loaded at the same time, one of them twice."""
    mart = marts.two_sources(spark, folder)
    facts = mart.table("fact_sales").agg(
        F.count("*").alias("facts"), F.countDistinct("event_id").alias("events"),
        F.countDistinct("sales_key").alias("keys"), F.sum("revenue").alias("revenue"),
    )
    dead = mart.table("dead_letter_events").agg(F.count("*").alias("dead_letters"))
    return plain(facts.join(F.broadcast(dead)))


def _report(name: str) -> Query:
    return lambda spark, folder: plain(reports.REPORTS[name](marts.single(spark, folder)))


def q20_facts(spark, folder):
    return plain(reports.newest_facts(marts.halves(spark, folder)).drop("sales_key", "loaded_at"))


def q20_dead_letters(spark, folder):
    newest = reports.newest_dead_letters(marts.halves(spark, folder))
    sent = F.from_json("raw_payload", RAW_EVENT_DDL)
    fields = [sent[name].alias(f"sent_{name}") for name in RAW_EVENT_FIELDS]
    return plain(newest.select("event_id", "reject_reason", "batch_id", *fields))


QUERIES: dict[str, Query] = {
    "parse_events": parse_events,
    "publish_envelope": publish_envelope,
    "normalize_events": normalize_events,
    "nan_to_null": nan_to_null_query,
    "coerce_dates": coerce_dates,
    "validate_events": validate_events,
    "split_valid": split_valid,
    "split_invalid": split_invalid,
    "enrich_events": enrich_events,
    "dedup_in_batch": dedup_in_batch,
    "dedup_across_batches": dedup_across_batches,
    "dim_last_wins": dim_last_wins,
    "dim_keep_known": dim_keep_known,
    "dim_customer": _table("dim_customer", *AUDIT),
    "dim_product": _table("dim_product", *AUDIT),
    "dim_store": _table("dim_store", *AUDIT),
    "dim_channel": _table("dim_channel"),
    "dim_date": _table("dim_date"),
    "scd1_change_only": scd1_change_only,
    "scd1_products": scd1_products,
    "scd1_stores": scd1_stores,
    "scd1_always": scd1_always,
    "fact_sales": _table("fact_sales", "sales_key", "loaded_at"),
    "fact_two_batches": fact_two_batches,
    "dead_letters": dead_letters,
    "surrogate_keys": surrogate_keys,
    "highest_keys": highest_keys,
    "constraint_violations": constraint_violations,
    "table_constraints": table_constraints,
    "constraints_since": constraints_since,
    "repeated_ids": repeated_ids,
    "fk_orphans": fk_orphans,
    "missing_members": missing_members,
    "facts_without_members": facts_without_members,
    "dead_letter_fallbacks": dead_letter_fallbacks,
    "range_violations": range_violations,
    "length_violations": length_violations,
    "ingestion_times": ingestion_times,
    "table_listing": table_listing,
    "replay_is_noop": replay_is_noop,
    "stream_restart": stream_restart,
    "stream_load": stream_load,
    "stream_dead_letters": stream_dead_letters,
    "load_counts": load_counts,
    "load_two_sources": load_two_sources,
    **{name: _report(name) for name in reports.REPORTS if name not in ("q20_facts", "q20_dead_letters")},
    "q20_facts": q20_facts,
    "q20_dead_letters": q20_dead_letters,
}
