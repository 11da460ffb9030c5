"""Shop events from order line items.

Every line item becomes one event; customer, product and store come from the
tables it refers to. All picks are integer arithmetic on the line item's keys,
so the events are the same on every run and in every engine. Columns are damaged
on purpose, each by a condition of its own on those keys, so that every rule and
every repair has something to do; conditions overlap, so rows with several
faults occur. Some rows are sent twice, and some messages are empty.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.domain import CATEGORIES, CHANNELS, RAW_EVENT_FIELDS
from eventmart.sources.envelope import to_messages

FIRST_SECOND = 1_672_531_200  # 2023-01-01
SECONDS = 126_230_400  # four years
FIRST_ARRIVAL = 1_790_000_000
ARRIVAL_SECONDS = 1_000_000

# Texts of columns that no rule, constraint or report asks for particular values of.
PAYMENT_METHODS = ("invoice", "bank_transfer", "gift_card", "store_credit")
DEVICES = ("phone", "laptop", "kiosk", "television", "watch", "console")
BROWSERS = ("Lynx", "Vivaldi", "Brave", "Konqueror")
GENDERS = ("W", "M", "D")


def pick(values: tuple[str, ...], number: Column) -> Column:
    """The value at ``number`` modulo the number of values."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def every(step: int, rest: int) -> Column:
    """One row in ``step``, by the number all picks derive from."""
    return F.col("h") % step == rest


def event_type_of(flag: Column, line: Column, order: Column) -> Column:
    """What a line item stands for, from its return flag and its place in the order.

    Items sent back are returns on an order's first line and reviews on its second.
    Any other item on a first line was bought, and one on a second line reached the
    checkout; of the further lines every third order put them into the cart, and the
    rest was only looked at.
    """
    back = flag == "R"
    return (
        F.when(back & (line == 1), "return").when(back & (line == 2), "review")
        .when(line == 1, "purchase").when(line == 2, "checkout")
        .when(order % 3 == 0, "add_to_cart").otherwise("product_view")
    )


# A side of a join beyond this many rows is hashed within its partitions, so that the line items,
# which are many more, are shuffled and not sorted.
HASHED_ROWS = 1_500_000


def _sized(side: DataFrame) -> DataFrame:
    """A side of a join; its rows are counted from the files' footers."""
    return side.hint("shuffle_hash") if side.count() > HASHED_ROWS else side


def _spread(scan: DataFrame) -> DataFrame:
    """Split a scan over all cores where its files have fewer splits than there are cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def place(prefix: str) -> DataFrame:
        return places.select(
            F.col("n_nationkey").alias(f"{prefix}_nation"),
            F.col("n_name").alias(f"{prefix}_country"),
            F.col("r_name").alias(f"{prefix}_city"),
        )

    return (
        _spread(read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"))
        .join(_sized(read("orders").select("o_orderkey", "o_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_sized(read("customer")), F.col("o_custkey") == F.col("c_custkey"))
        .join(_sized(read("part")), F.col("l_partkey") == F.col("p_partkey"))
        .join(_sized(read("supplier")), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(place("customer"), F.col("c_nationkey") == F.col("customer_nation"))
        .join(place("store"), F.col("s_nationkey") == F.col("store_nation"))
    )


def raw_events(spark: SparkSession, folder: str, copies: bool = False) -> DataFrame:
    """Raw events with ``h`` (the number all picks derive from), ``copy`` and ``arrival``.

    With ``copies``, one row in 50 is sent again unchanged, and another one in 50
    again with a changed name and quantity; copies arrive an hour later.
    """
    h = F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7 + F.col("l_linenumber") * 101
    rows = _joined(spark, folder).withColumn("h", h.cast("bigint"))
    h = F.col("h")
    twice = F.when((h % 50).isin(0, 25), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = (F.col("copy") == 1) & (h % 50 == 25)

    typed = rows.withColumn("kind", event_type_of(F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_orderkey")))
    kind = F.col("kind")
    moment = F.timestamp_seconds(F.lit(FIRST_SECOND) + (h * 7919) % SECONDS)
    iso = F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    quantity = F.when(kind.isin("product_view", "review"), 1).otherwise(F.col("l_quantity").cast("int"))
    price = F.col("p_retailprice").cast("decimal(12,2)")
    discount = F.when(kind.isin("purchase", "checkout"), F.col("l_discount").cast("decimal(5,2)")).otherwise(0)
    category, name = pick(CATEGORIES, F.col("l_partkey")), F.col("p_name")
    columns = {
        "event_id": F.when(~every(211, 14), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
        "event_timestamp": F.when(every(223, 15), "2026-99-99T99:99:99")
        .when(every(227, 16), F.concat(F.lit("2031"), F.substring(iso, 5, 30))).otherwise(iso),
        "customer_id": F.when(~every(193, 11), F.concat(F.lit("CUST-"), "c_custkey")),
        "customer_name": F.when(~every(53, 2), F.col("c_name")),
        "customer_age": F.when(every(229, 17), 130).otherwise(16 + F.col("c_custkey") % 65).cast("int"),
        "customer_gender": pick(GENDERS, F.col("c_custkey")),
        "customer_country": F.col("customer_country"),
        "customer_city": F.col("customer_city"),
        "product_id": F.when(~every(197, 12), F.concat(F.lit("PROD-"), "l_partkey")),
        "product_category": F.when(every(179, 5), "Furniture").when(every(61, 6), F.concat(F.lit("  "), category, F.lit(" ")))
        .when(~every(173, 4), category),
        "brand": F.when(~every(79, 22), F.col("p_brand")),
        "supplier": F.when(~every(83, 23), F.col("s_name")),
        "store_id": F.when(~every(199, 13), F.concat(F.lit("STORE-"), "l_suppkey")),
        "store_name": F.col("s_name"),
        "store_country": F.col("store_country"),
        "store_city": F.col("store_city"),
        "price": F.when(every(67, 7), -price).when(~every(181, 8), price).cast("double"),
        "discount": F.when(every(239, 20), 1.5).when(~every(73, 19), discount.cast("double")),
        "marketing_channel": pick(CHANNELS, F.col("l_suppkey")),
    }
    arrival = F.timestamp_seconds(
        F.lit(FIRST_ARRIVAL) + (h * 37) % ARRIVAL_SECONDS + F.col("l_quantity").cast("bigint") + F.col("copy") * 3600
    )
    # These differ between a row and its copy, or take no more than its number and kind. The others are worked out
    # before rows are sent again: with that step between them, neither part is more code than the JVM compiles in one
    # method; beyond that, Spark would copy whole rows in every join and step. That is why a row is "sent again" once
    # where there are no copies.
    late = {
        "product_name": F.when(~every(59, 3), F.when(changed, F.concat(name, F.lit(" (resent)"))).otherwise(name)),
        "quantity": F.when(every(233, 18), -3).when(changed, quantity + 1).otherwise(quantity),
        "payment_method": F.when(kind.isin("checkout", "purchase", "return"), pick(PAYMENT_METHODS, h)),
        "event_type": F.when(every(71, 10), F.concat(F.lit(" "), F.upper(kind), F.lit("  "))).when(~every(191, 9), kind),
        "rating": F.when((kind == "review") & every(41, 21), 9).when(kind == "review", h % 5 + 1).cast("int"),
        "review_text": F.when(kind == "review", F.concat(F.lit("Review "), h)),
        "device_type": pick(DEVICES, h),
        "browser": pick(BROWSERS, h),
        "session_id": F.concat(F.lit("SES-"), h % 1_000_003),
    }

    full = {name: F.when(~every(251, 24), value) for name, value in columns.items()}
    sent = typed.select("h", "kind", "p_name", "l_quantity", *[value.alias(name) for name, value in full.items()])
    sent = sent.withColumn("copy", F.explode(twice if copies else F.array(F.lit(0))))
    changes = {name: F.when(~every(251, 24), value) for name, value in late.items()}
    return sent.withColumns({**changes, "arrival": arrival}).select("h", "copy", *RAW_EVENT_FIELDS, "arrival")


def messages(spark: SparkSession, folder: str, copies: bool = False) -> DataFrame:
    """The events as ``key, value, timestamp`` messages."""
    return to_messages(raw_events(spark, folder, copies), RAW_EVENT_FIELDS, "arrival")
