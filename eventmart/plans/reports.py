"""Reports over the stored star schema.

Every report takes a :class:`~eventmart.mart.Mart` and returns a lazy DataFrame.

Facts are aggregated by surrogate key *before* the join to a dimension. The
partial sums collapse in every task, so a customer or product that holds a third
of all facts costs one row per task, and the join sees each member once. No
dimension is broadcast by hint; Spark does it where the size allows.

Money is summed exactly and becomes a double in the last step. Top-k reports
break ties by business id.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.domain import NET_TYPES, TABLES
from eventmart.functions.rounding import percentage, ratio
from eventmart.mart import Mart


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _net(mart: Mart) -> DataFrame:
    """Facts that move revenue; only their partitions are read."""
    return mart.table("fact_sales").filter(F.col("event_type").isin(*NET_TYPES))


def _money(total: Column) -> Column:
    return total.cast("double")


def _revenue_by(mart: Mart, table: str, key: str, *attributes: str) -> DataFrame:
    """Net revenue per group of dimension attributes, as an exact decimal."""
    per_member = _net(mart).groupBy(key).agg(F.sum("revenue").alias("member_revenue"))
    joined = per_member.join(mart.table(table).select(key, *attributes), key)
    return joined.groupBy(*attributes).agg(_money(F.sum("member_revenue")).alias("revenue"))


def row_counts(mart: Mart) -> DataFrame:
    """Rows of every table."""
    at = mart.commit_record()
    parts = [
        mart.table(name, at).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in TABLES
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.orderBy("table_name")


def total_revenue(mart: Mart) -> DataFrame:
    """Purchases net of returns."""
    return _net(mart).agg(_money(F.sum("revenue")).alias("total_revenue"))


def revenue_by_category(mart: Mart) -> DataFrame:
    grouped = _revenue_by(mart, "dim_product", "product_key", "product_category")
    return grouped.orderBy(F.desc("revenue"), "product_category")


def revenue_by_store_country(mart: Mart) -> DataFrame:
    grouped = _revenue_by(mart, "dim_store", "store_key", "store_country")
    return grouped.orderBy(F.desc("revenue"), "store_country")


def monthly_revenue(mart: Mart) -> DataFrame:
    return _revenue_by(mart, "dim_date", "date_key", "year", "month", "month_name").orderBy("year", "month")


def yearly_revenue(mart: Mart) -> DataFrame:
    return _revenue_by(mart, "dim_date", "date_key", "year").orderBy("year")


def top_customers(mart: Mart, limit: int = 10) -> DataFrame:
    """Customers with the highest net revenue."""
    per_customer = _net(mart).groupBy("customer_key").agg(
        F.count_if(_is("purchase")).alias("purchase_events"), F.sum("revenue").alias("exact")
    )
    named = per_customer.join(mart.table("dim_customer"), "customer_key").select(
        "customer_id", "customer_name", "customer_country", "purchase_events", "exact"
    )
    top = named.orderBy(F.desc("exact"), "customer_id").limit(limit)
    return top.withColumn("net_revenue", _money(F.col("exact"))).drop("exact")


def top_products(mart: Mart, limit: int = 10) -> DataFrame:
    """Products with the highest net revenue, and the units they sold."""
    units = F.sum(F.when(_is("purchase"), F.col("quantity").cast("bigint")).otherwise(0))
    per_product = _net(mart).groupBy("product_key").agg(units.alias("units_sold"), F.sum("revenue").alias("exact"))
    named = per_product.join(mart.table("dim_product"), "product_key").select(
        "product_id", "product_name", "product_category", "units_sold", "exact"
    )
    top = named.orderBy(F.desc("exact"), "product_id").limit(limit)
    return top.withColumn("net_revenue", _money(F.col("exact"))).drop("exact")


def return_rate(mart: Mart) -> DataFrame:
    """Returns in percent of purchases."""
    counts = mart.table("fact_sales").agg(
        F.count_if(_is("return")).alias("returns"), F.count_if(_is("purchase")).alias("purchases")
    )
    return counts.withColumn("return_rate_pct", percentage(F.col("returns"), F.col("purchases")))


def conversion_funnel(mart: Mart) -> DataFrame:
    """Views, checkouts and purchases, and the shares that go on to purchase."""
    counts = mart.table("fact_sales").agg(
        F.count_if(_is("product_view")).alias("views"),
        F.count_if(_is("checkout")).alias("checkouts"),
        F.count_if(_is("purchase")).alias("purchases"),
    )
    return counts.withColumns(
        {
            "view_to_purchase_pct": percentage(F.col("purchases"), F.col("views")),
            "checkout_to_purchase_pct": percentage(F.col("purchases"), F.col("checkouts")),
        }
    )


def customer_lifetime_value(mart: Mart, limit: int = 20) -> DataFrame:
    """Customers with the highest net revenue over all time."""
    per_customer = _net(mart).groupBy("customer_key").agg(F.sum("revenue").alias("exact"))
    named = per_customer.join(mart.table("dim_customer").select("customer_key", "customer_id", "customer_name"), "customer_key")
    top = named.drop("customer_key").orderBy(F.desc("exact"), "customer_id").limit(limit)
    return top.withColumn("customer_lifetime_value", _money(F.col("exact"))).drop("exact")


def average_rating(mart: Mart) -> DataFrame:
    """Mean rating and number of reviews per product."""
    reviews = mart.table("fact_sales").filter(_is("review") & F.col("rating").isNotNull())
    per_product = reviews.groupBy("product_key").agg(
        F.sum("rating").alias("stars"), F.count("rating").alias("review_count")
    )
    named = per_product.join(mart.table("dim_product"), "product_key").select(
        "product_id", "product_name", "product_category",
        ratio(F.col("stars"), F.col("review_count")).alias("average_rating"), "review_count",
    )
    return named.orderBy(F.desc("average_rating"), F.desc("review_count"), "product_id")


def marketing_channels(mart: Mart) -> DataFrame:
    """Purchases and net revenue per channel."""
    per_channel = _net(mart).groupBy("channel_key").agg(
        F.count_if(_is("purchase")).alias("purchases"), _money(F.sum("revenue")).alias("net_revenue")
    )
    named = per_channel.join(mart.table("dim_channel"), "channel_key")
    return named.select("marketing_channel", "purchases", "net_revenue").orderBy(
        F.desc("net_revenue"), "marketing_channel"
    )


def rejection_summary(mart: Mart, limit: int | None = None, count_name: str = "rejected_records") -> DataFrame:
    """Dead letters per reason, the most frequent first."""
    grouped = mart.table("dead_letter_events").groupBy("reject_reason").agg(F.count("*").alias(count_name))
    ordered = grouped.orderBy(F.desc(count_name), "reject_reason")
    return ordered.limit(limit) if limit else ordered


def top_rejections(mart: Mart) -> DataFrame:
    return rejection_summary(mart, 10, "cnt")


def revenue_by_payment_method(mart: Mart) -> DataFrame:
    """Purchases only."""
    grouped = mart.table("fact_sales").filter(_is("purchase")).groupBy("payment_method").agg(
        F.count("*").alias("transactions"), F.sum("revenue").alias("exact"), F.sum("final_price").alias("prices")
    )
    return grouped.select(
        "payment_method", "transactions", _money(F.col("exact")).alias("total_revenue"),
        ratio(F.col("prices"), F.col("transactions")).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"), "payment_method")


def warehouse_health(mart: Mart) -> DataFrame:
    """Presence and rows of every expected table, and a flag for an empty fact table."""
    at = mart.commit_record()
    expected = mart.spark.createDataFrame(
        [(i, name, at is not None and name in at.snapshots) for i, name in enumerate(TABLES)],
        "position int, table_name string, present boolean",
    )
    counts = row_counts(mart) if at else mart.spark.createDataFrame([], "table_name string, row_count bigint")
    joined = expected.join(F.broadcast(counts), "table_name", "left")
    is_empty_fact = (F.col("table_name") == "fact_sales") & (F.coalesce("row_count", F.lit(0)) == 0)
    return joined.orderBy("position").select("table_name", "present", "row_count", is_empty_fact.alias("empty_fact"))


def revenue_by_store(mart: Mart) -> DataFrame:
    grouped = _revenue_by(mart, "dim_store", "store_key", "store_id", "store_name")
    return grouped.orderBy(F.desc("revenue"), "store_id")


def total_revenue_exact(mart: Mart) -> DataFrame:
    """Net revenue as a decimal."""
    return _net(mart).agg(F.sum("revenue").alias("total_revenue"))


def newest_facts(mart: Mart, limit: int = 10) -> DataFrame:
    """The last facts loaded; only the loads that brought them are read."""
    return mart.newest_rows("fact_sales", limit).orderBy(F.desc("loaded_at"), "event_id").limit(limit)


def newest_dead_letters(mart: Mart, limit: int = 10) -> DataFrame:
    order = (F.desc("created_at"), F.asc_nulls_last("event_id"), F.asc("dead_letter_key"))
    return mart.newest_rows("dead_letter_events", limit).orderBy(*order).limit(limit)


# Names the single counts go by.
COUNT_NAMES = {
    "fact_rows": "fact_sales",
    "rejected_rows": "dead_letter_events",
    "customers": "dim_customer",
    "products": "dim_product",
    "stores": "dim_store",
    "dates": "dim_date",
    "channels": "dim_channel",
}


def count_of(mart: Mart, name: str) -> DataFrame:
    """One table's row count under its own name, e.g. ``customers``."""
    return mart.table(COUNT_NAMES[name]).agg(F.count("*").alias(name))


def named_counts(mart: Mart) -> DataFrame:
    """All row counts, each under its own name, in one row."""
    counts = row_counts(mart)
    return counts.agg(
        *[F.max(F.when(F.col("table_name") == table, F.col("row_count"))).alias(name) for name, table in COUNT_NAMES.items()]
    )


REPORTS: dict[str, Callable[[Mart], DataFrame]] = {
    "q01": row_counts,
    "q02": total_revenue,
    "q03": revenue_by_category,
    "q04": revenue_by_store_country,
    "q05": monthly_revenue,
    "q06": yearly_revenue,
    "q07": top_customers,
    "q08": top_products,
    "q09": return_rate,
    "q10": conversion_funnel,
    "q11": customer_lifetime_value,
    "q12": average_rating,
    "q13": marketing_channels,
    "q14": rejection_summary,
    "q15": revenue_by_payment_method,
    "q16": top_rejections,
    "q17": warehouse_health,
    "q18": revenue_by_store,
    "q19": total_revenue_exact,
    "q20_facts": newest_facts,
    "q20_dead_letters": newest_dead_letters,
    "q21": named_counts,
}
