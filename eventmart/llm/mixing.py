"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source. A budget of tokens at the root is divided
among the children of each node by their weights, top down. A child cannot take
more than it holds, MAX_EPOCHS times over; what it leaves is divided among its
siblings by weight until they are full too, and since a node never gets more
than its subtree holds, a shortage reaches an ancestor's other children only
when the whole node is short. All amounts are whole numbers of tokens; less than
one token for each child is lost to rounding down.

A leaf that gets n times its tokens and a rest gives n whole epochs and, of the
epoch after them, the shortest prefix of a seeded order that holds the rest: the
document that crosses the end is the last one, so a leaf gives what it is given and less
than a document more, and one of few long documents is not empty. The
order is that of a hash of seed, epoch, doc_id and text. Where the prefix ends is
found by adding up tokens by the leading digits of the hash, then by the next
digits within the one bucket that holds the end, then document by document
within that, so no window runs over all documents of a leaf.

Tokens are words: runs of other than white space (0x09-0x0D, 0x20). Built-in
functions only.

Cases: null domain, language or source are the node ''. A null text has no
tokens. Rows that share a doc_id, or have none, are taken one by one unless their leaf and text
are equal too; such copies are one document. A leaf without a token gives no rows. An
empty table gives an empty table. A null doc_id is ordered as ''. Weights not listed are 1; zero or less is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import join_measured, stored

TREE = ("domain", "language", "source")
BUDGET_SHARE = (1, 2)  # of all tokens
MAX_EPOCHS = 2
SEED = 17
BUCKET_DIGITS = 2

# Target weights of the registered query; what is not listed weighs 1.
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "language": {"en": 6, "de": 2, "fr": 2},
    "source": {"src0": 2},
}


def domain_of(source: Column) -> Column:
    """Domain of a source where a table has none: one of four, by a hash of its name."""
    digit = F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)
    return F.concat(F.lit("d"), F.translate(digit, "0123456789abcdef", "0000111122223333"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    listed = weights.get(level, {})
    if any(w <= 0 for w in listed.values()):
        raise ValueError("weights must be positive whole numbers")
    if not listed:
        return F.lit(1).cast("long")
    table = F.create_map(*(part for name, w in listed.items() for part in (F.lit(name), F.lit(w).cast("long"))))
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1).cast("long"))


def _divide(children: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Give each child (weight, capacity) its part ``given`` of its parent's ``budget``."""
    within = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = within.orderBy(F.col("capacity").cast("double") / F.col("weight"), level)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = children.withColumns({"before": before, "after": after})
    full = F.expr("before * weight + capacity * after <= budget * weight")
    marked = ranked.withColumn("full", full)
    sums = marked.withColumns(
        {
            "taken": F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(within),
            "open": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(within),
        }
    )
    given = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("((budget - taken) * weight) div nullif(open, 0)"))
    return sums.withColumn("given", given)


def leaf_budgets(
    leaves: DataFrame, weights: dict[str, dict[str, int]], budget_share: tuple[int, int], max_epochs: int
) -> DataFrame:
    """(domain, language, source, tokens, given) from the leaves' tokens."""
    sized = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    nodes = sized.groupBy().agg(
        F.expr(f"least((coalesce(sum(tokens), 0L) * {budget_share[0]}) div {budget_share[1]}, coalesce(sum(capacity), 0L))").alias("budget")
    )
    for depth, level in enumerate(TREE):
        parent, path = list(TREE[:depth]), list(TREE[: depth + 1])
        children = sized.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        children = children.withColumn("weight", _weight(level, weights))
        # The root is one row; below it, parents and children meet on the path.
        above = nodes.select(*parent, "budget")
        with_budget = children.join(above, parent) if parent else children.join(F.broadcast(above))
        nodes = _divide(with_budget, parent, level).select(*path, "tokens", F.col("given").alias("budget"))
    return nodes.withColumnRenamed("budget", "given")


def _identity(doc_id: Column, text: Column) -> Column:
    """What tells documents apart in the order."""
    content = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), content)


def _hash(seed: int, epoch: Column) -> Column:
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.col("identity"))
    return F.md5(text.cast("binary"))


def _end(rows: DataFrame, ends: DataFrame, bucket: Column) -> DataFrame:
    """For each leaf with a rest, the bucket that reaches it, and what of the rest is left for this bucket."""
    sums = rows.groupBy(*TREE, bucket.alias("bucket")).agg(F.sum("tokens").alias("tokens"))
    through = F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("bucket"))
    due = ends.filter("rest > 0").select(*TREE, "rest")
    run = sums.withColumn("through", through).join(due, list(TREE)).filter("through >= rest")
    first = run.groupBy(*TREE).agg(F.min("bucket").alias("bucket"), F.min("rest").alias("rest"))
    at = run.join(first.select(*TREE, "bucket"), [*TREE, "bucket"])
    return at.select(*TREE, "bucket", (F.col("rest") - F.col("through") + F.col("tokens")).alias("rest"))


def plan(
    docs: DataFrame, weights=None, budget_share=BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """For each leaf: tokens, given, epochs (whole ones) and last_hash (end of the prefix of the next)."""
    rows = stored(_tree_columns(docs).select(*TREE, "identity", "tokens"), "mixing-rows", narrow=True)
    leaves = rows.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"))
    budgets = stored(
        leaf_budgets(leaves, weights or WEIGHTS, budget_share, max_epochs)
        .withColumn("epochs", F.coalesce(F.expr("given div nullif(tokens, 0)"), F.lit(0).cast("long")))
        .withColumn("rest", F.col("given") - F.col("epochs") * F.col("tokens")),
        "mixing-budgets",
    )
    due = budgets.filter("rest > 0").select(*TREE, "epochs")
    hashed = join_measured(rows, due, list(TREE), row_bytes=64).withColumn("hash", _hash(seed, F.col("epochs")))
    digits = BUCKET_DIGITS
    one = stored(_end(hashed, budgets, F.substring("hash", 1, digits)), "mixing-ends")
    inside = join_measured(hashed, one.select(*TREE, F.col("bucket").alias("first")), list(TREE), row_bytes=64)
    inside = stored(inside.filter(F.substring("hash", 1, digits) == F.col("first")), "mixing-inside")
    two = stored(_end(inside, one, F.substring("hash", digits + 1, digits)), "mixing-ends")
    second = two.select(*TREE, F.col("bucket").alias("second"), F.col("rest").alias("rest2"))
    close = join_measured(inside, second, list(TREE), row_bytes=64).filter(
        F.substring("hash", digits + 1, digits) == F.col("second")
    )
    # Copies of one document have one hash and are added up before the window.
    close = close.groupBy(*TREE, "hash", "rest2").agg(F.sum("tokens").alias("tokens"))
    through = F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("hash"))
    last = close.withColumn("through", through).filter("through >= rest2").groupBy(*TREE).agg(F.min("hash").alias("last"))
    ends = budgets.join(last, list(TREE), "left")
    return stored(
        ends.select(*TREE, "tokens", "given", "epochs", F.coalesce("last", F.lit("")).alias("last_hash")), "mixing-plan"
    )


def _tree_columns(docs: DataFrame) -> DataFrame:
    """The tree's columns, identity and tokens of every row."""
    domain = F.coalesce("domain", F.lit("")) if "domain" in docs.columns else domain_of(F.col("source"))
    return docs.select(
        domain.alias("domain"),
        F.coalesce("lang", F.lit("")).alias("language"),
        F.coalesce("source", F.lit("")).alias("source"),
        _identity(F.col("doc_id"), F.col("text")).alias("identity"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
    )


def mix(
    docs: DataFrame, weights=None, budget_share=BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The selected rows, once for each epoch they are in: all columns of ``docs``, and epoch.

    An input column named epoch is replaced.
    """
    budgets = plan(docs, weights, budget_share, max_epochs, seed)
    given = docs.drop("epoch")
    domain = F.coalesce("domain", F.lit("")) if "domain" in docs.columns else domain_of(F.col("source"))
    keyed = given.select(
        F.struct(*(F.col(f"`{c}`") for c in given.columns)).alias("row"),
        _identity(F.col("doc_id"), F.col("text")).alias("identity"),
        domain.alias("domain"),
        F.coalesce("lang", F.lit("")).alias("language"),
        F.coalesce("source", F.lit("")).alias("source"),
    )
    taken = join_measured(keyed, budgets.select(*TREE, "epochs", "last_hash"), list(TREE), row_bytes=96)
    times = F.col("epochs") + F.when(_hash(seed, F.col("epochs")) <= F.col("last_hash"), 1).otherwise(0)
    return (
        taken.withColumn("times", times.cast("int"))
        .filter("times > 0")
        .select("row.*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))
    )
