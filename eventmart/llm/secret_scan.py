"""Secret scans by a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: an
OR over the alternatives of its literal parts, each the AND of their trigrams.
The index holds a posting (trigram, document) for every trigram that some rule
asks for; the postings of an alternative are intersected by counting, and the
rule's expression then verifies its candidates on the whole text. A rule with an
alternative that holds no trigram, such as a run of hexadecimal digits, scans
all texts.

Matches are leftmost and do not overlap within a rule; a match whose measured
group is too short is dropped after matching, so it still hides what it covers.
Built-in functions only.

Cases: a null text counts as empty. Rows are returned as often as given; rows
that share a doc_id share candidates, which verification sorts out. Null doc_ids
are indexed like any other. Other columns are ignored. Positions are code
points, the end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import join_measured, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and how long the group ``measured`` must be to count."""

    kind: str
    pattern: str
    least: int = 0
    measured: int = 0
    base: bool = False


# The three base rules as given, then rules for formats with public descriptions.
RULES = (
    Rule(
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        12, 2, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]+", 16, 0, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
)

BREAK = None
MOST_ALTERNATIVES = 64
# Matches whose positions are added up in one go.
BLOCK = 256


def _expand(tree) -> list[tuple]:
    """Alternatives of a parsed expression, each a run of characters and BREAKs for anything else."""
    found: list[tuple] = [()]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            parts = [(chr(value).lower(),)]
        elif name == "SUBPATTERN":
            parts = _expand(value[-1])
        elif name == "BRANCH":
            parts = [alternative for branch in value[1] for alternative in _expand(branch)]
        elif name == "MAX_REPEAT" and value[:2] == (0, 1) and str(value[2][0][0]) == "LITERAL":
            parts = [(), *_expand(value[2])]
        elif name == "MAX_REPEAT" and value[0] >= 1:
            parts = [(*alternative, BREAK) for alternative in _expand(value[2])]
        else:
            parts = [(BREAK,)]
        if len(found) * len(parts) > MOST_ALTERNATIVES:
            parts = [(BREAK,)]
        found = [(*left, *right) for left in found for right in parts]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The alternatives' trigrams, in lower case; empty if some alternative has none, so every text is a candidate."""
    query = []
    for alternative in _expand(re._parser.parse(pattern)):
        runs = "".join("\0" if c is BREAK else c for c in alternative).split("\0")
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return []
        query.append(grams)
    return query


def index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, doc_id) of the texts of ``docs`` for the given trigrams."""
    lowered = docs.select("doc_id", F.lower("text").alias("lowered"))
    held = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(g)), F.lit(g)) for g in grams)))
    return lowered.select("doc_id", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame | None, dict[str, list]]:
    """(doc_id, kinds) of documents that some rule's query selects, and the query of every rule."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    wanted = [(f"{kind}:{n}", kind, gram) for kind, query in queries.items() for n, grams in enumerate(query) for gram in sorted(grams)]
    if not wanted:
        return None, queries
    postings = index(docs, sorted({gram for _, _, gram in wanted}))
    need = {f"{kind}:{n}": len(grams) for kind, query in queries.items() for n, grams in enumerate(query)}
    asks = F.create_map(
        *(
            part
            for gram in sorted({g for _, _, g in wanted})
            for part in (F.lit(gram), F.array(*(F.lit(name) for name, _, g in wanted if g == gram)))
        )
    )
    needed = F.create_map(*(part for name, n in need.items() for part in (F.lit(name), F.lit(n))))
    hits = (
        postings.select("doc_id", "gram", F.explode(asks[F.col("gram")]).alias("name"))
        .groupBy("doc_id", "name")
        .agg(F.count_distinct("gram").alias("n"))
        .filter(F.col("n") == needed[F.col("name")])
    )
    kinds = hits.groupBy("doc_id").agg(F.collect_set(F.split("name", ":")[0]).alias("kinds"))
    return stored(kinds, "secret-candidates"), queries


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _matches(rule: Rule) -> Column:
    """Matches of a rule in ``text`` as array of (start, end).

    Positions are added up within blocks of matches and then over the blocks, so that
    no step copies an array that grows with the text.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split("text", rule.pattern, -1).alias("gap"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all("text", pattern, F.lit(rule.measured)).alias("part"),
    )
    zero = F.lit(0).cast("long")

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        out = F.when(F.length(x["part"]) >= rule.least, F.concat(seen["out"], span)).otherwise(seen["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def blocks(found: Column) -> Column:
        """Length and spans of each block, counted from its beginning."""
        first = F.struct(zero.alias("at"), _no_spans().alias("out"))
        firsts = F.sequence(F.lit(1), F.size(found), F.lit(BLOCK))
        return F.transform(firsts, lambda at: F.aggregate(F.slice(found, at, F.lit(BLOCK)), first, step))

    def moved(parts: Column) -> Column:
        """The spans of all blocks, counted from the beginning of the text."""
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(
            parts, first,
            lambda seen, part: F.struct(
                (seen["at"] + part["at"]).alias("at"), F.concat(seen["starts"], F.array(seen["at"])).alias("starts")
            ),
            lambda seen: seen["starts"],
        )
        return F.flatten(F.zip_with(parts, starts, lambda part, at: F.transform(part["out"], lambda s: _move(s, at))))

    return _let(_let(zipped, blocks), moved)


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint>>")


def _move(span: Column, by: Column) -> Column:
    return F.struct((span["start"] + by).alias("start"), (span["end"] + by).alias("end"))


def _span(rank: int, rule: Rule):
    """From a match to its struct."""
    return lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
        s["end"].alias("end"), F.lit(rule.base).alias("base"),
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array of (start, rank, kind, end, base) by start, then order of the rules."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found, queries = candidates(texts, rules)
    if found is None:
        joined = texts.withColumn("kinds", F.array().cast("array<string>"))
    else:
        keyed = found.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), "kinds")
        joined = join_measured(
            texts.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)))), keyed, "key", "left", row_bytes=64
        ).select("doc_id", "text", "kinds")
    arrays = []
    for rank, rule in enumerate(rules):
        # A run that is too short can't hold one that is long enough, so these can be searched for at once.
        likely = rule.pattern.removesuffix("+") + f"{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern
        due = F.col("text").rlike(likely)
        if queries[rule.kind]:
            due = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) & due
        arrays.append(F.transform(F.when(due, _matches(rule)).otherwise(_no_spans()), _span(rank, rule)))
    return joined.select("doc_id", F.array_sort(F.concat(*arrays)).alias("spans"))
