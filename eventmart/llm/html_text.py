"""Main text of web pages: markup first, then repeated passages by a host's suffix array.

Pages are cut into blocks by their markup. Elements that never hold main text are
left out, by tag or by a name in class, id or role, a whole one or a known compound:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader
comments. Where a page has an article or main element, only blocks inside count. An
article in an element that only its name marks is left out where the page has
another article, and counts where it has none, unless the name is one of comments
or adverts.

The pages of a host are taken together, cut into shards of about SHARD_TOKENS. In a
shard the pages' token streams are concatenated, and suffixes are sorted by their
first RUN tokens by prefix doubling; equal neighbours from distinct pages are repeated
passages. Equal streams count as one page, for a copied page is no boilerplate.
Near-equal pages (another date, a changed word) count about once: by each of KEYS least
hashes one page text of those with an equal hash counts, and counts are means over the
KEYS. A passage is boilerplate where MIN_TEXTS page texts of the host and a SHARE of
them all have it. What has the share of a host has it in one of its shards at least, so
each shard only names the passages that reach the share within it, by hashes of 64
bits; all shards then count the named ones, and the sums decide, so the cut changes no result.

A block that boilerplate covers whole is removed where markup has not told that it is
main text: in a page without an article element, and in an article below a name of
which one part marks other content and another is unknown. No block is cut.

Cases: null or empty html, or html without text, gives an empty text. Null urls
form a host of their own. Repeated rows are returned as often. Unclosed elements
end where HTML says, or with their parent. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import by_batch, join_measured, stored

SHARD_TOKENS = 2**18
RUN = 8  # tokens, a power of two
# Boilerplate is on MIN_TEXTS page texts of a host at least, and on this share of them; near-equal texts count once.
MIN_TEXTS = 3
SHARE = (1, 4)
MARK = "\n"  # between blocks; no token holds it
# Near-equal pages are told by KEYS least hashes: each of a multiplier and a summand, fixed numbers.
KEYS = 8
MIX = np.uint64(0x9E3779B97F4A7C15)
FACTORS = [
    (np.uint64(xxhash.xxh3_64_intdigest(b"factor", k) | 1), np.uint64(xxhash.xxh3_64_intdigest(b"summand", k)))
    for k in range(KEYS)
]

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset(
    "script style noscript template svg math iframe object canvas audio video head title select option button "
    "textarea input nav header footer aside menu dialog fieldset".split()
)
# Silent parts of a line of text, which go on after them.
LINE = INLINE | {"button", "select", "textarea", "svg", "canvas", "audio", "video"}
MAIN = frozenset({"article", "main"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
CLOSE_SELF = frozenset("li dt dd tr td th option".split())
CONTAINERS = frozenset("html body div section article main table ul ol dl blockquote td th li figure".split())
# Names in class, id and role that mark what is not main text.
MARKS = frozenset(
    "ad ads adv adbox adslot adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar side nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs footer header masthead comment comments disqus respond replies share sharing social related "
    "recommended newsletter subscribe signup login search pagination pager widget complementary contentinfo "
    "toolbar skip commentlist".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond replies ad ads advert advertisement promo sponsored".split())
# Words that make a compound with one of MARKS, such as main-nav or ad-slot-1. Any other word, as in has-sidebar,
# no-comments, menu-open or share-price, says that the name is about something else.
PARTS = frozenset(
    "site page main global top bottom left right center upper lower primary secondary block blocks box boxes bar bars "
    "container wrapper wrap inner outer section area region zone slot unit list lists link links item items icon icons "
    "button buttons btn form field dialog message policy panel pane group row column col post posts article articles "
    "entry story stories user reader blog body text title content widgets mobile desktop sticky fixed inline google "
    "thread leaderboard cta dark light reviews and v".split()
)
SPACE = re.compile(r"\s+")
NUMBER = re.compile(r"v?\d")


def marked(names: str, marks: frozenset[str]) -> bool:
    """Whether one of the names is a word of ``marks``, or a compound of one with other MARKS, PARTS and numbers."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if not marks.isdisjoint(words) and all(w in MARKS or w in PARTS or NUMBER.match(w) for w in words):
            return True
    return False


def mentions(names: str) -> bool:
    """Whether one of the names holds a word of MARKS."""
    return not MARKS.isdisjoint(re.split(r"[^a-z0-9]+", names.lower()))


class Block(NamedTuple):
    """A block of text; whether it is inside an article, and below a name that may mark other content there."""

    text: str
    main: bool
    unsure: bool


class Open(NamedTuple):
    """An open element: its tag, and what holds inside."""

    tag: str
    silent: bool = False
    main: bool = False
    below: bool = False  # in an article below an element that is silent by its name
    closed: bool = False  # silent for articles too
    unsure: bool = False


class Blocks(HTMLParser):
    """Collects blocks, each with whether it is in an article below a name that silences.

    An article ends a silence that came from a form or from the name of an element around it,
    but for names of comments and adverts, and not one that came from another tag.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.now = Open("")
        self.found: list[tuple[Block, bool]] = []
        self.held: list[str] = []

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.held)).strip()
        self.held = []
        if text:
            self.found.append((Block(text, self.now.main, self.now.unsure), self.now.below))

    def _cut(self, depth: int) -> None:
        self.count.subtract(o.tag for o in self.open[depth:])
        del self.open[depth:]
        self.now = self.open[-1] if self.open else Open("")

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "br":
                self.held.append(" ")
            if tag in VOID:
                return
        elif tag not in LINE:
            self.flush()
            self._imply(tag)
            if tag in VOID:
                return
        now, main = self.now, tag in MAIN
        given = {name: value for name, value in attrs if name in ("class", "id", "role") and value}
        if tag in HEADINGS or (now.main and tag == "section"):  # generators name these after what they say
            given.pop("id", None)
        names = " ".join(given.values())
        marks = MARKS
        if tag in ("html", "body"):
            marks = frozenset()
        elif main or tag in HEADINGS or (now.main and tag == "p"):
            marks = COMMENTS
        named = bool(names) and marked(names, marks)
        closed = now.closed or tag in SILENT or (named and (main or marked(names, COMMENTS)))
        opens = main and now.silent and not closed
        # Inside an article a silent part stays silent, whatever it holds.
        closed = closed or ((named or tag == "form") and (now.main or main))
        silent = closed or named or tag == "form" or (now.silent and not opens)
        unsure = not main and (now.unsure or (now.main and bool(names) and marks is MARKS and mentions(names)))
        if tag not in LINE and (silent != now.silent or unsure != now.unsure):
            self.flush()
        self.now = Open(tag, silent, now.main or main, now.below or opens, closed, unsure)
        self.open.append(self.now)
        self.count[tag] += 1

    def _imply(self, tag: str) -> None:
        """End an open paragraph, or an open item before the next."""
        if not self.count["p"] and not (tag in CLOSE_SELF and self.count[tag]):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth].tag
            if name == "p" or (tag in CLOSE_SELF and name == tag):
                self._cut(depth)
                return
            if name in CONTAINERS:
                return

    def handle_endtag(self, tag):
        if tag not in LINE:
            self.flush()
        if not self.count[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                self._cut(depth)
                return
            if tag in INLINE and self.open[depth].tag in CONTAINERS:
                return

    def handle_data(self, data):
        if not self.now.silent:
            self.held.append(data)


def blocks(html: str | None) -> list[Block]:
    text = html or ""
    comment = text.rfind("<!--")
    if comment >= 0 and text.find("-->", comment) < 0 and text.find("--!>", comment) < 0:
        text = text[:comment]  # a comment without an end takes the rest
    parser = Blocks()
    parser.feed(text)
    parser.close()
    parser.flush()
    # Articles below silent names, such as teasers in a sidebar, only count where the page has no other.
    other = any(block.main and not below for block, below in parser.found)
    return [block for block, below in parser.found if not (below and other)]


def _sequence(streams: list[list[str]]) -> tuple[dict[str, int], list[np.ndarray], np.ndarray, np.ndarray]:
    """Numbers of the tokens, the streams in numbers, all of them in a row, and their sizes."""
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(t, len(number)) for t in s], np.int64) for s in streams]
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    # An end mark of its own after each stream keeps passages within it.
    tokens = np.concatenate([np.append(x, len(number) + k) for k, x in enumerate(ids)]) if ids else np.zeros(0, np.int64)
    return number, ids, tokens, sizes


def _ranks(tokens: np.ndarray, base: int, run: int) -> np.ndarray:
    """Suffixes by their first ``run`` tokens, by prefix doubling: equal ranks are equal passages."""
    rank, n, length = tokens, len(tokens), 1
    while length < run and n:
        ahead = np.full(n, -1)
        ahead[: max(0, n - length)] = rank[length:]
        rank = np.unique(rank * (n + base + 1) + ahead + 1, return_inverse=True)[1]
        length *= 2
    return rank


def _carriers(rank: np.ndarray, page: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """For each row of ``counted`` (a number for each page) and each rank, the sum over the pages with the passage."""
    order = np.lexsort((page, rank))  # the suffixes, sorted by their first tokens
    r, p = rank[order], page[order]
    new = np.append(True, (r[1:] != r[:-1]) | (p[1:] != p[:-1]))
    r, p = r[new], p[new]
    return np.array([np.bincount(r, row[p], int(rank.max()) + 1) for row in counted]).astype(np.int64)


def _cover(starts: np.ndarray, run: int) -> np.ndarray:
    """The tokens in passages that begin at ``starts``."""
    n = len(starts)
    edge = np.zeros(n + run, np.int64)
    edge[:n] += starts
    edge[run:] -= starts
    return np.cumsum(edge)[:n] > 0


def _cut(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(sizes + 1) - 1
    return [flat[e - s : e] for e, s in zip(ends, sizes, strict=True)]


def stream_of(page: list[Block]) -> list[str]:
    return [t for block in page for t in (*block.text.split(" "), MARK)]


def sketch(stream: list[str]) -> tuple[int, ...]:
    """128 bits of a page's tokens as two numbers, then KEYS least hashes of its runs of three words.

    Near-equal pages have equal least hashes, each with a chance of the share of
    runs they have in common.
    """
    whole = xxhash.xxh3_128_digest(" ".join(stream).encode("utf-8", "surrogatepass"))
    hashes = _token_hashes([t for t in stream if t != MARK])
    runs = hashes[:-2] * MIX + hashes[1:-1] if len(hashes) > 2 else hashes.copy()
    runs = runs * MIX + hashes[2:] if len(hashes) > 2 else runs
    runs ^= runs >> np.uint64(29)
    least = [int(((runs ^ (runs >> np.uint64(32))) * f + g).min()) if len(runs) else 0 for f, g in FACTORS]
    return tuple(x - 2**64 if x >= 2**63 else x for x in (int.from_bytes(whole[:8]), int.from_bytes(whole[8:]), *least))


def _token_hashes(tokens) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in tokens], np.uint64)


def weights(sketches: list[tuple[int, ...]]) -> list[int]:
    """By how many of its least hashes a text counts: the one with the least sketch of those with an equal hash."""
    out = dict.fromkeys(sketches, 0)
    for t in range(2, 2 + KEYS):
        least: dict[int, tuple[int, ...]] = {}
        for own in out:
            least[own[t]] = min(own, least.get(own[t], own))
        for own in least.values():
            out[own] += 1
    return [out[own] for own in sketches]


def boilerplate(weight: np.ndarray, total: int) -> np.ndarray:
    """Whether the texts with a passage, ``weight`` together, are enough of all, ``total`` together."""
    return (weight >= MIN_TEXTS * KEYS) & (weight * SHARE[1] >= total * SHARE[0])


def _passages(streams: list[list[str]], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all streams in a row, each followed by an end mark: a hash of the passage at each token, and if there is a whole one."""
    number, _, tokens, sizes = _sequence(streams)
    table = np.append(_token_hashes(number), np.zeros(len(streams), np.uint64))
    padded = np.append(table[tokens], np.zeros(run, np.uint64))
    out = np.zeros(len(tokens), np.uint64)
    for k in range(run):
        out = out * MIX + padded[k : k + len(tokens)]
    out ^= out >> np.uint64(32)
    left = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1) - np.arange(len(tokens))
    return out * MIX, left >= run


def shard_candidates(streams: list[list[str]], weight: list[int], run: int = RUN) -> np.ndarray:
    """Hashes of the passages that a shard's distinct texts have in the share that makes boilerplate."""
    number, _, tokens, sizes = _sequence(streams)
    if not len(tokens):
        return np.empty(0, np.uint64)
    rank = _ranks(tokens, len(number), run)
    weighed = _carriers(rank, np.repeat(np.arange(len(streams)), sizes + 1), np.array([weight]))[0]
    often = (weighed > 0) & (weighed * SHARE[1] >= sum(weight) * SHARE[0])
    hashes, whole = _passages(streams, run)
    return np.unique(hashes[whole & often[rank]])


def held_candidates(streams: list[list[str]], named: list[np.ndarray], run: int = RUN) -> list[np.ndarray]:
    """Of each text's passages, the distinct ones among those named."""
    hashes, whole = _passages(streams, run)
    sizes = np.array([len(s) for s in streams], np.int64)
    out = []
    for own, valid, wanted in zip(_cut(hashes, sizes), _cut(whole, sizes), named, strict=True):
        out.append(np.intersect1d(own[valid], wanted))
    return out


def decides(page: list[Block]) -> bool:
    """Whether boilerplate can change a page's text."""
    return any(b.unsure for b in page) or not any(b.main for b in page)


def page_texts(pages: list[list[Block]], often: list[np.ndarray], run: int = RUN) -> list[str]:
    """Main text of pages, each with the hashes of its host's boilerplate."""
    use = [k for k, page in enumerate(pages) if decides(page) and len(often[k])]
    streams = [stream_of(pages[k]) for k in use]
    sizes = np.array([len(s) for s in streams], np.int64)
    covered = {}
    if use:
        hashes, whole = _passages(streams, run)
        for k, own, valid in zip(use, _cut(hashes, sizes), _cut(whole, sizes), strict=True):
            covered[k] = _cover(valid & np.isin(own, often[k]), run)
    out = []
    for k, page in enumerate(pages):
        article, texts, at = any(b.main for b in page), [], 0
        for block in page:
            here = slice(at, at + block.text.count(" ") + 1)
            at = here.stop + 1
            if article and not block.main:
                continue
            if k in covered and (block.unsure or not article) and covered[k][here].all():
                continue
            texts.append(block.text)
        out.append("\n\n".join(texts))
    return out


def host_boilerplate(shards: list[list[list[str]]], run: int = RUN) -> np.ndarray:
    """Hashes of a host's boilerplate, from the token streams of its pages; the three steps of :func:`main_text` in one."""
    sketches = {sketch(s): (n, s) for n, shard in enumerate(shards) for s in shard}
    weight = dict(zip(sketches, weights(list(sketches)), strict=True))
    total = sum(weight.values())
    named = [np.empty(0, np.uint64)]
    for n in range(len(shards)):
        own = [(s, weight[key]) for key, (at, s) in sketches.items() if at == n and weight[key]]
        named.append(shard_candidates([s for s, _ in own], [w for _, w in own], run))
    wanted = np.unique(np.concatenate(named))
    sums: Counter[int] = Counter()
    for key, (_, stream) in sketches.items():
        for found in held_candidates([stream], [wanted], run):
            sums.update(dict.fromkeys(found.tolist(), 0))
            for value in found.tolist():
                sums[value] += weight[key]
    values = np.array(sorted(sums), np.uint64)
    return values[boilerplate(np.array([sums[int(v)] for v in values], np.int64), total)] if len(values) else values


def _squeeze(text: str) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8) + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unsqueeze(packed: bytes) -> str:
    size = int.from_bytes(packed[:8])
    return pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass")


def _to_bytes(page: list[Block]) -> bytes:
    return _squeeze("\n".join(f"{b.main + 2 * b.unsure}{b.text}" for b in page))


def _from_bytes(packed: bytes) -> list[Block]:
    text = _unsqueeze(packed)
    return [Block(b[1:], b[0] in "13", b[0] in "23") for b in text.split("\n")] if text else []


def _by_host(rows: DataFrame, hashes: DataFrame, how: str) -> DataFrame:
    """Rows with the hashes of their host; broadcast where they were measured to be small."""
    size = hashes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("hashes") * 8 + 64), F.lit(0)).alias("bytes")).first()
    return join_measured(rows, hashes, "host", how, row_bytes=-(-size.bytes // max(1, size.n)), rows=size.n)


def main_text(pages: DataFrame, shard_tokens: int = SHARD_TOKENS, run: int = RUN) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^/]*//([^/?#]*)", 1)), F.lit(""))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    keys = [f"k{t}" for t in range(KEYS)]
    names = ["blocks", "decides", "n_tokens", "t1", "t2", *keys]

    def parse(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [blocks(html) for html in rows.column(2).to_pylist()]
        streams = [stream_of(page) for page in found]
        sketches = np.array([sketch(s) for s in streams], np.int64).reshape(-1, 2 + KEYS)
        columns = [
            pa.array(map(_to_bytes, found), pa.binary()), pa.array(map(decides, found), pa.bool_()),
            pa.array([len(s) for s in streams], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([*rows.columns[:2], *columns, *map(pa.array, sketches.T.copy())], ["page_id", "url", *names])

    longs = ", ".join(f"{name} long" for name in names[2:])
    parsed = by_batch(given, parse, f"page_id long, url string, blocks binary, decides boolean, {longs}")
    placed = stored(parsed.withColumns({"host": host, "row": F.monotonically_increasing_id()}), "html-blocks")

    # One row for each distinct text, with its weight; near copies of others weigh nothing and need not be looked at.
    ident = ["host", "t1", "t2"]
    texts = stored(
        placed.groupBy(*ident).agg(F.min("row").alias("row"), F.min("n_tokens").alias("n_tokens"), *(F.min(k).alias(k) for k in keys)),
        "html-texts",
    )
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.col(k).alias("key")) for t, k in enumerate(keys))))
    least = F.min(F.struct("t1", "t2")).alias("least")
    weighed = (
        texts.select("host", "t1", "t2", each.alias("k")).groupBy("host", "k.t", "k.key").agg(least)
        .groupBy("host", "least.t1", "least.t2").agg(F.count("*").alias("weight"))
    )
    weighed = stored(texts.select(*ident, "row", "n_tokens").join(weighed, ident), "html-weights")
    hosts = stored(
        weighed.groupBy("host").agg(
            F.sum("weight").alias("total"), F.ceil((F.sum("n_tokens") + 1) / shard_tokens).cast("long").alias("shards")
        ),
        "html-hosts",
    )
    placing = F.pmod(F.xxhash64("t1", "t2"), "shards").alias("shard")
    chosen = stored(
        join_measured(weighed, hosts.select("host", "shards"), "host", row_bytes=64).select("row", placing, "weight"), "html-chosen"
    )
    looked_at = join_measured(placed.select("row", "host", "blocks"), chosen, "row", row_bytes=32).drop("row")

    def name(table: pa.Table) -> pa.Table:
        streams = [stream_of(_from_bytes(b)) for b in table["blocks"].to_pylist()]
        found = shard_candidates(streams, table["weight"].to_pylist(), run)
        return pa.table([pa.repeat(table["host"][0], len(found)), pa.array(found.view(np.int64))], ["host", "hash"])

    named = looked_at.groupBy("host", "shard").applyInArrow(name, "host string, hash long").distinct()
    named = stored(named.groupBy("host").agg(F.collect_list("hash").alias("hashes")), "html-candidates")

    def weigh(rows: pa.RecordBatch) -> pa.RecordBatch:
        hosts, blocks_, weight, wanted = (rows.column(rows.schema.get_field_index(n)) for n in ("host", "blocks", "weight", "hashes"))
        sets = [np.array(h, np.int64).view(np.uint64) for h in wanted.to_pylist()]
        found = held_candidates([stream_of(_from_bytes(b)) for b in blocks_.to_pylist()], sets, run)
        sums: Counter[tuple[str, int]] = Counter()
        for own, times, values in zip(hosts.to_pylist(), weight.to_pylist(), found, strict=True):
            for value in values.view(np.int64).tolist():
                sums[own, value] += times
        columns = [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64()), pa.array([*sums.values()], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["host", "hash", "weight"])

    sums = by_batch(_by_host(looked_at, named, "inner"), weigh, "host string, hash long, weight long")
    sums = sums.groupBy("host", "hash").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= MIN_TEXTS * KEYS)
    enough = F.col("weight") * SHARE[1] >= F.col("total") * SHARE[0]
    often = join_measured(sums, hosts.select("host", "total"), "host", row_bytes=64).filter(enough)
    often = stored(often.groupBy("host").agg(F.collect_list("hash").alias("hashes")), "html-boilerplate")

    def finish(rows: pa.RecordBatch) -> pa.RecordBatch:
        own = [_from_bytes(b) for b in rows.column(2).to_pylist()]
        sets = [np.array(h or [], np.int64).view(np.uint64) for h in rows.column(3).to_pylist()]
        texts = page_texts(own, sets, run)
        columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays([*rows.columns[:2], *columns], ["page_id", "url", "text", "n_chars"])

    last = _by_host(placed.select("page_id", "url", "blocks", "decides", "host"), often, "left")
    last = last.select("page_id", "url", "blocks", F.when(F.col("decides"), F.col("hashes")).alias("hashes"))
    return by_batch(last, finish, "page_id long, url string, text string, n_chars long")
