"""Hard negatives by cover trees over norm-augmented candidates.

A vector's components are floored to whole 256ths, so inner products are whole
numbers. Every candidate x gets one more component, sqrt(M^2 - |x|^2) with M the
largest norm, which puts all candidates on a sphere of radius M; an anchor gets a
zero there, so its products stay what they are. For a point of a node, whose centre
is c and whose covering radius is r, the angle to an anchor lies within
2 asin(r / 2M) of the centre's, which bounds its product from both sides.

1. The upper levels are a net of at most PIVOTS points, spread over a sample of
   SAMPLE_ROWS rows farthest first and put in an order that keeps neighbours
   together. Every row belongs to its nearest point, its cell.
2. In that order rows are cut into trees of about TREE_ROWS rows and anchors into
   blocks of about BLOCK_ANCHORS, so a cell of any size is many trees, and many
   small cells are one. Each tree is built in one task, level by level: a node's
   points are covered by balls of a radius smaller by SHRINK, until they are few or
   no ball covers many.
3. A block visits a tree only if the bounds of a cell in it leave a chance. In the
   tree it descends best first: nodes whose bounds miss the windows of all anchors of the
   block, or can't beat what these hold, are skipped, and the rest is verified by exact
   products. A first visit to the trees of the anchors' own cells gives each window a
   least product to beat, then the other trees follow.
4. Two such searches: positives (same label, no window, first POSITIVES), then for
   each positive the negatives (other label, in its window, first NEGATIVES).

The net, the cells' radii and counts, at most PIVOTS rows each, are all that reaches
the driver. Blocks and trees meet in a join by tree, so a task holds one of each.
Anchors times trees is the worst case, in blocks; near-random vectors come close to it.

Cases: rows with a null label, a null vector, or a component that is null, NaN or
infinite take no part, as do vectors whose floored components have a norm of 2^31
or more, since no 64-bit number holds their products. A null vec_id is no anchor, keeps
its label and comes last among ties. Vectors of unequal length are filled with zeros;
an empty vector has products of zero. Rows that repeat are rows of their own: each is
a candidate, and an anchor's equals are among its positives. Of a negative positive
product, no window exists. Empty tables and tables without anchors give no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import stored

PIVOTS = 128
SAMPLE_ROWS = 4096
TREE_ROWS = 512
BLOCK_ANCHORS = 128
LEAF = 32
SHRINK = 1.3
POSITIVES = 5
NEGATIVES = 10
# A window is from LOW / 10 to HIGH / 10 of the positive's product.
LOW, HIGH = 3, 9
ANCHOR_EVERY = 100
# Pairs of a block and a tree that one Arrow batch holds.
PAIRS = 32
SLACK = 1e-6  # of the norms' product, so that rounding never cuts a point off
EXACT = 2.0**53  # whole numbers below it are exact as doubles
LIMIT = 2.0**62

POINT = "struct<r: bigint, vec_id: bigint, label: bigint, vec: array<double>>"
HIT = "q bigint, w int, score bigint, r bigint, vec_id bigint"


def by_arrow(frame: DataFrame, function, schema: str, rows: int | None = None) -> DataFrame:
    """Apply a function to every Arrow batch, stored at once so that ``rows`` a batch hold for this job alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = frame.sparkSession.conf
    before = conf.get(name)
    if rows:
        conf.set(name, str(rows))
    try:
        return stored(frame.mapInArrow(lambda batches: (out for b in batches for out in function(b)), schema), "hard-negatives")
    finally:
        conf.set(name, before)


def candidates(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vec`` of the rows that take part, components as whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = rows.select("vec_id", "label", "embedding").filter(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10)))
    vec = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    large = F.exists("embedding", lambda x: F.abs(x.cast("double")) >= 2.0**31)
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    plain = kept.filter(~large).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(moved, F.col("label").cast("long")).alias("label"), vec.alias("vec")
    )
    return plain.withColumn("square", square).filter(F.col("square") < LIMIT)


# --- the net ------------------------------------------------------------------


def matrix(vectors: list, width: int | None = None) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    width = max((len(v) for v in vectors), default=0) if width is None else width
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def augmented(points: np.ndarray, norm: float) -> np.ndarray:
    rest = np.maximum(norm**2 - np.einsum("ij,ij->i", points, points), 0.0)
    return np.column_stack([points, np.sqrt(rest)])


def spread(points: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the points, farthest first, then in the order of a walk over the net's tree.

    A point's parent is the nearest of those chosen before it; children follow their parent.
    """
    if not len(points):
        return points
    chosen, parent, near = [0], [-1], np.zeros(len(points), int)
    distance = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and distance.max() > 0:
        far = int(distance.argmax())
        parent.append(int(near[far]))
        chosen.append(far)
        new = np.linalg.norm(points - points[far], axis=1)
        near[new < distance] = len(chosen) - 1
        distance = np.minimum(distance, new)
    children: list[list[int]] = [[] for _ in chosen]
    for child, above in enumerate(parent):
        if above >= 0:
            children[above].append(child)
    walk, open_ = [], [0]
    while open_:
        node = open_.pop()
        walk.append(node)
        open_ += reversed(children[node])
    return points[[chosen[n] for n in walk]]


@dataclass(frozen=True)
class Net:
    """Cells in order: their points, the largest norm, and by cell the covering radius and the counts."""

    points: np.ndarray
    norm: float
    width: int
    radius: np.ndarray | None = None
    rows: np.ndarray | None = None
    anchors: np.ndarray | None = None

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance of each vector."""
        lifted = augmented(vectors, self.norm)
        square = np.einsum("ij,ij->i", self.points, self.points) - 2 * lifted @ self.points.T
        cell = square.argmin(axis=1)
        return cell, np.linalg.norm(lifted - self.points[cell], axis=1)

    def trees(self, cell: int) -> range:
        """Numbers of the trees that hold rows of a cell."""
        before = int(self.rows[:cell].sum())
        return range(before // TREE_ROWS, (before + int(self.rows[cell]) - 1) // TREE_ROWS + 1)


def bounds(anchors: np.ndarray, centre: np.ndarray, radius: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each anchor with a point of each ball on the sphere."""
    length = np.linalg.norm(anchors, axis=1)[:, None]
    whole = length * norm
    # Anchors have no component where candidates are augmented.
    cosine = np.divide(anchors @ centre[:, : anchors.shape[1]].T, whole, out=np.zeros((len(anchors), len(centre))), where=whole > 0)
    angle = np.arccos(np.clip(cosine, -1, 1))
    width = 2 * np.arcsin(np.clip(radius / (2 * norm) if norm else radius * 0, 0, 1))[None, :]
    slack = SLACK * (whole + 1)
    return whole * np.cos(np.minimum(angle + width, np.pi)) - slack, whole * np.cos(np.maximum(angle - width, 0)) + slack


# --- trees --------------------------------------------------------------------


def build(points: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, float, int, int]]]:
    """The order of the points and the nodes: centre, first and last point, radius, first and last child.

    A node's children are next to each other, and so are its points. A node without
    children is verified point by point.
    """
    order = np.arange(len(points))
    nodes: list = []
    waiting = [(0, len(points), 0)] if len(points) else []
    nodes += [None] * len(waiting)
    for number in itertools.count():
        if number >= len(nodes):
            return order, nodes
        first, last, centre = waiting[number]
        own = order[first:last]
        distance = np.linalg.norm(points[own] - points[centre], axis=1)
        radius = float(distance.max())
        balls: list[tuple[int, np.ndarray]] = []
        if len(own) > LEAF and radius > 0:
            rest, from_centre = own, distance
            middle = centre
            while len(rest) and len(balls) <= len(own) // 8:
                near = from_centre <= radius / SHRINK
                balls.append((middle, rest[near]))
                rest = rest[~near]
                if len(rest):
                    middle = int(rest[0])
                    from_centre = np.linalg.norm(points[rest] - points[middle], axis=1)
            if len(rest) or len(balls) < 2:  # the balls cover too few points each: a level more would save nothing
                balls = []
        begin = len(nodes)
        at = first
        for middle, inside in balls:
            order[at : at + len(inside)] = inside
            waiting.append((at, at + len(inside), middle))
            nodes.append(None)
            at += len(inside)
        nodes[number] = (centre, first, last, radius, begin, len(nodes))


NODES = np.dtype([("centre", "<i8"), ("first", "<i8"), ("last", "<i8"), ("radius", "<f8"), ("begin", "<i8"), ("end", "<i8")])


def plant(net: Net):
    """A batch of collected trees, built: points in tree order and the nodes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for tree, points in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            points.sort(key=lambda p: p["r"])
            vectors = matrix([p["vec"] for p in points], net.width)
            order, nodes = build(augmented(vectors, net.norm))
            place = np.argsort(order)
            found = np.array([(place[c], *rest) for c, *rest in nodes], NODES)
            ids = [points[i]["vec_id"] for i in order]
            known = np.array([i is not None for i in ids])
            head = np.array(
                [[points[i]["r"] for i in order], [0 if i is None else i for i in ids], [points[i]["label"] for i in order], known], np.int64
            )
            cells = [[tree], [head.tobytes()], [vectors[order].tobytes()], [found.tobytes()]]
            types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], ["tree", "head", "points", "nodes"])

    return run


def descend(
    head: np.ndarray, points: np.ndarray, nodes: np.ndarray, norm: float, vectors: np.ndarray, own: np.ndarray, label: np.ndarray,
    anchor: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, same: bool, most: int,
) -> list[tuple[int, int, int, int, int]]:
    """The first ``most`` points of a tree in each window, as (window, product, row, vec_id, id is known).

    ``anchor`` says whose window it is; ``low`` and ``high`` are its ends, ``least``
    is a product below which nothing is wanted. ``same`` asks for the anchor's label
    without its own row, otherwise for other labels.
    """
    lifted = augmented(points, norm)
    whole = points.astype(np.int64) if norm**2 >= EXACT else points
    asked = vectors.astype(np.int64) if norm**2 >= EXACT else vectors
    rows, ids, labels, known = head
    held: list[np.ndarray] = [np.empty((0, 2), np.int64)] * len(anchor)  # product and place, best first
    beat = np.maximum(low.astype(float), least.astype(float))
    low_bound, high_bound = (b[anchor] for b in bounds(vectors, lifted[nodes["centre"]], nodes["radius"], norm))
    wanted = lambda n, w: w[(high_bound[w, n] >= beat[w]) & (low_bound[w, n] <= high[w])]
    everyone = np.arange(len(anchor))
    heap = [(0.0, 0, everyone)]
    ties = np.lexsort((ids, 1 - known))  # of equal products the smaller id comes first, none last
    rank = np.empty(len(ids), np.int64)
    rank[ties] = np.arange(len(ids))
    while heap:
        _, node, windows = heapq.heappop(heap)
        windows = wanted(node, windows)
        if not len(windows):
            continue
        _, first, last, _, begin, end = nodes[node]
        if end > begin:
            for child in range(begin, end):
                some = wanted(child, windows)
                if len(some):
                    heapq.heappush(heap, (-float(high_bound[some, child].max()), child, some))
            continue
        mine = anchor[windows]
        asking, at = np.unique(mine, return_inverse=True)
        product = (whole[first:last] @ asked[asking].T).T.astype(np.int64)[at]
        equal = labels[first:last][None, :] == label[mine][:, None]
        fits = (equal & (rows[first:last][None, :] != own[mine][:, None])) if same else ~equal
        fits &= (product >= low[windows][:, None]) & (product <= high[windows][:, None]) & (product >= least[windows][:, None])
        for k in np.flatnonzero(fits.any(axis=1)):
            place = np.flatnonzero(fits[k])
            new = np.column_stack([product[k, place], place + first])
            best = np.concatenate([held[windows[k]], new])
            best = best[np.lexsort((rank[best[:, 1]], -best[:, 0]))][:most]
            held[windows[k]] = best
            if len(best) == most:
                beat[windows[k]] = max(beat[windows[k]], float(best[-1, 0]))
    return [
        (w, int(product), int(rows[p]), int(ids[p]), int(known[p])) for w, best in enumerate(held) for product, p in best
    ]


# --- searches -----------------------------------------------------------------

BLOCK = f"block bigint, asked array<struct<point: {POINT}, cell: int, windows: array<struct<w: int, low: bigint, high: bigint, least: bigint>>>>"


def _windows(asked: list[dict]) -> tuple[np.ndarray, ...]:
    anchor = np.array([i for i, a in enumerate(asked) for _ in a["windows"]], int)
    ends = [np.array([w[name] for a in asked for w in a["windows"]], np.int64) for name in ("low", "high", "least")]
    return anchor, *ends


def route(net: Net, home: bool):
    """The trees that each block has to visit: those of its anchors' own cells, or the others that its bounds leave."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        blocks = batch.column(0).to_pylist()
        trees = []
        for asked in batch.column(1).to_pylist():
            cells = {a["cell"] for a in asked}
            near = {t for c in cells for t in net.trees(c)}
            if not home:
                anchor, low, high, least = _windows(asked)
                below, above = (b[anchor] for b in bounds(matrix([a["point"]["vec"] for a in asked], net.width), net.points, net.radius, net.norm))
                chance = (above >= np.maximum(low, least)[:, None]) & (below <= high[:, None])
                near = {t for c in np.flatnonzero(chance.any(axis=0) & (net.rows > 0)) for t in net.trees(c)} - near
            trees.append(sorted(near))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(trees, pa.list_(pa.int64()))], ["block", "trees"])

    return run


def visit(net: Net, same: bool, most: int):
    """What the windows of a block find in a tree."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, w, score, row, vec_id = [], [], [], [], []
        columns = [batch.column(batch.schema.get_field_index(n)) for n in ("asked", "head", "points", "nodes")]
        for asked, head, points, nodes in zip(*(c.to_pylist() for c in columns), strict=True):
            anchor, low, high, least = _windows(asked)
            heads = np.frombuffer(head, np.int64).reshape(4, -1)
            found = descend(
                heads, np.frombuffer(points).reshape(heads.shape[1], net.width), np.frombuffer(nodes, NODES), net.norm,
                matrix([a["point"]["vec"] for a in asked], net.width), np.array([a["point"]["r"] for a in asked], np.int64),
                np.array([a["point"]["label"] for a in asked], np.int64), anchor, low, high, least, same, most,
            )
            names = [window["w"] for a in asked for window in a["windows"]]
            for window, product, r, id_, known in found:
                q.append(asked[anchor[window]]["point"]["r"])
                w.append(names[window])
                score.append(product)
                row.append(r)
                vec_id.append(id_ if known else None)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip((q, w, score, row, vec_id), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["q", "w", "score", "r", "vec_id"])

    return run


def _first(hits: DataFrame, most: int) -> DataFrame:
    """The first hits of each window, with their rank."""
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "r")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def search(net: Net, trees: DataFrame, asked: DataFrame, same: bool, most: int) -> DataFrame:
    """The first ``most`` rows in every window of ``asked`` (block, point, cell, windows), ranked from 1."""

    def round_(asking: DataFrame, home: bool) -> DataFrame:
        blocks = stored(
            asking.groupBy("block").agg(F.collect_list(F.struct("point", "cell", "windows")).alias("asked")), "hard-negatives-blocks"
        )
        routed = by_arrow(blocks, route(net, home), "block bigint, trees array<bigint>", PAIRS)
        pairs = blocks.join(routed.select("block", F.explode("trees").alias("tree")), "block").join(trees, "tree")
        return by_arrow(pairs.select("asked", "head", "points", "nodes"), visit(net, same, most), HIT, PAIRS)

    near = stored(_first(round_(asked, True), most).drop("rank"), "hard-negatives-near")
    # A window that is full by now asks only for products at least as high as its last.
    full = near.groupBy("q", "w").agg(F.count("*").alias("held"), F.min("score").alias("last")).filter(F.col("held") >= most)
    known = full.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "last"))).alias("last_of"))
    raised = F.transform(
        "windows",
        lambda x: F.struct(x["w"], x["low"], x["high"], F.coalesce(F.try_element_at("last_of", x["w"]), x["least"]).alias("least")),
    )
    again = asked.join(known, F.col("point")["r"] == F.col("q"), "left").withColumn("windows", raised).drop("q", "last_of")
    return _first(near.unionByName(round_(again, False)), most)


def hard_negatives(rows: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """For every anchor and each of its positives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` holds vec_id, label and embedding; ``is_anchor`` is a condition on vec_id.
    """
    spark = rows.sparkSession
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    points = candidates(rows)
    size = points.agg(F.max("square").alias("square"), F.max(F.size("vec")).alias("width")).first()
    norm, width = float(size.square or 0.0) ** 0.5, int(size.width or 0)
    # By a hash of the row, not of the vector: copies must not fill the sample.
    drawn = points.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(SAMPLE_ROWS).select("vec").collect()
    net = Net(spread(augmented(matrix([d.vec for d in drawn], width), norm), PIVOTS), norm, width)

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = matrix(batch.column("vec").to_pylist(), net.width)
        cell, distance = net.nearest(vectors) if len(vectors) else (np.empty(0), np.empty(0))
        yield batch.append_column("cell", pa.array(cell.astype(np.int32))).append_column("distance", pa.array(distance))

    numbered = points.select(F.monotonically_increasing_id().alias("r"), "vec_id", "label", "vec")
    schema = "r bigint, vec_id bigint, label bigint, vec array<double>, cell int, distance double"
    placed = by_arrow(numbered, place, schema).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False)))
    cells = placed.groupBy("cell").agg(F.max("distance"), F.count("*"), F.count_if("is_anchor")).collect()
    radius, counts, anchors = np.zeros(len(net.points)), np.zeros(len(net.points), int), np.zeros(len(net.points), int)
    for cell, far, n, asking in cells:
        radius[cell], counts[cell], anchors[cell] = far, n, asking
    net = Net(net.points, norm, width, radius, counts, anchors)

    def cut(counts: np.ndarray, each: int) -> Column:
        """The run of ``each`` rows that a row falls into, in the order of the cells."""
        before = F.array(*[F.lit(int(n)) for n in np.cumsum(counts) - counts] or [F.lit(0)])
        many = F.array(*[F.lit(max(1, int(n))) for n in counts] or [F.lit(1)])
        at = F.get(before, F.col("cell")) + F.pmod(F.xxhash64("r"), F.get(many, F.col("cell")))
        return F.floor(at / F.lit(each)).cast("long")

    point = F.struct("r", "vec_id", "label", "vec")
    collected = placed.groupBy(cut(counts, TREE_ROWS).alias("tree")).agg(F.collect_list(point).alias("points"))
    trees = by_arrow(collected, plant(net), "tree bigint, head binary, points binary, nodes binary", PAIRS)

    asking = placed.filter("is_anchor").select(cut(anchors, BLOCK_ANCHORS).alias("block"), point.alias("point"), "cell")
    lowest, highest = F.lit(-(2**62)), F.lit(2**62)
    whole = F.array(F.struct(F.lit(0).alias("w"), lowest.alias("low"), highest.alias("high"), lowest.alias("least")))
    found = stored(
        search(net, trees, asking.withColumn("windows", whole), True, positives).select(
            F.col("q").alias("anchor"), F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "hard-negatives-positives",
    )
    # LOW * score <= 10 * x <= HIGH * score, in whole numbers that don't overflow.
    wide = F.col("positive_score").cast("decimal(20,0)")
    ends = F.struct(
        "w", F.call_function("div", wide * LOW + 9, F.lit(10)).alias("low"), F.call_function("div", wide * HIGH, F.lit(10)).alias("high"),
        lowest.alias("least"),
    )
    windows = found.filter("positive_score >= 0").groupBy("anchor").agg(F.collect_list(ends).alias("windows"))
    asking = asking.join(windows, F.col("point")["r"] == F.col("anchor")).drop("anchor")
    negative = search(net, trees, asking, False, negatives)
    named = placed.filter("is_anchor").select(F.col("r").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    result = negative.withColumnRenamed("q", "anchor").join(found, ["anchor", "w"]).join(named, "anchor")
    return result.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
