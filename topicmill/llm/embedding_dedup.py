"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from random projections and is refined: at each node the
neighbours (and sampled reverse neighbours) are compared with each other, and each
keeps the best it has met. A list that is full of near-duplicates is enlarged, up to
`MOST_NEIGHBOURS`. Beyond that a list may hold its own group only and miss links to
other groups; so groups with such lists are contracted to their centres, which go
through the same descent, and neighbouring groups are searched for links between
the members nearest to each other. An audit compares a bounded sample of vectors
with all others exactly. Rounds go on until no component changes and the audit is
passed; if it never is, that is an error. Edges that reach the threshold in double
precision form the components.

Direct links of large groups are counted without all pairs: with the angles a and
b of two vectors to their component's centre, a + b within the threshold's angle
means linked, and |a - b| beyond it means not linked. Counts of angles per cell
settle almost all pairs; the pairs left are compared exactly.

Equal vectors are one node with a weight. Search runs on half-precision copies of
the unit vectors; what is reported is checked in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicmill.llm.components import components
from topicmill.session import stage

THRESHOLD = 0.9
NEIGHBOURS = 10
MOST_NEIGHBOURS = 64
REVERSE = 6
MOST_ROUNDS = 12
# Projections that start the graph, and vectors compared in one run of their order.
TABLES, RUN = 4, 128
# The audit's sample: this many vectors at most, whatever the table's size.
AUDIT = 400
RECALL = 0.97
# Below this recall there is no result but an error.
LEAST_RECALL = 0.9
# Members of two neighbouring groups that are compared, nearest to the other group first.
FACING = 32
# Angle cells per right angle, and the margin that rounding may need.
CELLS, MARGIN = 4096, 1e-6
SEED = 31


def valid_vector(vec: Column) -> Column:
    """Not null or empty, all components finite, not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _units(rows: DataFrame) -> DataFrame:
    """(id, unit) of valid rows (id, vec): unit vectors in double precision."""

    def run(batches):
        for batch in batches:
            found = []
            for vec in batch.column(1):
                x = np.asarray(vec.values, np.float64)
                x = x / np.abs(x).max()  # so that squares stay finite
                found.append(x / np.sqrt((x * x).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["id", "unit"])

    return rows.mapInArrow(run, "id long, unit array<double>")


def _nodes(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors as (node, weight, unit), and (id, node) of valid rows.

    A node is the smallest id of its vector."""
    rows = vectors.where(F.col(id_col).isNotNull() & valid_vector(F.col(vec_col)) & (F.size(vec_col) == dims))
    rows = _units(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col)))
    rows = rows.withColumns({f"_h{s}": F.xxhash64(F.lit(s), "unit") for s in (1, 2)})
    groups = rows.groupBy("_h1", "_h2").agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    members = stage(rows.select("id", "_h1", "_h2").join(groups, ["_h1", "_h2"]).select("id", "node", "weight"), "vector_nodes")
    first = rows.dropDuplicates(["id", "_h1", "_h2"]).select("id", "unit")
    once = members.where("id = node").dropDuplicates(["node"])
    nodes = once.join(first, "id").dropDuplicates(["node"]).select("node", "weight", "unit")
    return stage(nodes, "vectors"), members


def _halves(nodes: DataFrame) -> DataFrame:
    """(node, half): the unit vector in half precision, as bytes."""

    def run(batches):
        for batch in batches:
            found = [np.asarray(u.values, np.float64).astype(np.float16).tobytes() for u in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "half"])

    return stage(nodes.select("node", "unit").mapInArrow(run, "node long, half binary"), "half_vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py(), np.float16) for x in column]).astype(np.float32)


def _groups(batches, most: int):
    """Consecutive rows with one value in column 0, at most `most` at a time."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, final: bool):
        keys = np.asarray(table.column(0))
        stops = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
        at = 0
        for i, stop in enumerate(stops):
            if i == len(stops) - 1 and not final and stop - at < most:
                break
            for begin in range(at, stop, most):
                yield table.slice(begin, min(most, stop - begin))
            at = stop
        cut.rest = table.slice(at)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            yield from cut(pa.Table.from_batches(held).combine_chunks(), False)
            held = cut.rest.combine_chunks().to_batches() if cut.rest.num_rows else []
    if held:
        yield from cut(pa.Table.from_batches(held).combine_chunks(), True)


_EDGE = "src long, dst long, sim float"


def _edge_batch(src, dst, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(src.astype(np.int64)), pa.array(dst.astype(np.int64)), pa.array(sim.astype(np.float32))], ["src", "dst", "sim"]
    )


def _best_pairs(ids: np.ndarray, vectors: np.ndarray, count: int, floor: np.ndarray | None = None):
    """The `count` most similar others of each row, above the row's floor."""
    sims = vectors @ vectors.T
    sims[ids[:, None] == ids[None, :]] = -2.0
    count = min(count, len(ids) - 1)
    if count < 1:
        none = np.empty(0)
        return none, none, none
    top = np.argpartition(-sims, count - 1, axis=1)[:, :count]
    row = np.repeat(np.arange(len(ids)), count)
    col = top.ravel()
    keep = sims[row, col] > (-2.0 if floor is None else floor[row])
    return ids[row[keep]], ids[col[keep]], sims[row[keep], col[keep]]


def _start(halves: DataFrame, neighbours: int) -> DataFrame:
    """First edges: vectors compared within runs of the order of a projection."""

    def keys(batches):
        for batch in batches:
            vectors = _matrix(batch.column(1))
            rng = np.random.Generator(np.random.PCG64(SEED))
            planes = rng.standard_normal((TABLES, 13, vectors.shape[1])).astype(np.float32)
            for t in range(TABLES):
                shade = vectors @ planes[t].T
                code = (shade[:, :12] > 0) @ (1 << np.arange(12)) + (t << 12)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.astype(np.int64)), pa.array(shade[:, 12].astype(np.float64)), batch.column(0), batch.column(1)],
                    ["code", "shade", "node", "half"],
                )

    def compare(batches):
        for part in _groups(batches, RUN):
            yield _edge_batch(*_best_pairs(np.asarray(part.column(2)), _matrix(part.column(3)), neighbours))

    coded = halves.mapInArrow(keys, "code long, shade double, node long, half binary")
    return coded.repartition("code").sortWithinPartitions("code", "shade", "node").mapInArrow(compare, _EDGE)


def _kept(edges: DataFrame, lists: DataFrame | None, neighbours: int) -> DataFrame:
    """The best edges of each node, as many as its list may hold.

    `lists` is (src, room) of enlarged lists."""
    best = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    ranked = best.withColumn("place", place).where(F.col("place") <= MOST_NEIGHBOURS)
    if lists is None:
        return ranked.where(F.col("place") <= neighbours).drop("place")
    ranked = ranked.join(lists, "src", "left")
    return ranked.where(F.col("place") <= F.coalesce("room", F.lit(neighbours))).drop("place", "room")


def _refined(graph: DataFrame, halves: DataFrame, neighbours: int) -> DataFrame:
    """Candidate edges from comparing the neighbours at each node."""
    rank = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(F.xxhash64("src", "dst")))
    # A node that very many have as neighbour takes part with a sample of them:
    # they meet at their other neighbours, too. No edge is lost by it.
    back = graph.withColumn("_r", rank("dst")).where(F.col("_r") <= REVERSE).select(F.col("dst").alias("centre"), F.col("src").alias("node"))
    ahead = graph.withColumn("_r", rank("src")).where(F.col("_r") <= 2 * neighbours).select(F.col("src").alias("centre"), F.col("dst").alias("node"))
    own = graph.select(F.col("src").alias("centre"), F.col("src").alias("node"))
    met = ahead.union(back).union(own).distinct()
    floor = graph.groupBy(F.col("src").alias("node")).agg(F.min("sim").alias("floor"), F.count("*").alias("held"))
    floor = floor.select("node", F.when(F.col("held") >= neighbours, F.least("floor", F.lit(THRESHOLD - 0.02))).otherwise(F.lit(-2.0)).cast("float").alias("floor"))
    rows = met.join(halves.join(floor, "node", "left"), "node").select("centre", "node", F.coalesce("floor", F.lit(-2.0)).cast("float").alias("floor"), "half")

    def compare(batches):
        for part in _groups(batches, 512):
            ids = np.asarray(part.column(1))
            yield _edge_batch(*_best_pairs(ids, _matrix(part.column(3)), 4, np.asarray(part.column(2))))

    return rows.repartition("centre").sortWithinPartitions("centre", "node").mapInArrow(compare, _EDGE)


def _checked(edges: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(src, dst) of edges whose cosine in double precision reaches the threshold."""
    pairs = edges.where(F.col("sim") >= threshold - 0.01)
    pairs = pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    one = nodes.select(F.col("node").alias("src"), F.col("unit").alias("u"))
    two = nodes.select(F.col("node").alias("dst"), F.col("unit").alias("v"))
    return pairs.join(one, "src").join(two, "dst").where(cosine("u", "v") >= threshold).select("src", "dst")


def cosine(u: str, v: str) -> Column:
    """Dot product of unit vectors, in double precision."""
    return F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _dims(vectors: DataFrame, vec_col: str) -> int:
    """The commonest length of valid vectors, of equally common ones the smallest."""
    sizes = vectors.where(valid_vector(F.col(vec_col))).groupBy(F.size(vec_col).alias("n")).agg(F.count("*").alias("c"))
    first = sizes.orderBy(F.desc("c"), "n").first()
    return first["n"] if first else 0


def _centres(inside: DataFrame, dims: int) -> DataFrame:
    """(component, centre): normed sums of rows (component, unit), null for a sum of zero."""
    sums = inside.groupBy("component").agg(*[F.sum(F.col("unit")[i]).alias(f"_{i}") for i in range(dims)])
    centre = sums.select("component", F.array(*[F.col(f"_{i}") for i in range(dims)]).alias("_sum"))
    centre = centre.withColumn("_norm", F.sqrt(F.aggregate("_sum", F.lit(0.0), lambda acc, x: acc + x * x)))
    return centre.select("component", F.when(F.col("_norm") > 0, F.transform("_sum", lambda x: x / F.col("_norm"))).alias("centre"))


def _angle(one: str, two: str) -> Column:
    return F.acos(F.greatest(F.least(cosine(one, two), F.lit(1.0)), F.lit(-1.0)))


def _bridges(nodes: DataFrame, graph: DataFrame, labels: DataFrame, threshold: float, neighbours: int, dims: int) -> DataFrame | None:
    """Edges (src, dst, sim) between components whose members' lists are full of each
    other; None where there is at most one such component."""
    if not dims:
        return None
    full = graph.groupBy("src").agg(F.count("*").alias("held"), F.min("sim").alias("worst"))
    full = full.where((F.col("held") >= MOST_NEIGHBOURS) & (F.col("worst") >= threshold)).select(F.col("src").alias("node"))
    crowded = full.join(labels, "node").select("component").distinct()
    inside = stage(nodes.join(labels, "node").join(crowded, "component", "left_semi"), "crowded_groups")
    centres = _centres(inside, dims).where("centre is not null")
    reach = inside.join(centres, "component").groupBy("component", "centre").agg(F.max(_angle("unit", "centre")).alias("radius"))
    reach = stage(reach, "group_centres")
    if reach.count() < 2:
        return None
    # The groups' own neighbour graph, by the same descent.
    halves = _halves(reach.select(F.col("component").alias("node"), F.col("centre").alias("unit")))
    near = stage(_kept(_start(halves, neighbours), None, neighbours), "group_neighbours")
    for _ in range(2):
        near = stage(_kept(near.union(_refined(near, halves, neighbours)), None, neighbours), "group_neighbours")
    one = reach.select(F.col("component").alias("src"), F.col("centre").alias("u"), F.col("radius").alias("r"))
    two = reach.select(F.col("component").alias("dst"), F.col("centre").alias("v"), F.col("radius").alias("q"))
    pairs = near.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    close = pairs.join(one, "src").join(two, "dst").where(_angle("u", "v") <= F.lit(math.acos(threshold)) + F.col("r") + F.col("q") + MARGIN)
    close = stage(close.select("src", "dst"), "close_groups")

    # Of either group the members nearest to the other one's centre.
    sides = close.select("src", "dst", F.col("src").alias("own"), F.col("dst").alias("other"))
    sides = sides.union(close.select("src", "dst", F.col("dst").alias("own"), F.col("src").alias("other")))
    members = inside.select(F.col("component").alias("own"), "node", "unit")
    facing = sides.join(members, "own").join(reach.select(F.col("component").alias("other"), "centre"), "other")
    facing = facing.withColumn("towards", cosine("unit", "centre"))
    place = F.row_number().over(Window.partitionBy("src", "dst", "own").orderBy(F.desc("towards"), "node"))
    facing = facing.withColumn("_p", place).where(F.col("_p") <= FACING)
    pair = F.xxhash64("src", "dst").alias("pair")
    rows = facing.select(pair, (F.col("own") == F.col("src")).alias("first"), "node", "unit")

    def compare(batches):
        for part in _groups(batches, 2 * FACING):
            first = np.asarray(part.column(1).combine_chunks())
            ids = np.asarray(part.column(2))
            units = np.asarray(part.column(3).combine_chunks().values, np.float64).reshape(len(ids), -1)
            sims = units[first] @ units[~first].T
            row, col = np.nonzero(sims >= threshold - 0.01)
            yield _edge_batch(ids[first][row], ids[~first][col], sims[row, col])

    return rows.repartition("pair").sortWithinPartitions("pair", "first", "node").mapInArrow(compare, _EDGE)


def audit(nodes: DataFrame, labels: DataFrame, threshold: float, sample: int) -> tuple[int, int]:
    """Links of sampled vectors by brute force, and how many of them lie within
    one component of `labels` (node, component)."""
    # A bounded number of vectors goes to the driver and to all tasks.
    chosen = nodes.orderBy(F.xxhash64("node", F.lit(SEED))).limit(sample).select("node", "unit").collect()
    if not chosen:
        return 0, 0
    ids = np.array([r.node for r in chosen])
    matrix = np.array([r.unit for r in chosen])
    shared = nodes.sparkSession.sparkContext.broadcast((ids, matrix))

    def run(batches):
        ids, matrix = shared.value
        for batch in batches:
            others = np.asarray(batch.column(0))
            units = np.asarray(batch.column(1).values, np.float64).reshape(len(others), -1)
            for at in range(0, len(others), 2000):
                sims = units[at : at + 2000] @ matrix.T
                row, col = np.nonzero(sims >= threshold)
                src, dst = others[at + row], ids[col]
                keep = src != dst
                yield _edge_batch(dst[keep], src[keep], sims[row, col][keep])

    found = nodes.select("node", "unit").mapInArrow(run, _EDGE)
    a = labels.select(F.col("node").alias("src"), F.col("component").alias("c1"))
    b = labels.select(F.col("node").alias("dst"), F.col("component").alias("c2"))
    row = found.join(a, "src", "left").join(b, "dst", "left").agg(F.count("*"), F.count(F.when(F.col("c1") == F.col("c2"), 1))).first()
    return row[0], row[1]


def _link_counts(nodes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(node, links): weights of other nodes of its component with cosine at or
    above the threshold."""
    limit = math.acos(threshold)
    inside = stage(nodes.join(labels, "node"), "linked_vectors")
    dims = inside.agg(F.max(F.size("unit"))).first()[0]
    if not dims:
        return inside.select("node", F.lit(0).cast("long").alias("links"))
    centre = _centres(inside, dims)
    # acos of a rounded cosine is good to some 1e-8 near 0; the margin covers it.
    angle = F.coalesce(_angle("unit", "centre"), F.lit(math.pi / 2))
    placed = inside.join(centre, "component").select("component", "node", "weight", "unit", angle.alias("angle"))
    placed = stage(placed.withColumn("cell", F.floor(F.col("angle") * CELLS / (math.pi / 2))), "vector_angles")
    cells = placed.groupBy("component", "cell").agg(F.sum("weight").alias("w"))
    # At most 2 * CELLS rows per component: whatever it holds.
    within = F.sum("w").over(Window.partitionBy("component").orderBy("cell"))
    cells = cells.select("component", "cell", within.alias("within"), F.lead("cell").over(Window.partitionBy("component").orderBy("cell")).alias("next"))
    # The last cell that lies wholly within reach of a vector.
    reach = F.floor((F.lit(limit - MARGIN) - F.col("angle")) * CELLS / (math.pi / 2)) - 1
    wide = placed.groupBy("component").agg(F.max("angle").alias("widest"), F.max("cell").alias("last"), F.sum("weight").alias("total"))
    rows = placed.drop("unit").join(wide, "component").withColumn("reach", F.least(reach, F.col("last")))
    all_in = F.col("angle") + F.col("widest") <= limit - MARGIN
    settled = rows.where(all_in).select("component", "node", "weight", "angle", F.col("total").alias("sure"), F.lit(2 * CELLS).cast("long").alias("reach"))
    part = rows.where(~all_in)
    counted = part.join(
        cells.withColumnsRenamed({"component": "_c", "cell": "last_cell"}),
        F.expr("component = _c and last_cell <= reach and (next is null or next > reach)"),
        "left",
    )
    counted = counted.select("component", "node", "weight", "angle", F.coalesce("within", F.lit(0)).alias("sure"), "reach")
    # Only pairs that the angles leave open are compared.
    open_rows = counted.select("component", "node", F.col("angle").alias("a"), "reach").join(placed.select("node", F.col("unit").alias("u")), "node")
    others = placed.select("component", F.col("node").alias("other"), F.col("weight").alias("other_weight"), F.col("angle").alias("b"), "cell", F.col("unit").alias("v"))
    pairs = open_rows.join(others, "component").where((F.col("cell") > F.col("reach")) & (F.abs(F.col("a") - F.col("b")) <= limit + MARGIN) & (F.col("node") != F.col("other")))
    more = pairs.where(cosine("u", "v") >= threshold).groupBy("node").agg(F.sum("other_weight").alias("more"))
    # A row's own weight is among the sure ones if its own cell is within reach.
    own = F.when(F.floor(F.col("angle") * CELLS / (math.pi / 2)) <= F.col("reach"), F.col("weight")).otherwise(F.lit(0))
    every = settled.unionByName(counted).withColumn("own", own)
    return every.join(more, "node", "left").select("node", (F.col("sure") - F.col("own") + F.coalesce("more", F.lit(0))).cast("long").alias("links"))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    neighbours: int = NEIGHBOURS,
    least_recall: float = RECALL,
) -> DataFrame:
    """One row per row of `vectors`: id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing; neither do vectors of another length than most valid ones have.
    Rows that repeat an id are one vector each, with the id's component. Rows
    without id link with nothing; their component is null and they are kept. An
    empty table stays empty. A recall below `LEAST_RECALL` in the audit is an error.
    """
    dims = _dims(vectors, vec_col)
    nodes, members = _nodes(vectors, id_col, vec_col, dims)
    halves = _halves(nodes)
    graph = stage(_kept(_start(halves, neighbours), None, neighbours), "neighbours")
    before, bridged = None, None
    for _ in range(MOST_ROUNDS):
        lists = graph.groupBy("src").agg(F.count("*").alias("held"), F.min("sim").alias("worst"))
        # Full of near-duplicates: the list may hold twice as many.
        full = (F.col("worst") >= threshold) & (F.col("held") >= neighbours)
        larger = F.least(2 * F.col("held"), F.lit(MOST_NEIGHBOURS))
        room = lists.select("src", F.when(full, larger).otherwise(F.greatest("held", F.lit(neighbours))).alias("room"))
        refined = graph.union(_refined(graph, halves, neighbours))
        graph = stage(_kept(refined, stage(room, "list_room"), neighbours), "neighbours")
        linked = _checked(graph, nodes, threshold)
        labels = stage(components(linked if bridged is None else linked.union(bridged)), "vector_components")
        now = labels.agg(F.count("*"), F.sum("component")).first()
        changed, before = now != before, now
        if changed:
            continue
        # Lists have settled: what may be missing are links between crowded groups.
        edges = _bridges(nodes, graph, labels, threshold, neighbours, dims)
        if edges is not None:
            more = stage(_checked(edges, nodes, threshold), "group_links")
            bridged = more if bridged is None else bridged.union(more)
            labels = stage(components(linked.union(bridged)), "vector_components")
            before = labels.agg(F.count("*"), F.sum("component")).first()
            if before != now:
                continue
        true, found = audit(nodes, labels, threshold, AUDIT)
        if found >= least_recall * true:
            break
    else:
        true, found = audit(nodes, labels, threshold, AUDIT)
        if found < LEAST_RECALL * true:
            raise RuntimeError(f"{found} of {true} links of sampled vectors found: recall below {LEAST_RECALL}")
    links = stage(_link_counts(nodes, labels, threshold), "vector_links")
    named = members.join(links, "node", "left").join(labels, "node", "left")
    named = named.select(
        F.col("id").alias("_id"),
        # Equal vectors link with each other, too.
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        F.coalesce("component", "node").alias("component"),
    ).groupBy("_id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    own = F.col(id_col).cast("long")
    good = valid_vector(F.col(vec_col)) & (F.size(vec_col) == dims)
    joined = vectors.select(F.col(id_col), F.when(good, own).alias("_key")).join(named, F.col("_key") == F.col("_id"), "left")
    component = F.coalesce("component", own)
    return joined.select(
        F.col(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == own, F.lit(True)).alias("kept"),
    )
