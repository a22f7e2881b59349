"""Embedding near-duplicates by NN-descent: refined neighbour lists, exact joins of large components, audited recall."""
from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, saved
from bazaar.llm.graph import connected_components

_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("cos", pa.float64())])
log = logging.getLogger(__name__)


def _matrix(table: pa.Table, col: str) -> np.ndarray:
    flat = table[col].combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, -1)


def unit_nodes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(node, space, copies, unit): the distinct comparable vectors of each label.

    Comparable: id and label not null, vector not empty, whole, finite and
    with a positive finite norm.  Equal vectors of a label are one node, its
    smallest id.  ``space`` hashes label and length; only its nodes compare.
    """
    v = F.col(vec_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ok)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("vec")).distinct())
    rows = rows.withColumn("top", F.array_max(F.transform("vec", F.abs))).where("top > 0")
    scaled = F.transform("vec", lambda x: x / F.col("top"))               # no overflow in the squares
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.withColumn("scaled", scaled).withColumn("norm", norm)
    return rows.select("id", F.xxhash64("label", F.size("vec")).alias("space"),
                       F.transform("scaled", lambda x: x / F.col("norm")).alias("unit"))


def _leaves(trees: int, depth: int, seed: int):
    """Assign each node its leaf in ``trees`` random-hyperplane trees."""
    def assign(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            t = pa.Table.from_batches([batch])
            nodes, spaces = t["node"].to_numpy(), t["space"].to_numpy()
            sizes = np.diff(t["unit"].combine_chunks().offsets.to_numpy())
            out = []
            flat, ends = t["unit"].combine_chunks().flatten().to_numpy(), np.cumsum(sizes)
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                m = flat[(ends[own] - d)[:, None] + np.arange(d)]
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((d, trees * max(depth, 1)))
                bits = (m @ planes[d] > 0).reshape(len(own), trees, -1)[:, :, :depth]
                code = bits @ (1 << np.arange(depth, dtype=np.int64)) if depth else np.zeros((len(own), trees), np.int64)
                for tree in range(trees):
                    out.append((np.full(len(own), tree, np.int64), code[:, tree].astype(np.int64), spaces[own], nodes[own]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["tree", "leaf", "space", "node"])
    return assign


def _local_join(keep: int):
    """All pairs of a group: for each node its ``keep`` nearest that beat the node's floor."""
    def join(table: pa.Table) -> pa.Table:
        node, floor, m = table["node"].to_numpy(), table["floor"].to_numpy(), _matrix(table, "unit")
        n = len(node)
        if n < 2:
            return _EDGE.empty_table()
        cos = np.clip(m @ m.T, -1.0, 1.0)
        np.fill_diagonal(cos, -2.0)
        k = min(keep, n - 1)
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(cos, near, axis=1)
        rows, cols = np.nonzero(value > floor[:, None])
        return pa.table([pa.array(node[rows]), pa.array(node[near[rows, cols]]), pa.array(value[rows, cols])], schema=_EDGE)
    return join


def _tile_links(least: float):
    def count(table: pa.Table) -> pa.Table:
        node, side, copies, m = (table["node"].to_numpy(), table["side"].to_numpy(zero_copy_only=False),
                                 table["copies"].to_numpy(), _matrix(table, "unit"))
        rows, cols = np.flatnonzero(side), np.flatnonzero(~side)
        n = np.zeros(len(rows), dtype=np.int64)
        for lo in range(0, len(rows), 512):
            part = rows[lo:lo + 512]
            linked = (m[part] @ m[cols].T >= least) & (node[part][:, None] != node[cols][None, :])
            n[lo:lo + 512] = linked @ copies[cols]
        return pa.table([pa.array(node[rows]), pa.array(n)], names=["node", "n"])
    return count


def _best(edges: DataFrame, size) -> DataFrame:
    """The nearest ``size`` (number or column) neighbours of each node; repeated pairs once."""
    once = edges.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.max("turn").alias("turn"), F.max("size").alias("size"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.col("cos").desc(), "v"))
    return once.withColumn("r", rank).where(F.col("r") <= F.col("size")).drop("r")


def neighbour_lists(nodes: DataFrame, least: float, size: int, trees: int, leaf_rows: int, turns: int,
                    seed: int) -> DataFrame:
    """Directed neighbour lists (u, v, cos) after ``turns`` rounds of NN-descent.

    Start: the nearest neighbours inside the leaves of random-hyperplane
    trees; an oversized leaf is split by hash.  A round gathers, per pivot,
    its list and a hashed sample of those that list it, joins these locally,
    and keeps pairs that beat either list.  A list whose last member still
    reaches ``least`` is saturated: its size doubles for the next round.
    """
    n = nodes.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf_rows))))
    placed = saved(nodes.select("node", "space", "unit").mapInArrow(
        _leaves(trees, depth, seed), "tree long, leaf long, space long, node long"), "leaves")
    place = ["space", "tree", "leaf"]
    parts = placed.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / (2 * leaf_rows)).cast("int").alias("parts"))
    placed = placed.join(parts, place).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    rows = placed.join(nodes.select("node", "unit"), "node").withColumn("floor", F.lit(-1.5))
    found = rows.groupBy(*place, "part").applyInArrow(_local_join(size), "u long, v long, cos double")
    found = found.withColumn("turn", F.lit(0)).withColumn("size", F.lit(size))
    lists = saved(_best(found, size), "lists")
    for turn in range(1, turns + 1):
        state = lists.groupBy("u").agg(F.count(F.lit(1)).alias("k"), F.min("cos").alias("low"), F.max("size").alias("size"))
        full = F.col("k") >= F.col("size")
        state = saved(state.select(
            F.col("u").alias("node"),
            F.when(full & (F.col("low") >= least), 2 * F.col("size")).otherwise(F.col("size")).alias("size"),
            F.when(full & (F.col("low") < least), F.col("low")).otherwise(-1.5).alias("floor")), "state")
        fresh = F.col("turn") == turn - 1
        both = lists.select(F.col("u").alias("pivot"), F.col("v").alias("node"), fresh.alias("new")).union(
            lists.select(F.col("v").alias("pivot"), F.col("u").alias("node"), fresh.alias("new")))
        # a sample of each side of a pivot, fresh neighbours first
        both = both.groupBy("pivot", "node").agg(F.max("new").alias("new"))
        draw = Window.partitionBy("pivot").orderBy(F.col("new").desc(), F.xxhash64(F.lit(seed + turn), "pivot", "node"))
        both = both.withColumn("r", F.row_number().over(draw)).where(F.col("r") <= 2 * size)
        active = both.groupBy("pivot").agg(F.max("new").alias("any")).where("any").select("pivot")
        member = both.select("pivot", "node").join(active, "pivot", "left_semi")
        member = member.union(active.select("pivot", F.col("pivot").alias("node")))
        rows = (member.join(nodes.select("node", "unit"), "node").join(state.select("node", "floor"), "node", "left")
                .select("pivot", "node", "unit", F.coalesce("floor", F.lit(-1.5)).alias("floor")))
        new = rows.groupBy("pivot").applyInArrow(_local_join(2 * size), "u long, v long, cos double")
        # an old pair keeps the turn that found it
        old = lists.select("u", "v", "cos", F.col("turn"), F.lit(False).alias("is_new"))
        pairs = (old.union(new.select("u", "v", "cos", F.lit(turn), F.lit(True))).groupBy("u", "v")
                 .agg(F.max("cos").alias("cos"), F.min("turn").alias("turn")))
        sized = pairs.join(state.select(F.col("node").alias("u"), "size"), "u", "left")
        lists = saved(_best(sized.withColumn("size", F.coalesce("size", F.lit(size))), size), "lists")
    return lists.select("u", "v", "cos")


def linked_counts(nodes: DataFrame, component: DataFrame, least: float, tile_rows: int) -> DataFrame:
    """(node, n): copies of other nodes of its component that each node links with, by matrix tiles.

    A component is cut into blocks of about ``tile_rows``; each pair of
    blocks is one tile that yields one count per row, never the pairs.
    """
    sizes = component.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("blocks"))
    member = (component.join(sizes, "component").join(nodes, "node")
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cols = ["component", "node", "copies", "unit"]
    row = member.select(*cols, F.col("own").alias("i"), F.col("other").alias("j"), F.lit(True).alias("side"))
    col = member.select(*cols, F.col("other").alias("i"), F.col("own").alias("j"), F.lit(False).alias("side"))
    tiles = row.union(col).groupBy("component", "i", "j").applyInArrow(_tile_links(least), "node long, n long")
    return tiles.groupBy("node").agg(F.sum("n").alias("n"))


def _near_balls(least: float):
    """The (node, ball) of a tile whose angle lets a member of the ball reach ``least`` with the node."""
    reach = float(np.arccos(np.clip(least, -1.0, 1.0))) + 1e-6
    schema = pa.schema([("node", pa.int64()), ("ball", pa.int64())])

    def near(table: pa.Table) -> pa.Table:
        node, own, wide, ball, radius, m = (table["node"].to_numpy(), table["own"].to_numpy(),
                                            table["wide"].to_numpy(zero_copy_only=False), table["ball"].to_numpy(),
                                            table["radius"].to_numpy(), _matrix(table, "unit"))
        rows, cols = np.flatnonzero(ball < 0), np.flatnonzero(ball >= 0)
        out = [np.zeros((2, 0), dtype=np.int64)]
        for lo in range(0, len(rows), 512):
            part = rows[lo:lo + 512]
            angle = np.arccos(np.clip(m[part] @ m[cols].T, -1.0, 1.0))
            # two balls meet once: the members of the later one are compared with the earlier
            meets = (angle <= radius[cols] + reach) & np.where(wide[part][:, None], own[part][:, None] > own[cols], own[part][:, None] != own[cols])
            i, j = np.nonzero(meets)
            out.append(np.stack([node[part[i]], own[cols[j]]]))
        return pa.table(list(map(pa.array, np.concatenate(out, axis=1))), schema=schema)
    return near


def _first_links(least: float):
    """For each candidate of a tile that reaches ``least`` with one of its members: one such pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def first(table: pa.Table) -> pa.Table:
        node, side, m = table["node"].to_numpy(), table["side"].to_numpy(zero_copy_only=False), _matrix(table, "unit")
        rows, cols = np.flatnonzero(side), np.flatnonzero(~side)
        out = [np.zeros((2, 0), dtype=np.int64)]
        for lo in range(0, len(rows) if len(cols) else 0, 512):
            part = rows[lo:lo + 512]
            linked = m[part] @ m[cols].T >= least
            hit = np.flatnonzero(linked.any(axis=1))
            out.append(np.stack([node[part[hit]], node[cols[linked[hit].argmax(axis=1)]]]))
        return pa.table(list(map(pa.array, np.concatenate(out, axis=1))), schema=schema)
    return first


def cross_links(nodes: DataFrame, component: DataFrame, least: float, above: int, tile_rows: int) -> DataFrame:
    """(a, b): links that join a component of more than ``above`` nodes with a node outside it, exact.

    Each such component is a ball around its smallest node; by the triangle
    inequality of angles only nodes near the ball can link with a member, and
    these are compared with all its members by tiles.  A node yields one link
    per component at most.  ``above`` = 0 leaves no link between components.
    """
    owner = nodes.join(component, "node", "left").select("node", "space", "unit", F.coalesce("component", "node").alias("own"))
    sizes = owner.groupBy("own").agg(F.count(F.lit(1)).alias("n"))
    owner = saved(owner.join(sizes, "own").withColumn("wide", F.col("n") > above), "owners")
    wide = owner.where("wide")
    centre = wide.where("node = own").select("own", F.col("unit").alias("centre"), F.explode(
        F.sequence(F.lit(0), F.floor(F.col("n") / tile_rows))).alias("salt"))
    salt = F.pmod(F.xxhash64("node"), F.floor(F.col("n") / tile_rows) + 1)
    dot = F.aggregate(F.zip_with("unit", "centre", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    radius = (wide.withColumn("salt", salt).join(centre, ["own", "salt"])
              .groupBy("own").agg(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.min(dot)))).alias("radius")))
    balls = saved(wide.where("node = own").join(radius, "own").select("space", "own", "radius", "unit"), "balls")

    block = 4 * tile_rows
    tiles = (owner.groupBy("space").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("ni"))
             .join(balls.groupBy("space").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("nj")), "space"))
    def part(col, of):
        return F.pmod(F.xxhash64(col), F.col(of)).cast("int")
    def every(of):
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    x = owner.join(tiles, "space").select("space", part("node", "ni").alias("i"), every("nj").alias("j"), "node", "own", "wide",
                                          F.lit(-1).cast("long").alias("ball"), F.lit(0.0).alias("radius"), "unit")
    y = balls.join(tiles, "space").select("space", every("ni").alias("i"), part("own", "nj").alias("j"), F.col("own").alias("node"), "own",
                                          F.lit(True).alias("wide"), F.lit(0).cast("long").alias("ball"), "radius", "unit")
    near = saved(x.union(y).groupBy("space", "i", "j").applyInArrow(_near_balls(least), "node long, ball long"), "near")

    counts = near.groupBy("ball").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("ni"))
    counts = counts.join(sizes.select(F.col("own").alias("ball"), F.ceil(F.col("n") / tile_rows).cast("int").alias("nj")), "ball")
    asked = near.join(counts, "ball").join(nodes.select("node", "unit"), "node")
    inside = wide.select(F.col("own").alias("ball"), "node", "unit").join(counts, "ball")
    x = asked.select("ball", part("node", "ni").alias("i"), every("nj").alias("j"), "node", F.lit(True).alias("side"), "unit")
    y = inside.select("ball", every("ni").alias("i"), part("node", "nj").alias("j"), "node", F.lit(False).alias("side"), "unit")
    return x.union(y).groupBy("ball", "i", "j").applyInArrow(_first_links(least), "a long, b long")


def audit_recall(nodes: DataFrame, component: DataFrame, counts: DataFrame, least: float, sample: int, size: int,
                 seed: int) -> float:
    """Mean share of its true links that a linked node has, the lower one of two groups of nodes.

    The groups are the nodes in components of more than ``size`` nodes and all
    others, so a hot component does not hide lost links of small ones.
    Sampled by smallest seeded hashes are ``sample`` nodes of the first group,
    ``sample`` linked ones of the second and four times as many unlinked ones,
    weighted by how many nodes each stands for.  The sampled vectors are sent
    to the tasks, which compare them with every node of their space in blocks.
    """
    sizes = component.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("n") > size, "large").when(F.col("n") > 1, "small").otherwise("single")
    kinds = component.join(sizes, "component").select("node", kind.alias("kind"))
    grouped = saved(nodes.join(kinds, "node", "left").withColumn("kind", F.coalesce("kind", F.lit("single"))), "audited")
    many = {r["kind"]: r["n"] for r in grouped.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_space: dict[tuple, tuple] = {}
    weights: dict[int, tuple] = {}
    for name, most in (("large", sample), ("small", sample), ("single", 4 * sample)):
        asked = (grouped.where(F.col("kind") == name).orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(most)
                 .select("node", "space", "unit").collect() if name in many else [])
        for r in asked:
            got = by_space.setdefault((r["space"], len(r["unit"])), ([], []))
            got[0].append(r["node"]), got[1].append(r["unit"])
            weights[r["node"]] = name == "large", many[name] / len(asked)
    by_space = {k: (np.array(a), np.array(b)) for k, (a, b) in by_space.items()}
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64())])

    def compare(batches):
        total = {k: np.zeros(len(ids), dtype=np.int64) for k, (ids, _) in by_space.items()}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                t = pa.Table.from_batches([batch.slice(lo, 1024)])
                spaces = t["space"].to_numpy()
                for (space, d), (ids, units) in by_space.items():
                    own = t.filter(pa.array(spaces == space))
                    if own.num_rows:
                        cos = units @ _matrix(own, "unit").T
                        linked = (cos >= least) & (ids[:, None] != own["node"].to_numpy()[None, :])
                        total[space, d] += linked @ own["copies"].to_numpy()
        for k, (ids, _) in by_space.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[k])], schema=schema)

    true = grouped.select("node", "space", "copies", "unit").mapInArrow(compare, "node long, n long")
    true = true.groupBy("node").agg(F.sum("n").alias("t")).where("t > 0")
    linked, had = {True: 0.0, False: 0.0}, {True: 0.0, False: 0.0}
    for r in true.join(counts, "node", "left").select("node", "t", F.coalesce("n", F.lit(0)).alias("n")).collect():
        large, weight = weights[r["node"]]
        linked[large] += weight
        had[large] += weight * min(r["n"], r["t"]) / r["t"]
    return min([had[k] / linked[k] for k in linked if linked[k]], default=1.0)


def embedding_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                         label_col: str = "label", size: int = 6, trees: int = 6, leaf_rows: int = 256, turns: int = 2,
                         tile_rows: int = 1024, sample: int = 512, recall: float = 0.99, max_tries: int = 3,
                         seed: int = 23) -> DataFrame:
    """Links of cosine ``least`` or more between vectors of one label, by NN-descent.

    Returns the id, n_links (other vectors linked with it), component_id
    (smallest id reachable by links) and kept (id = component_id).

    Equal vectors are one node with copies.  NN-descent gives neighbour lists;
    their pairs at ``least`` or more make components, and inside a component
    every pair is compared by tiles.  A node whose list is saturated lies in a
    component of more than ``size`` nodes; these are compared with all nodes
    outside that can link with them, so saturated lists lose no link.  The
    recall per sampled node is audited against brute force; below ``recall``
    the search is repeated with twice the trees and list size and one more
    turn, and the new pairs are added.  If ``max_tries`` do not reach it, every
    component is compared with all nodes outside: exact.  Vectors that
    are null, empty, zero or hold null or non-finite components, and null
    labels, link with nothing; null ids keep a row of their own with null
    component; repeated rows count once and each keep a row.
    """
    prepared(vectors.sparkSession)
    units = saved(unit_nodes(vectors, id_col, vec_col, label_col), "units")
    key = ["space", "unit"]
    nodes = saved(units.groupBy(*key).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")
    links, counts, component = None, None, None

    def join(new: DataFrame, above: int) -> None:
        """Add links; components that a saturated list may have split (more than ``above`` nodes) are joined exactly."""
        nonlocal links, component
        links = new if links is None else links.union(new)
        component = connected_components(links)
        across = saved(cross_links(nodes, component, least, above, tile_rows), "across")
        if across.take(1):
            links = links.union(across)
            component = connected_components(links)

    for attempt in range(max_tries):
        lists = neighbour_lists(nodes, least, size << attempt, trees << attempt, leaf_rows, turns + attempt, seed + 100 * attempt)
        new = lists.where(F.col("cos") >= least).select(F.col("u").alias("a"), F.col("v").alias("b"))
        join(new, size)
        counts = saved(linked_counts(nodes, component, least, tile_rows), "counts")
        found = audit_recall(nodes, component, counts, least, sample, size, seed)
        if found >= recall:
            break
        log.warning("recall %.4f after attempt %d", found, attempt + 1)
    else:
        join(links, 0)
        counts = saved(linked_counts(nodes, component, least, tile_rows), "counts")
    per_node = (nodes.join(component, "node", "left").join(counts, "node", "left")
                .select(*key, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "node").alias("component_id")))
    linked = units.join(per_node, key).groupBy("id").agg(F.max("n_links").alias("n_links"),
                                                         F.min("component_id").alias("component_id"))
    ids = vectors.select(F.col(id_col).cast("long").alias(id_col))
    out = ids.join(linked.withColumnRenamed("id", id_col), id_col, "left")
    comp = F.coalesce("component_id", id_col)
    return out.select(id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(comp == F.col(id_col), F.lit(True)).alias("kept"))
