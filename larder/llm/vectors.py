"""Near-duplicate embeddings by NN-descent.

Equal vectors collapse to one node. A neighbour graph starts from blocks of
nodes that are close in random projections and is refined by joins of
neighbours of neighbours. Edges of at least the threshold, recomputed in double
precision, are links. A node whose whole list is links is saturated: its list
is enlarged to its connected group, whose members are compared block by block
and counted without writing the pairs out. Before that, saturated nodes of
different groups are compared wherever balls around them can hold a link, so
groups that link with each other become one. An audit against brute force
measures every pass's recall per node; where it is short, the next pass goes on
from the graph with orderings not tried before, and the last one with longer
lists too; a short last pass is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import components, materialise, pick, spread_join


@dataclass(frozen=True)
class DescentParams:
    """``threshold``: least cosine of a link; ``neighbours``: list length;
    ``projections``: orderings that start the graph; ``block``: nodes compared
    at once; ``rounds``: refinement rounds at most; ``settled``: share of new
    list entries at which refining ends; ``audit_rows``: nodes checked against
    all others (few of them may have links, and one miss among a handful of
    these would start a pass for nothing); ``recall``: least mean recall of a
    node's links; ``attempts``: passes at most, each with twice as many new
    projections as the one before, from the third on with twice the neighbours."""
    threshold: float = 0.9
    neighbours: int = 6
    projections: int = 4
    block: int = 256
    rounds: int = 3
    settled: float = 0.02
    audit_rows: int = 2048
    recall: float = 0.98
    attempts: int = 3
    seed: int = 5


def _units(rows: DataFrame) -> DataFrame:
    """``rid, vec_id, key, unit``: the unit vector's doubles and their hash;
    null for vectors that link with nothing."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            units = []
            for v in b.column("vec"):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
                    peak = np.abs(x).max()
                    x = x / peak if np.isfinite(peak) and peak > 0 else None  # a NaN makes the peak NaN
                units.append(None if x is None else (x / np.sqrt(x @ x) + 0.0).tobytes())
            yield pa.record_batch([b.column("rid"), b.column("vec_id"),
                                   pa.array([u and xxhash.xxh3_128_digest(u) for u in units], pa.binary()),
                                   pa.array(units, pa.binary())], names=["rid", "vec_id", "key", "unit"])

    return rows.mapInArrow(run, f"rid long, vec_id {kind}, key binary, unit binary")


def _pairs_batch(a, b, c) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["a", "b", "cos"])


def _nearest(ids: np.ndarray, vectors: list, k: int, bars: np.ndarray | None = None) -> tuple:
    """For each member the ``k`` most similar others, none below its bar: (a, b, cos) arrays."""
    out: list = [[], [], []]
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        m = np.frombuffer(b"".join(vectors[i] for i in at), np.float32).reshape(len(at), -1)
        own = ids[at]
        cos = m @ m.T
        cos[own[:, None] == own[None, :]] = -2
        n = min(k, len(at) - 1)
        if n < 1:
            continue
        best = np.argpartition(-cos, n - 1, axis=1)[:, :n]
        value = np.take_along_axis(cos, best, 1)
        good = value > -2 if bars is None else value >= bars[at][:, None]
        out[0].append(np.repeat(own, n)[good.ravel()])
        out[1].append(own[best].ravel()[good.ravel()])
        out[2].append(value.ravel()[good.ravel()].astype(np.float64))
    return tuple(np.concatenate(x) if x else np.empty(0) for x in out)


def _start(nodes: DataFrame, p: DescentParams, tried: int = 0) -> DataFrame:
    """First ``a, b, cos``: neighbours in blocks of nodes ordered by random
    projections, of which those numbered below ``tried`` were used before."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict = {}
        for b in batches:
            ids, units = b.column("node").to_numpy(), b.column("unit").to_pylist()
            for turn in range(tried, tried + p.projections):
                value = np.empty(len(units))
                code = np.empty(len(units), np.int64)
                for i, u in enumerate(units):
                    x = np.frombuffer(u, np.float64)
                    key = (turn, len(x))
                    if key not in planes:
                        planes[key] = np.random.default_rng([p.seed, turn, len(x)]).standard_normal((13, len(x)))
                    y = planes[key] @ x
                    code[i] = (y[1:] > 0) @ (1 << np.arange(12))
                    value[i] = y[0]
                code ^= code >> 1
                yield pa.record_batch([pa.array(np.full(len(units), turn, np.int32)), pa.array(code), pa.array(value), pa.array(ids),
                                       pa.array([np.frombuffer(u, np.float64).astype(np.float32).tobytes() for u in units], pa.binary())],
                                      names=["turn", "code", "value", "node", "unit"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = [], []
        for b in batches:
            ids += b.column("node").to_pylist()
            units += b.column("unit").to_pylist()
            while len(ids) >= 2 * p.block:
                yield _pairs_batch(*_nearest(np.array(ids[:p.block]), units[:p.block], p.neighbours))
                del ids[:p.block], units[:p.block]
        if ids:
            yield _pairs_batch(*_nearest(np.array(ids), units, p.neighbours))

    placed = nodes.select("node", "unit").mapInArrow(project, "turn int, code long, value double, node long, unit binary")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "turn", "code", "value").sortWithinPartitions("turn", "code", "value")
    return ordered.select("node", "unit").mapInArrow(blocks, "a long, b long, cos double")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """Each node's ``k`` best neighbours; a limit per task comes before the shuffle."""
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))
    return edges.groupBy("a", "b").agg(F.max("cos").alias("cos")).withColumn("place", place).filter(
        F.col("place") <= k).drop("place")


def _refine(graph: DataFrame, nodes: DataFrame, p: DescentParams) -> DataFrame:
    """Candidates ``a, b, cos`` among the neighbours and nearest reverse
    neighbours of every node (at most twice the list length and itself). Those
    below the last entry of a full list cannot enter it and are not written."""
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("cos"), "a"))
    back = graph.withColumn("place", place).filter(F.col("place") <= p.neighbours).select(
        F.col("b").alias("pivot"), F.col("a").alias("node"))
    own = nodes.select(F.col("node").alias("pivot"), "node")
    lists = graph.select(F.col("a").alias("pivot"), F.col("b").alias("node")).union(back).union(own).distinct()
    full = graph.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("cos").alias("last"))
    bar = F.when(F.col("n") >= p.neighbours, F.col("last")).otherwise(F.lit(-1.5)).alias("bar")  # any cosine is above -1.5
    barred = nodes.select("node", "unit32").join(full, "node", "left").select("node", "unit32", bar)
    lists = spread_join(lists, barred, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: list = []
        ids: list = []
        units: list = []
        bars: list = []

        def groups(last: bool):
            found: list = [[], [], []]
            cuts = np.flatnonzero(np.diff(np.array(pivots))) + 1 if pivots else np.empty(0, int)
            stop = [*cuts.tolist(), *([len(pivots)] if last else [])]
            begin = 0
            for end in stop:
                for x, y in zip(found, _nearest(np.array(ids[begin:end]), units[begin:end], p.neighbours, np.array(bars[begin:end])),
                                strict=True):
                    x.append(y)
                begin = end
            del pivots[:begin], ids[:begin], units[:begin], bars[:begin]
            return [np.concatenate(x) for x in found] if stop else None

        for b in batches:
            pivots += b.column("pivot").to_pylist()
            ids += b.column("node").to_pylist()
            units += b.column("unit32").to_pylist()
            bars += b.column("bar").to_pylist()
            got = groups(False)
            if got:
                yield _pairs_batch(*got)
        got = groups(True)
        if got:
            yield _pairs_batch(*got)

    return lists.select("pivot", "node", "unit32", "bar").repartition("pivot").sortWithinPartitions("pivot").mapInArrow(
        run, "a long, b long, cos double")


def _exact(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The undirected ``pairs (a, b)`` with a cosine of at least the threshold in doubles."""
    one = spread_join(pairs, nodes.select(F.col("node").alias("a"), F.col("unit").alias("ua")), "a")
    two = spread_join(one, nodes.select(F.col("node").alias("b"), F.col("unit").alias("ub")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) if len(x) == len(y) else -2.0
                   for x, y in zip(b.column("ua").to_pylist(), b.column("ub").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(np.array(cos, float) >= threshold, pa.bool_()))

    return two.select("a", "b", "ua", "ub").mapInArrow(run, "a long, b long")


def _group_counts(members: DataFrame, p: DescentParams) -> DataFrame:
    """``node, linked, distinct_linked`` of ``members (comp, node, unit, copies,
    size)``: every pair of a group is compared, block against block."""
    parts = F.ceil(F.col("size") / 512).cast("int")
    dealt = members.withColumn("g", parts).withColumn("i", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = dealt.select("comp", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "i", "node", "unit", "copies")

    def count(table: pa.Table) -> pa.Table:
        t = table.sort_by("node")
        node, side, copies = (t.column(x).to_numpy() for x in ("node", "i", "copies"))
        units = t.column("unit").to_pylist()
        size = np.array([len(u) for u in units])
        same = t.column("lo")[0].as_py() == t.column("hi")[0].as_py()
        linked, distinct = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            m = np.frombuffer(b"".join(units[k] for k in at), np.float64).reshape(len(at), -1)
            hit = m @ m.T >= p.threshold
            hit &= (np.eye(len(at)) == 0) if same else (side[at][:, None] != side[at][None, :])
            linked[at] = hit @ copies[at]
            distinct[at] = hit.sum(1)
        return pa.table({"node": node, "linked": linked, "distinct_linked": distinct})

    counted = dealt.groupBy("comp", "lo", "hi").applyInArrow(count, "node long, linked long, distinct_linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"), F.sum("distinct_linked").alias("distinct_linked"))


def _bridges(members: DataFrame, p: DescentParams) -> DataFrame:
    """Links ``a, b`` between groups of ``members (comp, node, unit)``: one for
    every two cells (up to about 512 nodes of one group) that have any. Cells
    lie in balls around their centres; by the triangle inequality of angles
    only balls close enough, and in them only nodes close enough to the other
    ball, can hold a link, and these are all compared."""
    reach = float(np.arccos(min(1.0, p.threshold))) + 1e-6
    sizes = members.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / 512).cast("int").alias("g"))
    cells = spread_join(members, sizes, "comp").select("comp", F.concat_ws(":", "comp", F.pmod(F.xxhash64("node"), F.col("g"))).alias("cell"),
                                                       "node", "unit")
    cells = materialise(cells, "vector-cells")

    def ball(table: pa.Table) -> pa.Table:
        m = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(table.num_rows, -1)
        centre = m.sum(0)
        size = np.sqrt(centre @ centre)
        centre = centre / size if size > 1e-9 else m[0]
        angle = float(np.arccos(np.clip(m @ centre, -1, 1)).max())
        return pa.table({"cell": [table.column("cell")[0].as_py()], "comp": pa.array([table.column("comp")[0].as_py()], pa.int64()),
                         "centre": pa.array([centre.tobytes()], pa.binary()), "angle": [angle]})

    balls = materialise(cells.groupBy("cell").applyInArrow(ball, "cell string, comp long, centre binary, angle double"), "vector-balls")
    parts = -(-balls.count() // 512)
    dealt = balls.withColumn("i", F.pmod(F.xxhash64("cell"), F.lit(parts)).cast("int")).withColumn(
        "o", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = dealt.withColumns({"lo": F.least("i", "o"), "hi": F.greatest("i", "o")}).drop("o")

    def meet(table: pa.Table) -> pa.Table:
        side, comp, angle = (table.column(x).to_numpy() for x in ("i", "comp", "angle"))
        cell, centres = table.column("cell").to_pylist(), table.column("centre").to_pylist()
        size = np.array([len(c) for c in centres])
        same = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        out: list = [[], []]
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            m = np.frombuffer(b"".join(centres[k] for k in at), np.float64).reshape(len(at), -1)
            near = np.arccos(np.clip(m @ m.T, -1, 1)) <= angle[at][:, None] + angle[at][None, :] + reach
            near &= comp[at][:, None] != comp[at][None, :]
            if not same:
                near &= side[at][:, None] != side[at][None, :]
            x, y = np.nonzero(near)
            out[0] += [cell[k] for k in at[x]]
            out[1] += [cell[k] for k in at[y]]
        return pa.table({"cell": pa.array(out[0], pa.string()), "other": pa.array(out[1], pa.string())})

    close = dealt.groupBy("lo", "hi").applyInArrow(meet, "cell string, other string")
    close = spread_join(close, balls.select(F.col("cell").alias("other"), "centre", "angle"), "other")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = np.array([np.frombuffer(u, np.float64) @ np.frombuffer(c, np.float64)
                            for u, c in zip(b.column("unit").to_pylist(), b.column("centre").to_pylist(), strict=True)], float)
            good = np.arccos(np.clip(cos, -1, 1)) <= b.column("angle").to_numpy() + reach
            yield b.select(["cell", "other", "node", "unit"]).filter(pa.array(good, pa.bool_()))

    asked = close.join(cells.select("cell", "node", "unit"), "cell").select("cell", "other", "node", "unit", "centre", "angle")
    asked = asked.mapInArrow(within, "cell string, other string, node long, unit binary").select(
        F.least("cell", "other").alias("lo"), F.greatest("cell", "other").alias("hi"), (F.col("cell") < F.col("other")).alias("first"),
        "node", "unit")

    def link(table: pa.Table) -> pa.Table:
        first, node = table.column("first").to_numpy(), table.column("node").to_numpy()
        units = table.column("unit").to_pylist()
        x, y = np.flatnonzero(first), np.flatnonzero(~first)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(x) and len(y):
            m, q = (np.frombuffer(b"".join(units[k] for k in at), np.float64).reshape(len(at), -1) for at in (x, y))
            hit = np.flatnonzero((m @ q.T >= p.threshold).ravel())[:1]
            a, b = node[x[hit // len(y)]], node[y[hit % len(y)]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return asked.groupBy("lo", "hi").applyInArrow(link, "a long, b long")


def _true_links(nodes: DataFrame, p: DescentParams) -> DataFrame:
    """``node, links``: the number of true links of ``audit_rows`` nodes, each
    compared with every node; those without any are left out."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(p.seed))).limit(p.audit_rows).select("node", "unit").collect()
    by_size: dict = {}
    for r in sample:
        by_size.setdefault(len(r[1]), []).append((r[0], bytes(r[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {size: (np.array([n for n, _ in some]), np.frombuffer(b"".join(u for _, u in some), np.float64).reshape(len(some), -1))
                 for size, some in by_size.items()}
        count = {size: np.zeros(len(ids), np.int64) for size, (ids, _) in asked.items()}
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                b = whole.slice(begin, 1024)
                own, units = b.column("node").to_numpy(), b.column("unit").to_pylist()
                for size, (ids, q) in asked.items():
                    at = [i for i, u in enumerate(units) if len(u) == size]
                    if at:
                        hit = q @ np.frombuffer(b"".join(units[i] for i in at), np.float64).reshape(len(at), -1).T >= p.threshold
                        count[size] += (hit & (ids[:, None] != own[at][None, :])).sum(1)
        for size, (ids, _) in asked.items():
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(count[size], pa.int64())], names=["node", "links"])

    found = nodes.select("node", "unit").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    return found.filter("links > 0")


def _audit(true: DataFrame, found: DataFrame) -> float:
    """Mean share of a node's true links that were found; 1 where there are none."""
    share = F.least("links", F.coalesce("distinct_linked", F.lit(0))) / F.col("links")
    mean = true.join(found.select("node", "distinct_linked"), "node", "left").agg(F.avg(share)).first()[0]
    return 1.0 if mean is None else mean


def _descend(nodes: DataFrame, p: DescentParams, graph: DataFrame | None = None, tried: int = 0) -> DataFrame:
    """The neighbour graph ``a, b, cos`` after one pass, which goes on from
    ``graph`` where a pass with the first ``tried`` orderings has left one."""
    first = _start(nodes, p, tried)
    graph = materialise(_best(first if graph is None else graph.union(first), p.neighbours), "graph")
    for _ in range(p.rounds):
        old = graph
        graph = materialise(_best(old.union(_refine(old, nodes, p)), p.neighbours), "graph")
        size = graph.count()
        if size - graph.join(old, ["a", "b"], "left_semi").count() <= p.settled * size:
            break
    return graph


def _links(nodes: DataFrame, graph: DataFrame, p: DescentParams) -> tuple:
    """(``node, linked, distinct_linked``, ``node, comp``) by the neighbour graph."""
    near = graph.filter(F.col("cos") >= p.threshold - 1e-3)
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialise(_exact(pairs, nodes, p.threshold), "vector-links")
    comp = components(links)
    full = near.groupBy("a").count().filter(F.col("count") >= p.neighbours).select(F.col("a").alias("node"))
    full = materialise(comp.join(full, "node", "left_semi"), "full-lists")
    if full.select("comp").distinct().limit(2).count() > 1:
        bridges = materialise(_bridges(full.join(nodes.select("node", "unit"), "node").select("comp", "node", "unit"), p), "vector-bridges")
        if bridges.limit(1).count():
            comp = components(links.union(bridges))
    sizes = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    dense = sizes.join(comp.join(full.select("node"), "node", "left_semi").select("comp").distinct(), "comp", "left_semi")
    dense = materialise(dense, "dense-groups")
    thin = spread_join(comp, dense, "comp").select("comp", "node", "size")
    exact = _group_counts(thin.join(nodes.select("node", "unit", "copies"), "node"), p)
    each = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    each = spread_join(each, nodes.select(F.col("node").alias("other"), "copies"), "other")
    sparse = each.groupBy("node").agg(F.sum("copies").alias("linked"), F.count(F.lit(1)).alias("distinct_linked"))
    both = sparse.withColumn("g", F.lit(0)).unionByName(exact.withColumn("g", F.lit(1)))
    counts = both.groupBy("node").agg(F.max(F.struct("g", "linked", "distinct_linked")).alias("x"))
    return materialise(counts.select("node", "x.linked", "x.distinct_linked"), "link-counts"), comp


def similar_vectors(vectors: DataFrame, params: DescentParams = DescentParams(), id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Null, empty and zero vectors and such with null or non-finite components
    link with nothing; vectors of different lengths don't link. Equal vectors
    link with each other. Repeated rows are copies; a null vec_id takes its
    component's smallest id and is kept only where there is none."""
    p = params
    rows = pick(vectors, vec_id=id_col, vec=vector_col).withColumn("rid", F.monotonically_increasing_id())
    rows = materialise(_units(rows.select("rid", "vec_id", "vec")), "units")
    nodes = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("rid").alias("node"), F.min("unit").alias("unit"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    nodes = materialise(_with_floats(nodes), "nodes")
    true = materialise(_true_links(nodes, p), "true-links")
    graph, tried = None, 0
    for attempt in range(p.attempts):
        graph = _descend(nodes, p, graph, tried)
        counts, comp = _links(nodes, graph, p)
        recall = _audit(true, counts)
        if recall >= p.recall:
            break
        if attempt + 1 == p.attempts:
            raise RuntimeError(f"recall {recall:.4f} of links after {p.attempts} passes, below {p.recall}")
        tried += p.projections
        p = replace(p, neighbours=p.neighbours * (2 if attempt else 1), projections=2 * p.projections, rounds=p.rounds + 2)
    info = nodes.drop("unit", "unit32").join(counts, "node", "left").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    info = materialise(info, "vector-info")
    first = info.groupBy("comp").agg(F.min("first").alias("component_id"))
    info = spread_join(info, first, "comp").select("key", "component_id", (
        F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = spread_join(rows.drop("unit"), info, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def _with_floats(nodes: DataFrame) -> DataFrame:
    """``unit32``: single-precision copies, in which candidates travel and are ranked."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", unit32 binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            short = [np.frombuffer(u, np.float64).astype(np.float32).tobytes() for u in b.column("unit").to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(short, pa.binary())], names=[*b.schema.names, "unit32"])

    return nodes.mapInArrow(run, schema)
