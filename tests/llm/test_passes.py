"""Passes of the neighbour graph: what a short one leaves, what refining writes, how many nodes are audited."""

import numpy as np

from larder.llm import vectors


def _frame(spark, m):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<double>")


def _nodes(spark, m):
    units = m / np.linalg.norm(m, axis=1)[:, None]
    rows = [(i, bytearray(u.tobytes())) for i, u in enumerate(units)]
    return vectors._with_floats(spark.createDataFrame(rows, "node long, unit binary")), units


def test_a_short_pass_leaves_its_graph_to_the_next(spark, monkeypatch):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(90, 8))
    m[60:] = m[:30] + 0.02 * rng.normal(size=(30, 8))
    tried, graphs, lists = [], [], []
    start, best = vectors._start, vectors._best
    monkeypatch.setattr(vectors, "_start", lambda nodes, p, at=0: tried.append((at, p.projections)) or start(nodes, p, at))
    monkeypatch.setattr(vectors, "_best", lambda edges, k: lists.append(k) or best(edges, k))
    shares = iter([0.5, 0.5, 1.0])
    monkeypatch.setattr(vectors, "_audit", lambda *_: next(shares))
    descend = vectors._descend
    monkeypatch.setattr(vectors, "_descend", lambda nodes, p, graph=None, at=0: graphs.append(graph) or descend(nodes, p, graph, at))
    got = {r.vec_id: r for r in vectors.similar_vectors(_frame(spark, m)).collect()}
    assert tried == [(0, 4), (4, 8), (12, 16)]  # no ordering twice
    assert graphs[0] is None and graphs[1] is not None and graphs[2] is not None
    assert lists[0] == 6 and lists[-1] == 12 and sorted(set(lists)) == [6, 12]
    u = m / np.linalg.norm(m, axis=1)[:, None]
    hit = u @ u.T >= 0.9
    assert [got[i].n_links for i in range(90)] == (hit.sum(1) - 1).tolist()


def test_refining_writes_only_what_can_enter_a_list(spark):
    rng = np.random.default_rng(3)
    nodes, units = _nodes(spark, rng.normal(size=(120, 6)))
    p = vectors.DescentParams(neighbours=4, projections=1, block=16)
    graph = vectors._best(vectors._start(nodes, p), p.neighbours)
    lists: dict = {}
    for r in graph.collect():
        lists.setdefault(r.a, []).append(r.cos)
    got = vectors._refine(graph, nodes, p).collect()
    assert got and all(r.a != r.b and (len(lists[r.a]) < 4 or r.cos >= min(lists[r.a])) for r in got)
    # the lists become those that all candidates give
    cos = (units.astype(np.float32) @ units.astype(np.float32).T).astype(float)
    near: dict = {i: {i} for i in range(120)}
    for r in graph.collect():
        near[r.a].add(r.b)
    back: dict = {}
    for r in graph.collect():
        back.setdefault(r.b, []).append((-r.cos, r.a))
    for b, some in back.items():
        near[b] |= {a for _, a in sorted(some)[:4]}
    want: dict = {i: set(near[i]) - {i} for i in range(120)}
    own: dict = {}
    for r in graph.collect():
        own.setdefault(r.a, set()).add(r.b)
    for a in range(120):
        all_of = own.get(a, set()).union(*[x for x in near.values() if a in x]) - {a}
        want[a] = set(sorted(all_of, key=lambda b, a=a: -cos[a, b])[:4])
    after: dict = {}
    for r in vectors._best(graph.union(vectors._refine(graph, nodes, p)), 4).collect():
        after.setdefault(r.a, set()).add(r.b)
    assert after == want


def test_true_links_of_a_sample(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(50, 5))
    m[25:] = m[:25] * rng.uniform(0.5, 2, size=(25, 1)) + 0.01
    nodes, units = _nodes(spark, m)
    hit = (units @ units.T >= 0.9).sum(1) - 1
    got = {r.node: r.links for r in vectors._true_links(nodes, vectors.DescentParams()).collect()}
    assert got == {i: int(n) for i, n in enumerate(hit) if n}
    some = vectors._true_links(nodes, vectors.DescentParams(audit_rows=9)).collect()
    assert 0 < len(some) <= 9 and all(got[r.node] == r.links for r in some)
    assert vectors._true_links(nodes.limit(0), vectors.DescentParams()).count() == 0
    none = vectors._true_links(nodes.limit(0), vectors.DescentParams())
    assert vectors._audit(none, none.selectExpr("node", "links AS distinct_linked")) == 1.0
