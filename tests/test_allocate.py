"""Allocation: the reference's four LP cases, and random cases against a
brute-force integer optimum of the same LP."""

import itertools
import random

import pytest

from larder.operators import allocate as al

COSTS = dict(stockout_penalty=100.0, holding_cost=1.0, transport_cost=2.0)


def _run(spark, demand, inventory, warehouse, mode="ordered", **costs):
    d = spark.createDataFrame(demand, "store_id string, item_id string, demand double")
    i = spark.createDataFrame(inventory, "store_id string, item_id string, qty double")
    w = spark.createDataFrame(warehouse, "item_id string, qty double")
    rows = al.allocate(d, i, w, mode, **(costs or COSTS)).collect()
    return {(r.store_id, r.item_id): r.allocated_qty for r in rows}


@pytest.mark.parametrize("mode", ["ordered", "proportional"])
def test_abundant(spark, mode):
    got = _run(spark, [("S1", "I", 50.0), ("S2", "I", 30.0)], [("S1", "I", 0.0), ("S2", "I", 0.0)],
               [("I", 1000.0)], mode)
    assert got == {("S1", "I"): 50.0, ("S2", "I"): 30.0}


@pytest.mark.parametrize("mode", ["ordered", "proportional"])
def test_constrained_total(spark, mode):
    got = _run(spark, [("S1", "I", 50.0), ("S2", "I", 50.0)], [("S1", "I", 0.0), ("S2", "I", 0.0)],
               [("I", 60.0)], mode)
    assert sum(got.values()) == pytest.approx(60.0)


def test_transport_above_penalty(spark):
    got = _run(spark, [("S1", "I", 50.0)], [("S1", "I", 0.0)], [("I", 1000.0)],
               stockout_penalty=100.0, holding_cost=1.0, transport_cost=200.0)
    assert got == {("S1", "I"): 0.0}


def test_stocked_store(spark):
    got = _run(spark, [("S1", "I", 50.0), ("S2", "I", 50.0)], [("S1", "I", 60.0), ("S2", "I", 0.0)],
               [("I", 1000.0)])
    assert got == {("S1", "I"): 0.0, ("S2", "I"): 50.0}


def test_missing_warehouse_and_negative_stock(spark):
    got = _run(spark, [("S1", "I", 5.0), ("S1", "J", 5.0)], [], [("J", -3.0)])
    assert got == {("S1", "I"): 0.0, ("S1", "J"): 0.0}


def test_duplicate_demand_rows_add_up(spark):
    got = _run(spark, [("S1", "I", 5.0), ("S1", "I", 7.0)], [], [("I", 100.0)])
    assert got == {("S1", "I"): 12.0}


def _lp_cost(x, demand, inv, tc, sp, hc):
    return sum(tc * xi + sp * max(0, d - v - xi) + hc * max(0, v + xi - d) for xi, d, v in zip(x, demand, inv))


def test_random_cases_reach_brute_force_optimum(spark):
    rnd = random.Random(5)
    cases = []
    for k in range(40):
        n = 3
        demand = [rnd.randint(0, 6) for _ in range(n)]
        inv = [rnd.randint(0, 4) for _ in range(n)]
        wh = rnd.randint(0, 10)
        tc, sp, hc = rnd.choice([(2, 100, 1), (5, 3, 1), (1, 2, 2)])
        cases.append((f"I{k}", demand, inv, wh, (tc, sp, hc)))
    for costs in {c[4] for c in cases}:
        sub = [c for c in cases if c[4] == costs]
        dem = [(f"S{j}", item, float(d)) for item, ds, _, _, _ in sub for j, d in enumerate(ds)]
        inv = [(f"S{j}", item, float(v)) for item, _, vs, _, _ in sub for j, v in enumerate(vs)]
        wh = [(item, float(w)) for item, _, _, w, _ in sub]
        tc, sp, hc = costs
        got = _run(spark, dem, inv, wh, "ordered", stockout_penalty=sp, holding_cost=hc, transport_cost=tc)
        for item, ds, vs, w, _ in sub:
            x = [got[(f"S{j}", item)] for j in range(len(ds))]
            assert sum(x) <= w + 1e-9
            best = min(_lp_cost(c, ds, vs, tc, sp, hc)
                       for c in itertools.product(range(w + 1), repeat=len(ds)) if sum(c) <= w)
            assert _lp_cost(x, ds, vs, tc, sp, hc) == pytest.approx(best)


def test_allocation_cost(spark):
    d = spark.createDataFrame([("S1", "I", 50.0), ("S2", "I", 50.0)], "store_id string, item_id string, demand double")
    i = spark.createDataFrame([("S1", "I", 0.0)], "store_id string, item_id string, qty double")
    w = spark.createDataFrame([("I", 60.0)], "item_id string, qty double")
    alloc = al.allocate(d, i, w, "ordered", keep_inputs=True, **COSTS)
    row = al.allocation_cost(alloc, **COSTS).first()
    assert row.total_allocated == 60.0
    assert row.total_cost == pytest.approx(2 * 60 + 100 * 40)
