"""Ledger operators: the reference's step and rollout cases, and random
ledgers against a plain day loop."""

import random

import pytest

from larder.operators import ledger as lg

DEM = "store_id string, item_id string, demand double"
STOCK = "store_id string, item_id string, qty double"


def _step(spark, demand, stock):
    d = spark.createDataFrame([("S", "I", demand)], DEM)
    s = spark.createDataFrame([("S", "I", stock)], STOCK)
    return lg.fulfil_day(d, s, holding_cost=1.0, stockout_penalty=10.0).first()


def test_start_stock(spark):
    from larder.operators.replenish import initial_stock
    stats = spark.createDataFrame([("S", "I", 10.0)], "store_id string, item_id string, avg_demand double")
    assert initial_stock(stats, 2.0).first().qty == 20.0


def test_covered_day(spark):
    r = _step(spark, 15.0, 20.0)
    assert (r.end_stock, r.stockout, r.holding_cost, r.stockout_penalty) == (5.0, 0.0, 5.0, 0.0)
    assert r.sales / r.demand == 1.0


def test_short_day(spark):
    r = _step(spark, 25.0, 20.0)
    assert (r.end_stock, r.stockout, r.holding_cost, r.stockout_penalty) == (0.0, 5.0, 0.0, 50.0)
    assert r.sales / r.demand == pytest.approx(0.8)


def test_arrival_after_lead_time(spark):
    # order 100 on day 0 with lead time 2, no demand: stock 20, 20, 120
    ev = spark.createDataFrame([("S", "I", d, None, 100.0 if d == 2 else 0.0) for d in range(3)],
                               "store_id string, item_id string, day int, demand double, arrivals double")
    init = spark.createDataFrame([("S", "I", 20.0)], STOCK)
    got = [r.end_stock for r in lg.replay_ledger(ev, init).orderBy("day").collect()]
    assert got == [20.0, 20.0, 120.0]


def test_daily_kpis_day_without_demand(spark):
    rows = spark.createDataFrame([(0, 10.0, 8.0, 2.0, 20.0, 3.0), (2, 5.0, 5.0, 0.0, 0.0, 1.0)],
                                 "day int, demand double, sales double, stockout double, "
                                 "stockout_penalty double, holding_cost double")
    got = {r.day: r for r in lg.daily_kpis(rows).collect()}
    assert got[1].fulfillment_rate == 1.0 and got[1].total_cost == 0.0
    assert got[0].fulfillment_rate == pytest.approx(0.8) and got[0].total_cost == 23.0
    s = lg.summary_kpis(lg.daily_kpis(rows)).first()
    assert s.n_days == 3 and s.total_stockouts == 2.0


def _loop_ledger(inv0, rows):
    inv, out = inv0, []
    for day, d, a in rows:
        inv += a
        sales = min(d, inv)
        inv -= sales
        out.append((day, inv, d - sales))
    return out


def test_replay_matches_day_loop(spark):
    rnd = random.Random(1)
    data, init, want = [], [], {}
    for k in range(30):
        inv0 = float(rnd.randint(0, 20))
        rows = [(day, float(rnd.randint(0, 9)), float(rnd.choice([0, 0, 0, 15])))
                for day in sorted(rnd.sample(range(60), 25))]
        init.append(("S", f"I{k}", inv0))
        data += [("S", f"I{k}", day, d, a) for day, d, a in rows]
        for day, inv, so in _loop_ledger(inv0, rows):
            want[(f"I{k}", day)] = (inv, so)
    ev = spark.createDataFrame(data, "store_id string, item_id string, day int, demand double, arrivals double")
    got = lg.replay_ledger(ev, spark.createDataFrame(init, STOCK)).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.end_stock, r.stockout) == want[(r.item_id, r.day)]


def test_warehouse_drawdown(spark):
    orders = spark.createDataFrame([(0, "S1", "A", 30.0), (0, "S2", "A", 30.0), (1, "S1", "A", 50.0),
                                    (0, "S1", "Z", 5.0)], "day int, store_id string, item_id string, qty double")
    wh = spark.createDataFrame([("A", 100.0)], "item_id string, qty double")
    got = [(r.day, r.remaining, r.shortfall) for r in lg.warehouse_drawdown(orders, wh).orderBy("day").collect()]
    assert got == [(0, 40.0, 0.0), (1, 0.0, 10.0)]


def test_day_slice(spark):
    df = spark.createDataFrame([(0, "S", "A", 1.0), (1, "S", "A", 2.0), (1, "S", "B", 3.0)],
                               "day int, store_id string, item_id string, demand double")
    assert sorted(r.item_id for r in lg.day_slice(df, 1).collect()) == ["A", "B"]


def test_compare_policies(spark):
    pos = spark.createDataFrame([("S", "A", 10.0, 5.0), ("S", "B", 2.0, 50.0)],
                                "store_id string, item_id string, forecasted_demand double, position double")
    orders = {"none": spark.createDataFrame([], STOCK), "some": spark.createDataFrame([("S", "A", 20.0)], STOCK)}
    got = {r.policy: (r.n_orders, r.units, r.transport_cost, r.short_units, r.shortage_cost)
           for r in lg.compare_policies(orders, pos, 3.0, 2.0, 10.0).collect()}
    assert got == {"none": (0, 0.0, 0.0, 25.0, 250.0), "some": (1, 20.0, 40.0, 5.0, 50.0)}
