"""Open orders per day and policies by KPIs, against a day-by-day loop."""

import random

from larder.operators import ledger as lg
from larder.operators import replenish as rp

HORIZON = 25
SERIES = [(s, i) for s in ("S1", "S2") for i in ("A", "B", "C")]


def _inputs(spark, rnd):
    """Orders with lead times 0 to 6, some before day 0, past the horizon, null
    or not positive; demand with gaps; a series without stock, one without demand."""
    orders = [(*rnd.choice(SERIES), day, float(rnd.randrange(-2, 9)), day + rnd.randrange(7)) for day in range(-3, HORIZON + 4)
              for _ in range(rnd.randrange(4))] + [("S1", "A", 3, None, 4), ("S9", "Z", 5, 2.0, 8)]
    demand = [(*k, day, float(rnd.randrange(6))) for k in SERIES[1:] for day in range(HORIZON + 2) if rnd.random() < 0.6]
    demand += demand[:5]
    initial = [(*k, float(rnd.randrange(12))) for k in SERIES[:4]]
    return (orders, demand, initial, spark.createDataFrame(orders, "store_id string, item_id string, day int, qty double, arrival_day int"),
            spark.createDataFrame(demand, "store_id string, item_id string, day int, demand double"),
            spark.createDataFrame(initial, "store_id string, item_id string, qty double"))


def _walk(orders, demand, initial, horizon):
    """The mornings' (in transit, stock) and the days' figures, day by day."""
    keys = sorted({o[:2] for o in orders} | {d[:2] for d in demand} | {i[:2] for i in initial})
    stock = {k: sum(i[2] for i in initial if i[:2] == k) for k in keys}
    real = [o for o in orders if o[3] is not None and o[3] > 0]
    mornings, days = {}, []
    for day in range(horizon):
        total = {"d": 0.0, "s": 0.0, "out": 0.0, "held": 0.0}
        for k in keys:
            mornings[(*k, day)] = (sum(o[3] for o in real if o[:2] == k and o[2] < day <= o[4]), stock[k])
            stock[k] += sum(o[3] for o in real if o[:2] == k and o[4] == day)
            asked = [d[3] for d in demand if d[:2] == k and d[2] == day]
            sold = min(sum(asked), stock[k])
            stock[k] -= sold
            total["d"] += sum(asked)
            total["s"] += sold
            total["out"] += sum(asked) - sold
            total["held"] += stock[k] if asked else 0.0
        days.append(total)
    return mornings, days


def test_open_positions_equal_a_loop(spark):
    for seed in range(3):
        orders, demand, initial, o, d, i = _inputs(spark, random.Random(seed))
        want, _ = _walk(orders, demand, initial, HORIZON)
        rows = lg.open_positions(o.selectExpr("*", "1 AS opened"), d, i, HORIZON).collect()
        assert len(rows) == len(want)
        assert {(r.store_id, r.item_id, r.day): (r.in_transit, r.stock) for r in rows} == want
        assert all(r.position == r.in_transit + r.stock for r in rows)


def test_positions_of_a_day_equal_the_day_operator(spark):
    _, _, _, o, d, i = _inputs(spark, random.Random(9))
    day = 11
    rows = lg.open_positions(o, d, i, HORIZON).filter(f"day = {day}")
    open_then = rp.in_transit_totals(o.filter(f"qty > 0 AND day < {day} AND arrival_day >= {day}"))
    assert {(r.store_id, r.item_id): r.in_transit for r in open_then.collect()} == {
        (r.store_id, r.item_id): r.in_transit for r in rows.collect() if r.in_transit}


def test_open_positions_without_rows(spark):
    _, _, _, o, d, i = _inputs(spark, random.Random(1))
    assert lg.open_positions(o, d, i, 0).count() == 0
    none = lg.open_positions(o.limit(0), d.limit(0), i, 2).collect()
    assert len(none) == 8 and all(r.in_transit == 0.0 for r in none)
    assert lg.open_positions(o.limit(0), d.limit(0), i.limit(0), 5).count() == 0


def test_policies_by_kpis_equal_a_loop(spark):
    orders, demand, initial, o, d, i = _inputs(spark, random.Random(4))
    more, _, _, o2, _, _ = _inputs(spark, random.Random(5))
    placed = o.selectExpr("'a' AS policy", "*").union(o2.selectExpr("'b' AS policy", "*")).union(o2.selectExpr("'unnamed' AS policy", "*"))
    got = {r.policy: r for r in lg.policy_kpis(placed, d, i, ["a", "b", "none"], HORIZON, 2.0, 50.0).collect()}
    assert set(got) == {"a", "b", "none"}
    for name, own in (("a", orders), ("b", more), ("none", [])):
        own = [x for x in own if x[4] >= 0]  # what came before day 0 is in the first stock
        _, days = _walk(own, demand, initial, HORIZON)
        r = got[name]
        rates = [x["s"] / x["d"] if x["d"] else 1.0 for x in days]
        assert abs(r.avg_fulfillment_rate - sum(rates) / HORIZON) < 1e-9 and r.n_days == HORIZON
        assert r.total_stockouts == sum(x["out"] for x in days) and r.total_stockout_penalty == 50.0 * r.total_stockouts
        assert r.total_holding_cost == 2.0 * sum(x["held"] for x in days)
        assert r.total_cost == r.total_holding_cost + r.total_stockout_penalty


def test_one_partitioning_of_the_series_serves_the_ledger(spark):
    """The windows of the ledger and of the open orders share the shuffle of the daily rows."""
    _, _, _, o, d, i = _inputs(spark, random.Random(2))
    df = lg.open_positions(o, d, i, HORIZON)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window ") <= 4 and "hashpartitioning(item_id" not in plan
