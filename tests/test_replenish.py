"""One-day replenishment policies on the reference's policy fixture:
stock 15, forecast 10, lead time 2, buffer 1, min 2 / max 5 days."""

import pytest

from larder.operators import replenish as rp

POS_SCHEMA = "store_id string, item_id string, forecasted_demand double"


def _position(spark, in_transit=()):
    f = spark.createDataFrame([("S1", "I1", 10.0)], POS_SCHEMA)
    s = spark.createDataFrame([("S1", "I1", 15.0)], "store_id string, item_id string, qty double")
    t = spark.createDataFrame(list(in_transit), "store_id string, item_id string, qty double, arrival_day int")
    return rp.stock_position(f, s, t)


def test_naive(spark):
    rows = rp.naive_orders(_position(spark), 2, 2, 1.0).collect()
    assert [(r.store_id, r.item_id, r.qty) for r in rows] == [("S1", "I1", 15.0)]


def test_minmax(spark):
    rows = rp.minmax_orders(_position(spark), 2.0, 5.0).collect()
    assert [r.qty for r in rows] == [35.0]


def test_minmax_with_in_transit_orders_nothing(spark):
    pos = _position(spark, [("S1", "I1", 10.0, 3)])
    assert pos.first().position == 25.0
    assert rp.minmax_orders(pos, 2.0, 5.0).count() == 0


def test_allocation_policy_closed_form(spark):
    wh = spark.createDataFrame([("I1", 100.0)], "item_id string, qty double")
    rows = rp.allocation_orders(_position(spark), wh, 2, 2, stockout_penalty=10.0, holding_cost=1.0,
                                transport_cost=0.5).collect()
    assert [r.qty for r in rows] == [pytest.approx(5.0)]


def test_initial_stock(spark):
    stats = spark.createDataFrame([("S", "A", 10.0), ("S", "B", -3.0), ("S", "C", None)],
                                  "store_id string, item_id string, avg_demand double")
    got = {r.item_id: r.qty for r in rp.initial_stock(stats, 2.0).collect()}
    assert got == {"A": 20.0, "B": 0.0, "C": 0.0}


def test_schedule_split_post(spark):
    orders = spark.createDataFrame([(0, "S", "A", 5.0), (0, "S", "B", 0.0), (1, "T", "A", 3.0)],
                                   "day int, store_id string, item_id string, qty double")
    sched = rp.schedule_orders(orders, 2, 5).collect()
    assert len(sched) == 2 and all(2 <= r.lead_time <= 5 and r.arrival_day == r.day + r.lead_time for r in sched)
    fixed = rp.schedule_orders(orders, 0, 0)
    due = rp.split_arrivals(fixed, 0).filter("due")
    assert [r.item_id for r in due.collect()] == ["A"]
    inv = spark.createDataFrame([("S", "B", 4.0)], "store_id string, item_id string, qty double")
    got = {(r.store_id, r.item_id): r.qty for r in rp.post_arrivals(inv, due).collect()}
    assert got == {("S", "A"): 5.0, ("S", "B"): 4.0}


def test_lead_time_differs_between_stores_and_items(spark):
    orders = spark.createDataFrame([(10, f"S{s}", f"I{i}", 1.0) for s in range(25) for i in range(4)],
                                   "day int, store_id string, item_id string, qty double")
    rows = rp.schedule_orders(orders, 2, 5).collect()
    assert {r.lead_time for r in rows} == {2, 3, 4, 5}
    assert len({r.lead_time for r in rows if r.item_id == "I0"}) > 1
    assert len({r.lead_time for r in rows if r.store_id == "S0"}) > 1
