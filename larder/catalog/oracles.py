"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently of the Spark code path: plain SQL over
the driver's tables (window functions, recursive CTEs), so a match is a real
cross-check. The shared CTE prelude rebuilds the same derived tables as
``larder.sources.driver_tables`` from the same fixed values.
"""

from __future__ import annotations

from larder.catalog import inputs as P
from larder.sources import driver_tables as dt


def _case(events, field: int) -> str:
    whens = " ".join(
        f"WHEN month(date) = {m} AND day(date) = {d} THEN '{name if field == 2 else etype}'"
        for m, d, name, etype in events)
    return f"CASE {whens} ELSE NULL END"


def _snaps() -> str:
    cols = []
    for k, state in enumerate(dt.STATES):
        lo = dt.SNAP_FIRST_DAY + dt.SNAP_STEP * k
        hi = lo + dt.SNAP_LENGTH - 1
        cols.append(f"CAST(day(date) BETWEEN {lo} AND {hi} AS INT) AS snap_{state}")
    return ",\n    ".join(cols)


SNAP_COLS = ", ".join(f"snap_{s}" for s in dt.STATES)


def prelude() -> str:
    return f"""
bounds AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
store_dim AS (
  SELECT s.s_suppkey, n.n_name AS store_id, upper(substr(r.r_name, 1, 2)) AS state_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
item_dim AS (
  SELECT p_partkey, p_brand AS item_id,
    'CAT_' || CAST((CAST(substr(p_brand, 7, 4) AS INT) - 1) // 5 AS VARCHAR) AS cat_id,
    'CAT_' || CAST((CAST(substr(p_brand, 7, 4) AS INT) - 1) // 5 AS VARCHAR) || '_'
      || CAST(CAST(substr(p_brand, 7, 4) AS INT) % 2 AS VARCHAR) AS dept_id
  FROM part),
facts AS (
  SELECT l.l_quantity, l.l_extendedprice, l.l_returnflag, CAST(l.l_shipdate AS DATE) AS date,
    sd.store_id, sd.state_id, i.item_id, i.dept_id, i.cat_id
  FROM lineitem l JOIN store_dim sd ON l.l_suppkey = sd.s_suppkey
  JOIN item_dim i ON l.l_partkey = i.p_partkey),
sales_daily AS (
  SELECT item_id || '_' || store_id || '_validation' AS id, item_id, dept_id, cat_id, store_id, state_id,
    'd_' || CAST(date_diff('day', (SELECT lo FROM bounds), date) + 1 AS VARCHAR) AS d,
    CAST(sum(l_quantity) AS DOUBLE) AS sales
  FROM facts GROUP BY item_id, dept_id, cat_id, store_id, state_id, date),
calendar AS (
  SELECT date,
    CAST(year(date) * 100 + weekofyear(date) AS INT) AS wm_yr_wk,
    dayname(date) AS weekday,
    CAST((dayofweek(date) + 1) % 7 + 1 AS INT) AS wday,
    CAST(month(date) AS INT) AS month,
    CAST(year(date) AS INT) AS year,
    'd_' || CAST(date_diff('day', lo, date) + 1 AS VARCHAR) AS d,
    {_case(dt.EVENTS_1, 2)} AS event_name_1,
    {_case(dt.EVENTS_1, 1)} AS event_type_1,
    {_case(dt.EVENTS_2, 2)} AS event_name_2,
    {_case(dt.EVENTS_2, 1)} AS event_type_2,
    {_snaps()}
  FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                           INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds)),
prices AS (
  SELECT store_id, item_id, CAST(year(date) * 100 + weekofyear(date) AS INT) AS wm_yr_wk,
    CAST((2 * sum(CAST(round(l_extendedprice * 100) AS BIGINT)) + sum(CAST(l_quantity AS BIGINT)))
      // nullif(2 * sum(CAST(l_quantity AS BIGINT)), 0) AS DOUBLE) / 100.0 AS sell_price
  FROM facts GROUP BY 1, 2, 3),
joined AS (
  SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.d, s.sales,
    c.date, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year,
    c.event_name_1, c.event_type_1, c.event_name_2, c.event_type_2, {', '.join('c.snap_' + s for s in dt.STATES)},
    p.sell_price
  FROM sales_daily s LEFT JOIN calendar c ON s.d = c.d
  LEFT JOIN prices p ON p.store_id = s.store_id AND p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk),
prepared AS (
  SELECT * REPLACE (last_value(sell_price IGNORE NULLS) OVER (
      PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN {P.FFILL_LIMIT} PRECEDING AND CURRENT ROW)
    AS sell_price)
  FROM joined)"""


def with_prelude(body_ctes: str, select: str) -> str:
    extra = f",\n{body_ctes}" if body_ctes.strip() else ""
    return f"WITH RECURSIVE{prelude()}{extra}\n{select}"


SERIES = "PARTITION BY store_id, item_id ORDER BY date"


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


def _feature_ctes() -> str:
    lags = ",\n    ".join(f"lag(sales, {n}) OVER ({SERIES}) AS lag_{n}" for n in P.LAGS)
    means = ",\n    ".join(
        f"avg(sales) OVER ({SERIES} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_mean_{n}"
        for n in P.WINDOWS)
    stds = ",\n    ".join(
        f"stddev_samp(sales) OVER ({SERIES} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_std_{n}"
        for n in P.WINDOWS)
    evcase = " ".join(f"WHEN event_type_1 = '{k}' THEN {v}" for k, v in
                      {"Cultural": 1, "National": 2, "Religious": 3, "Sporting": 4}.items())
    snap = " ".join(f"WHEN state_id = '{s}' THEN snap_{s}" for s in dt.STATES)
    return f"""
item_means AS (SELECT item_id, avg(sell_price) AS item_mean FROM prepared GROUP BY item_id),
featured AS (
  SELECT p.*,
    CAST(isodow(date) - 1 AS INT) AS day_of_week,
    CAST(weekofyear(date) AS INT) AS week_of_year,
    CAST(day(date) AS INT) AS day_of_month,
    CAST(isodow(date) - 1 >= 5 AS INT) AS is_weekend,
    CAST(quarter(date) AS INT) AS quarter,
    CAST(event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL AS INT) AS has_event,
    CAST(CASE {evcase} ELSE 0 END AS INT) AS event_type_encoded,
    CAST(coalesce(CASE {snap} ELSE 0 END, 0) AS INT) AS snap_active,
    {lags},
    {means},
    {stds},
    sell_price / nullif(m.item_mean, 0) AS price_rel_mean,
    sell_price / nullif(lag(sell_price, 7) OVER ({SERIES}), 0) - 1 AS price_change_pct,
    ln(1 + sell_price) AS log_price,
    count(sales) OVER (PARTITION BY store_id, item_id) AS n_obs
  FROM prepared p LEFT JOIN item_means m USING (item_id))"""


FEATURE_COLUMNS = (["day_of_week", "month", "week_of_year", "day_of_month", "is_weekend", "quarter",
                    "year", "has_event", "event_type_encoded", "snap_active"]
                   + [f"lag_{n}" for n in P.LAGS]
                   + [f"rolling_mean_{n}" for n in P.WINDOWS]
                   + [f"rolling_std_{n}" for n in P.WINDOWS]
                   + ["price_rel_mean", "price_change_pct", "log_price"])
BASE_COLUMNS = (["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "sales", "date",
                 "wm_yr_wk", "weekday", "wday", "event_name_1", "event_type_1", "event_name_2",
                 "event_type_2"] + [f"snap_{s}" for s in dt.STATES] + ["sell_price"])
DOUBLE_COLUMNS = {"sales", "sell_price", "price_rel_mean", "price_change_pct", "log_price"} | \
    {f"lag_{n}" for n in P.LAGS} | {f"rolling_mean_{n}" for n in P.WINDOWS} | \
    {f"rolling_std_{n}" for n in P.WINDOWS}


def _cols(cols) -> str:
    return ", ".join(_r(c, c) if c in DOUBLE_COLUMNS else c for c in cols)


KEYS = ["store_id", "item_id", "date"]


def _feature_query(cols, where: str = "") -> str:
    return with_prelude(_feature_ctes(), f"SELECT {_cols(cols)} FROM featured {where}")


ORACLES: dict[str, str] = {}

ORACLES["join_calendar"] = with_prelude("", f"""
SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.d, round(s.sales, 6) AS sales,
  c.date, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.event_name_1, c.event_type_1,
  c.event_name_2, c.event_type_2, {', '.join('c.snap_' + s for s in dt.STATES)}
FROM sales_daily s LEFT JOIN calendar c ON s.d = c.d""")

ORACLES["join_prices"] = with_prelude("", "SELECT store_id, item_id, date, wm_yr_wk, "
                                          "round(sell_price, 6) AS sell_price FROM joined")

ORACLES["ffill_prices"] = with_prelude("", "SELECT store_id, item_id, date, "
                                           "round(sell_price, 6) AS sell_price FROM prepared")

ORACLES["filter_stores_items"] = with_prelude("", f"""
SELECT {_cols(KEYS + ['sales', 'sell_price'])} FROM prepared
WHERE store_id IN ({', '.join(repr(s) for s in P.FILTER_STORES)})""")

ORACLES["normalise_types"] = with_prelude("", f"SELECT {_cols(BASE_COLUMNS + ['month', 'year'])} FROM prepared")

ORACLES["calendar_features"] = _feature_query(
    KEYS + ["day_of_week", "month", "week_of_year", "day_of_month", "is_weekend", "quarter", "year"])
ORACLES["event_features"] = _feature_query(KEYS + ["has_event", "event_type_encoded"])
ORACLES["snap_features"] = _feature_query(KEYS + ["state_id", "snap_active"])
ORACLES["lag_features"] = _feature_query(KEYS + ["sales"] + [f"lag_{n}" for n in P.LAGS])
ORACLES["rolling_mean"] = _feature_query(KEYS + [f"rolling_mean_{n}" for n in P.WINDOWS])
ORACLES["rolling_std"] = _feature_query(KEYS + [f"rolling_std_{n}" for n in P.WINDOWS])
ORACLES["price_rel_mean"] = _feature_query(KEYS + ["sell_price", "price_rel_mean"])
ORACLES["price_change_pct"] = _feature_query(KEYS + ["sell_price", "price_change_pct"])
ORACLES["log_price"] = _feature_query(KEYS + ["sell_price", "log_price"])
ORACLES["drop_sparse_groups"] = _feature_query(KEYS + ["sales"], f"WHERE n_obs >= {P.MIN_GROUP_ROWS}")
ORACLES["feature_matrix"] = _feature_query(
    [c for c in BASE_COLUMNS] + FEATURE_COLUMNS, f"WHERE n_obs >= {P.MIN_GROUP_ROWS}")

ORACLES["melt_sales"] = with_prelude("""
series AS (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM sales_daily)""", """
SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, c.d,
  round(coalesce(sd.sales, 0.0), 6) AS sales
FROM series s CROSS JOIN calendar c LEFT JOIN sales_daily sd ON sd.id = s.id AND sd.d = c.d""")

# -- diagnostics, round trip, forecasting ------------------------------------

_FM = f"fm AS (SELECT * FROM featured WHERE n_obs >= {P.MIN_GROUP_ROWS})"
_NULL_COLS = ([f"lag_{n}" for n in P.LAGS] + [f"rolling_mean_{n}" for n in P.WINDOWS]
              + [f"rolling_std_{n}" for n in P.WINDOWS] + ["price_rel_mean", "price_change_pct", "log_price"])

ORACLES["feature_null_counts"] = with_prelude(_feature_ctes() + ",\n" + _FM, "SELECT count(*) AS n_rows, " + ", ".join(
    f"CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT) AS null_{c}" for c in _NULL_COLS) + " FROM fm")

ORACLES["quality_checks"] = with_prelude(_feature_ctes() + ",\n" + _FM, """
SELECT count(*) AS n_rows,
  round(avg(CAST(sell_price IS NULL AS DOUBLE)), 6) AS price_null_rate,
  CAST(sum(CAST(sales < 0 AS BIGINT)) AS BIGINT) AS negative_sales,
  CAST(sum(CAST(NOT (is_weekend IN (0, 1)) OR NOT (has_event IN (0, 1)) OR NOT (snap_active IN (0, 1))
                AS BIGINT)) AS BIGINT) AS bad_flags,
  (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM
     (SELECT count(*) AS c FROM fm GROUP BY store_id, item_id, date HAVING count(*) > 1)) AS duplicate_keys
FROM fm""")

ORACLES["features_roundtrip"] = with_prelude(
    _feature_ctes() + ",\n" + _FM,
    f"SELECT {_cols(KEYS + ['sales', 'lag_7', 'rolling_mean_28', 'sell_price'])} FROM fm")

_DATES = """
dates AS (
  SELECT date, CAST(row_number() OVER (ORDER BY date) AS INT) AS date_rank, count(*) OVER () AS n_dates
  FROM (SELECT DISTINCT date FROM fm))"""
_FOLDS = f"""
fold_rows AS (
  SELECT CAST(f.fold AS INT) AS fold, d.date, d.date_rank,
    d.n_dates - ({P.CV_SPLITS} - f.fold + 1) * {P.FORECAST_HORIZON} AS start
  FROM dates d, (SELECT unnest(range(1, {P.CV_SPLITS + 1})) AS fold) f),
cvf AS (
  SELECT fold, date,
    CASE WHEN date_rank <= start THEN 'train' WHEN date_rank <= start + {P.FORECAST_HORIZON} THEN 'test' END AS role
  FROM fold_rows WHERE start > 0 AND date_rank <= start + {P.FORECAST_HORIZON})"""

ORACLES["distinct_dates"] = with_prelude(_feature_ctes() + ",\n" + _FM + "," + _DATES, "SELECT * FROM dates")
ORACLES["cv_folds"] = with_prelude(_feature_ctes() + ",\n" + _FM + "," + _DATES + "," + _FOLDS,
                                   "SELECT fold, date, role FROM cvf")
ORACLES["moving_average_forecast"] = with_prelude(
    _feature_ctes() + ",\n" + _FM,
    "SELECT store_id, item_id, date, round(sales, 6) AS sales, "
    "round(coalesce(rolling_mean_28, 0.0), 6) AS forecast FROM fm")
ORACLES["cv_metrics"] = with_prelude(_feature_ctes() + ",\n" + _FM + "," + _DATES + "," + _FOLDS + """,
scored AS (SELECT date, sales, greatest(coalesce(rolling_mean_28, 0.0), 0.0) AS p FROM fm),
per_fold AS (
  SELECT t.fold, sqrt(avg((s.sales - s.p) * (s.sales - s.p))) AS rmse,
    CASE WHEN sum(s.sales) > 0 THEN sum(abs(s.sales - s.p)) / sum(s.sales) ELSE 0.0 END AS wmape
  FROM scored s JOIN (SELECT fold, date FROM cvf WHERE role = 'test') t ON s.date = t.date
  GROUP BY t.fold)""", "SELECT round(avg(rmse), 6) AS rmse, round(avg(wmape), 6) AS wmape, count(*) AS n_folds "
                       "FROM per_fold")

# -- allocation ---------------------------------------------------------------

_ALLOC = f"""
stats AS (SELECT store_id, item_id, avg(sales) AS avg_demand, sum(sales) AS total_demand
          FROM sales_daily GROUP BY store_id, item_id),
inv AS (SELECT store_id, item_id,
          CAST(ceil(greatest(0.0, coalesce(avg_demand, 0.0)) * {P.INITIAL_MULTIPLIER}) AS DOUBLE) AS qty
        FROM stats),
dem AS (SELECT store_id, item_id, total_demand AS demand FROM stats),
need0 AS (SELECT d.item_id, greatest(0.0, d.demand - i.qty) AS need
          FROM dem d JOIN inv i ON d.store_id = i.store_id AND d.item_id = i.item_id),
wh AS (SELECT item_id, sum(need) * CASE WHEN CAST(substr(item_id, 7, 4) AS INT) % 2 = 0 THEN 0.5 ELSE 2.0 END AS qty
       FROM need0 GROUP BY item_id)"""


def _alloc_ctes(dem: str, inv: str, wh: str, mode: str, tag: str) -> str:
    """Allocation of ``dem(store_id,item_id,demand)`` against ``inv(...,qty)``
    and ``wh(item_id,qty)``, as SQL over the need per pair."""
    if P.STOCKOUT_PENALTY <= P.TRANSPORT_COST:
        x = "0.0"
    elif mode == "ordered":
        x = ("least(need, greatest(0.0, warehouse - coalesce(sum(need) OVER (PARTITION BY item_id "
             "ORDER BY store_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)))")
    else:
        x = ("need * least(1.0, coalesce(warehouse / nullif(sum(need) OVER (PARTITION BY item_id), 0), 0.0))")
    return f"""
{tag}_base AS (
  SELECT d.store_id, d.item_id, d.demand, coalesce(i.qty, 0.0) AS inventory,
    greatest(0.0, d.demand - coalesce(i.qty, 0.0)) AS need, greatest(0.0, coalesce(w.qty, 0.0)) AS warehouse
  FROM (SELECT store_id, item_id, sum(demand) AS demand FROM {dem} GROUP BY store_id, item_id) d
  LEFT JOIN (SELECT store_id, item_id, sum(qty) AS qty FROM {inv} GROUP BY store_id, item_id) i
    ON d.store_id = i.store_id AND d.item_id = i.item_id
  LEFT JOIN (SELECT item_id, sum(qty) AS qty FROM {wh} GROUP BY item_id) w ON d.item_id = w.item_id),
{tag}_raw AS (SELECT *, {x} AS x0 FROM {tag}_base),
{tag} AS (SELECT *, CASE WHEN x0 > 1e-6 THEN x0 ELSE 0.0 END AS x FROM {tag}_raw)"""


ORACLES["allocate_ordered"] = with_prelude(_ALLOC + "," + _alloc_ctes("dem", "inv", "wh", "ordered", "al"),
                                           "SELECT store_id, item_id, round(x, 6) AS allocated_qty FROM al")
ORACLES["allocate_proportional"] = with_prelude(
    _ALLOC + "," + _alloc_ctes("dem", "inv", "wh", "proportional", "al"),
    "SELECT store_id, item_id, round(x, 6) AS allocated_qty FROM al")
ORACLES["allocation_cost"] = with_prelude(_ALLOC + "," + _alloc_ctes("dem", "inv", "wh", "ordered", "al"), f"""
SELECT round(sum({P.TRANSPORT_COST} * x + {P.STOCKOUT_PENALTY} * greatest(0.0, demand - inventory - x)
                 + {P.HOLDING_COST} * greatest(0.0, inventory + x - demand)), 6) AS total_cost,
  round(sum(x), 6) AS total_allocated,
  round(sum(greatest(0.0, demand - inventory - x)), 6) AS total_short,
  round(sum(greatest(0.0, inventory + x - demand)), 6) AS total_held
FROM al""")

# -- replenishment snapshot ---------------------------------------------------

_LEDGER = f"""
demand_daily AS (
  SELECT store_id, item_id, CAST(date_diff('day', (SELECT lo FROM bounds), date) AS INT) AS day,
    CAST(sum(l_quantity) AS DOUBLE) AS demand
  FROM facts WHERE l_returnflag <> 'R' GROUP BY store_id, item_id, date),
returns_daily AS (
  SELECT store_id, item_id, CAST(date_diff('day', (SELECT lo FROM bounds), date) AS INT) AS day,
    CAST(sum(l_quantity) AS DOUBLE) AS qty
  FROM facts WHERE l_returnflag = 'R' GROUP BY store_id, item_id, date),
snap_day AS (SELECT max(day) - {P.SNAPSHOT_DAYS_BEFORE_END} AS t FROM demand_daily),
hist AS (SELECT * FROM demand_daily WHERE day <= (SELECT t FROM snap_day)),
fcst AS (SELECT store_id, item_id, avg(demand) AS forecasted_demand FROM hist GROUP BY store_id, item_id),
stock AS (SELECT store_id, item_id, arg_max(demand, day) AS qty FROM hist GROUP BY store_id, item_id),
transit AS (SELECT store_id, item_id, qty, day AS arrival_day FROM returns_daily
            WHERE day > (SELECT t FROM snap_day)),
totals AS (SELECT store_id, item_id, sum(qty) AS in_transit FROM transit GROUP BY store_id, item_id),
position AS (
  SELECT f.store_id, f.item_id, f.forecasted_demand, coalesce(s.qty, 0.0) AS stock,
    coalesce(t.in_transit, 0.0) AS in_transit, coalesce(s.qty, 0.0) + coalesce(t.in_transit, 0.0) AS position
  FROM fcst f LEFT JOIN stock s ON f.store_id = s.store_id AND f.item_id = s.item_id
  LEFT JOIN totals t ON f.store_id = t.store_id AND f.item_id = t.item_id)"""

_MEAN_LT = (P.LEAD_TIME_MIN + P.LEAD_TIME_MAX) / 2.0
_LT_SPAN = P.LEAD_TIME_MAX - P.LEAD_TIME_MIN + 1


def _lead_time(day: str, store: str) -> str:
    key = f"md5(concat_ws('|', {day}, {store}, item_id, '0'))"
    return f"CAST({P.LEAD_TIME_MIN} + CAST('0x' || substr({key}, 1, 8) AS BIGINT) % {_LT_SPAN} AS INT)"


ORACLES["in_transit_totals"] = with_prelude(_LEDGER, "SELECT store_id, item_id, round(in_transit, 6) AS in_transit "
                                                     "FROM totals")
ORACLES["stock_position"] = with_prelude(_LEDGER, """
SELECT store_id, item_id, round(forecasted_demand, 6) AS forecasted_demand, round(stock, 6) AS stock,
  round(in_transit, 6) AS in_transit, round(position, 6) AS position FROM position""")
ORACLES["initial_stock"] = with_prelude(_ALLOC, "SELECT store_id, item_id, qty FROM inv")
ORACLES["schedule_orders"] = with_prelude(_LEDGER, f"""
SELECT store_id, item_id, day, demand AS qty, {_lead_time('day', 'store_id')} AS lead_time,
  day + {_lead_time('day', 'store_id')} AS arrival_day
FROM demand_daily WHERE demand > 0""")
ORACLES["split_arrivals"] = with_prelude(_LEDGER, """
SELECT store_id, item_id, day AS arrival_day, qty, day <= (SELECT t FROM snap_day) AS due FROM returns_daily""")
ORACLES["post_arrivals"] = with_prelude(_LEDGER, """
SELECT coalesce(i.store_id, a.store_id) AS store_id, coalesce(i.item_id, a.item_id) AS item_id,
  coalesce(i.qty, 0.0) + coalesce(a.qty, 0.0) AS qty
FROM (SELECT store_id, item_id, sum(qty) AS qty FROM stock GROUP BY store_id, item_id) i
FULL JOIN (SELECT store_id, item_id, sum(qty) AS qty FROM returns_daily WHERE day <= (SELECT t FROM snap_day)
           GROUP BY store_id, item_id) a
  ON i.store_id = a.store_id AND i.item_id = a.item_id""")
ORACLES["naive_orders"] = with_prelude(_LEDGER, f"""
SELECT store_id, item_id, round(q, 6) AS qty FROM (
  SELECT store_id, item_id, forecasted_demand * {_MEAN_LT + P.NAIVE_BUFFER_DAYS} - stock - in_transit AS q
  FROM position) WHERE q > 0""")
ORACLES["minmax_orders"] = with_prelude(_LEDGER, f"""
SELECT store_id, item_id, round(q, 6) AS qty FROM (
  SELECT store_id, item_id, forecasted_demand * {P.MAX_DAYS_SUPPLY} - position AS q
  FROM position WHERE position < forecasted_demand * {P.MIN_DAYS_SUPPLY}) WHERE q > 0""")
ORACLES["allocation_orders"] = with_prelude(_LEDGER + "," + _ALLOC + f""",
pdem AS (SELECT store_id, item_id, forecasted_demand * {_MEAN_LT} AS demand FROM position),
pinv AS (SELECT store_id, item_id, position AS qty FROM position),""" + _alloc_ctes("pdem", "pinv", "wh", "ordered", "al"),
    "SELECT store_id, item_id, round(x, 6) AS qty FROM al WHERE x > 0")

# -- ledgers ------------------------------------------------------------------

ORACLES["fulfil_day"] = with_prelude(_LEDGER + "," + _ALLOC, f"""
SELECT day, store_id, item_id, round(demand, 6) AS demand, round(start_stock, 6) AS start_stock,
  round(sales, 6) AS sales, round(demand - sales, 6) AS stockout, round(start_stock - sales, 6) AS end_stock,
  round((start_stock - sales) * {P.HOLDING_COST}, 6) AS holding_cost,
  round((demand - sales) * {P.STOCKOUT_PENALTY}, 6) AS stockout_penalty
FROM (SELECT d.day, d.store_id, d.item_id, d.demand, coalesce(i.qty, 0.0) AS start_stock,
        least(d.demand, coalesce(i.qty, 0.0)) AS sales
      FROM demand_daily d LEFT JOIN inv i ON d.store_id = i.store_id AND d.item_id = i.item_id)""")

_REPLAY = f"""
ev0 AS (
  SELECT coalesce(d.store_id, a.store_id) AS store_id, coalesce(d.item_id, a.item_id) AS item_id,
    coalesce(d.day, a.day) AS day, d.demand, a.qty AS arrivals
  FROM demand_daily d FULL JOIN returns_daily a
    ON d.store_id = a.store_id AND d.item_id = a.item_id AND d.day = a.day),
ev AS (
  SELECT store_id, item_id, day, coalesce(demand, 0.0) AS demand, coalesce(arrivals, 0.0) AS arrivals,
    CAST(demand IS NOT NULL AS INT) AS has_demand,
    row_number() OVER (PARTITION BY store_id, item_id ORDER BY day) AS rn
  FROM ev0),
linit AS (
  SELECT store_id, item_id, CAST(ceil(greatest(0.0, coalesce(avg(demand), 0.0)) * {P.LEDGER_MULTIPLIER}) AS DOUBLE) AS qty
  FROM demand_daily GROUP BY store_id, item_id),
rec AS (
  SELECT e.store_id, e.item_id, e.rn, e.day, e.demand, e.arrivals, e.has_demand,
    least(e.demand, coalesce(i.qty, 0.0) + e.arrivals) AS sales,
    coalesce(i.qty, 0.0) + e.arrivals - least(e.demand, coalesce(i.qty, 0.0) + e.arrivals) AS end_stock
  FROM ev e LEFT JOIN linit i ON e.store_id = i.store_id AND e.item_id = i.item_id WHERE e.rn = 1
  UNION ALL
  SELECT e.store_id, e.item_id, e.rn, e.day, e.demand, e.arrivals, e.has_demand,
    least(e.demand, r.end_stock + e.arrivals),
    r.end_stock + e.arrivals - least(e.demand, r.end_stock + e.arrivals)
  FROM rec r JOIN ev e ON e.store_id = r.store_id AND e.item_id = r.item_id AND e.rn = r.rn + 1),
replay AS (
  SELECT store_id, item_id, day, demand, arrivals, sales, demand - sales AS stockout, end_stock,
    end_stock * {P.HOLDING_COST} * has_demand AS holding_cost, (demand - sales) * {P.STOCKOUT_PENALTY} AS stockout_penalty
  FROM rec)"""


def _daily(src: str, tag: str, by: str = "") -> str:
    """Daily KPI CTE ``tag`` over rows ``src``; optional grouping column ``by``."""
    bsel = f"{by}, " if by else ""
    bjoin = f" AND s.{by} = a.{by}" if by else ""
    spine = (f"SELECT {by}, CAST(unnest(range(0, max(day) + 1)) AS INT) AS day FROM {src} GROUP BY {by}" if by
             else f"SELECT CAST(unnest(range(0, (SELECT max(day) FROM {src}) + 1)) AS INT) AS day")
    return f"""
{tag}_agg AS (
  SELECT {bsel}day, sum(demand) AS d, sum(sales) AS s, sum(stockout) AS so, sum(stockout_penalty) AS sp,
    sum(holding_cost) AS hc FROM {src} GROUP BY {bsel}day),
{tag}_spine AS ({spine}),
{tag} AS (
  SELECT {'s.' + by + ', ' if by else ''}s.day,
    CASE WHEN coalesce(a.d, 0.0) > 0 THEN a.s / a.d ELSE 1.0 END AS fulfillment_rate,
    coalesce(a.so, 0.0) AS stockouts, coalesce(a.sp, 0.0) AS stockout_penalty,
    coalesce(a.hc, 0.0) AS holding_cost, coalesce(a.hc, 0.0) + coalesce(a.sp, 0.0) AS total_cost
  FROM {tag}_spine s LEFT JOIN {tag}_agg a ON s.day = a.day{bjoin})"""


def _summary(src: str, by: str = "") -> str:
    bsel = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    def exact(c):
        return f"round(CAST(sum(CAST({c} AS DECIMAL(38, 6))) AS DOUBLE), 6) AS total_{c.replace('total_', '')}"
    return (f"SELECT {bsel}round(avg(fulfillment_rate), 6) AS avg_fulfillment_rate, "
            f"{exact('stockouts')}, {exact('stockout_penalty')}, {exact('holding_cost')}, "
            f"{exact('total_cost')}, count(*) AS n_days FROM {src}{group}")


_KPI_COLS = ("day, round(fulfillment_rate, 6) AS fulfillment_rate, round(stockouts, 6) AS stockouts, "
             "round(stockout_penalty, 6) AS stockout_penalty, round(holding_cost, 6) AS holding_cost, "
             "round(total_cost, 6) AS total_cost")

ORACLES["replay_ledger"] = with_prelude(_LEDGER + "," + _REPLAY, """
SELECT store_id, item_id, day, round(demand, 6) AS demand, round(arrivals, 6) AS arrivals,
  round(sales, 6) AS sales, round(stockout, 6) AS stockout, round(end_stock, 6) AS end_stock,
  round(holding_cost, 6) AS holding_cost, round(stockout_penalty, 6) AS stockout_penalty FROM replay""")
ORACLES["daily_kpis"] = with_prelude(_LEDGER + "," + _REPLAY + "," + _daily("replay", "dk"),
                                     f"SELECT {_KPI_COLS} FROM dk")
ORACLES["summary_kpis"] = with_prelude(_LEDGER + "," + _REPLAY + "," + _daily("replay", "dk"), _summary("dk"))
ORACLES["warehouse_drawdown"] = with_prelude(_LEDGER + "," + _ALLOC + """,
per_day AS (SELECT item_id, day, sum(demand) AS ordered FROM demand_daily GROUP BY item_id, day),
dd AS (
  SELECT p.item_id, p.day, p.ordered, w.qty AS start_qty,
    sum(p.ordered) OVER (PARTITION BY p.item_id ORDER BY p.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM per_day p JOIN (SELECT item_id, sum(qty) AS qty FROM wh GROUP BY item_id) w ON p.item_id = w.item_id)""", """
SELECT item_id, day, round(ordered, 6) AS ordered, round(greatest(0.0, start_qty - cum), 6) AS remaining,
  round(greatest(0.0, cum - start_qty), 6) AS shortfall FROM dd""")


ORACLES["compare_policies"] = with_prelude(_LEDGER + "," + _ALLOC + f""",
pdem AS (SELECT store_id, item_id, forecasted_demand * {_MEAN_LT} AS demand FROM position),
pinv AS (SELECT store_id, item_id, position AS qty FROM position),""" + _alloc_ctes("pdem", "pinv", "wh", "ordered", "al") + f""",
placed AS (
  SELECT 'naive' AS policy, store_id, item_id, forecasted_demand * {_MEAN_LT + P.NAIVE_BUFFER_DAYS} - stock - in_transit AS q FROM position
  UNION ALL SELECT 'minmax', store_id, item_id, CASE WHEN position < forecasted_demand * {P.MIN_DAYS_SUPPLY}
    THEN forecasted_demand * {P.MAX_DAYS_SUPPLY} - position ELSE 0 END FROM position
  UNION ALL SELECT 'allocation', store_id, item_id, x FROM al),
netted AS (
  SELECT n.policy, greatest(coalesce(p.q, 0.0), 0.0) AS q, greatest(0.0, forecasted_demand * {_MEAN_LT} - position
    - greatest(coalesce(p.q, 0.0), 0.0)) AS short
  FROM position o CROSS JOIN (VALUES ('naive'), ('minmax'), ('allocation')) n(policy)
  LEFT JOIN placed p ON p.policy = n.policy AND p.store_id = o.store_id AND p.item_id = o.item_id)""", f"""
SELECT policy, CAST(sum(CAST(q > 0 AS BIGINT)) AS BIGINT) AS n_orders, round(sum(q), 4) AS units,
  round(sum(q) * {P.TRANSPORT_COST}, 4) AS transport_cost, round(sum(short), 4) AS short_units,
  round(sum(short) * {P.STOCKOUT_PENALTY}, 4) AS shortage_cost
FROM netted GROUP BY policy""")

ORACLES["read_calendar"] = with_prelude("", """
SELECT date, wm_yr_wk, weekday, wday, month, year, d, event_name_1, event_type_1, event_name_2, event_type_2,
  snap_AF AS snap_CA, snap_AM AS snap_TX, snap_AS AS snap_WI FROM calendar""")
ORACLES["read_prices"] = with_prelude("", "SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices")
ORACLES["read_sales_wide"] = ORACLES["melt_sales"]
ORACLES["price_change_pct_padded"] = with_prelude("""
padded AS (SELECT *, last_value(sell_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM prepared),
shifted AS (SELECT *, lag(p, 7) OVER (PARTITION BY store_id, item_id ORDER BY date) AS q FROM padded)""",
    "SELECT store_id, item_id, date, round(sell_price, 6) AS sell_price, "
    "round(p / nullif(q, 0) - 1, 6) AS price_change_pct FROM shifted")

ORACLES["date_semi_join"] = with_prelude(_feature_ctes() + ",\n" + _FM + "," + _DATES + "," + _FOLDS, f"""
SELECT store_id, item_id, date, round(sales, 6) AS sales, round(lag_7, 6) AS lag_7 FROM fm
WHERE date IN (SELECT date FROM cvf WHERE fold = {P.CV_SPLITS} AND role = 'test')""")

ORACLES["day_slice"] = with_prelude(_LEDGER, """
SELECT store_id, item_id, day, demand FROM demand_daily WHERE day = (SELECT t FROM snap_day)""")


def _dense_prelude() -> str:
    """The shared prelude over the dense grid: every series x every calendar day,
    0 sales where none."""
    return prelude().replace(
        "joined AS (\n  SELECT s.id,",
        "dense AS (\n  SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, c.d,\n"
        "    coalesce(sd.sales, 0.0) AS sales\n"
        "  FROM (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM sales_daily) s\n"
        "  CROSS JOIN calendar c LEFT JOIN sales_daily sd ON sd.id = s.id AND sd.d = c.d),\n"
        "joined AS (\n  SELECT s.id,").replace("FROM sales_daily s LEFT JOIN calendar c ON s.d = c.d",
                                                 "FROM dense s LEFT JOIN calendar c ON s.d = c.d")


def _dense_feature_query() -> str:
    """Features over the dense grid: the wide -> melt path."""
    cols = KEYS + ["sales", "sell_price", "lag_7", "lag_28", "rolling_mean_7", "rolling_std_28",
                   "price_rel_mean", "price_change_pct", "snap_active", "event_type_encoded"]
    return (f"WITH RECURSIVE{_dense_prelude()},\n{_feature_ctes()}\n"
            f"SELECT {_cols(cols)} FROM featured WHERE n_obs >= {P.MIN_GROUP_ROWS}")


ORACLES["feature_job_wide"] = _dense_feature_query()

ORACLES["read_prices_folder"] = ORACLES["read_prices"]
ORACLES["csv_rejects"] = with_prelude("", """
SELECT store_id, count(*) FILTER (NOT bad) AS n_rows, CAST(coalesce(sum(cents) FILTER (NOT bad), 0) AS BIGINT) AS cents,
  count(*) FILTER (bad) AS n_rejected
FROM (SELECT store_id, CAST(round(sell_price * 100) AS BIGINT) AS cents,
        coalesce(CAST(round(sell_price * 100) AS BIGINT) % 5 = 0 OR CAST(round(sell_price * 100) AS BIGINT) % 7 = 0, FALSE) AS bad FROM prices)
GROUP BY store_id""")


def _recursive_ledger(tag: str, demand: str, arrivals: str, keys: tuple, initial: str = "linit") -> str:
    """CTE ``tag``: a stock ledger walked row by row, from ``demand (keys, day,
    demand)`` and ``arrivals (keys, day, qty)``, one row a day each."""
    on = lambda x, y: " AND ".join(f"{x}.{k} = {y}.{k}" for k in keys)
    cols = ", ".join(f"coalesce(d.{k}, a.{k}) AS {k}" for k in keys)
    listed = ", ".join(f"e.{k}" for k in keys)
    stock = lambda prior: f"{prior} + e.arrivals - least(e.demand, {prior} + e.arrivals)"
    return f"""
{tag}_ev AS (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY day) AS rn FROM (
    SELECT {cols}, coalesce(d.day, a.day) AS day, coalesce(d.demand, 0.0) AS demand, coalesce(a.qty, 0.0) AS arrivals,
      CAST(d.demand IS NOT NULL AS INT) AS has_demand
    FROM {demand} d FULL JOIN {arrivals} a ON {on('d', 'a')} AND d.day = a.day)),
{tag}_rec AS (
  SELECT {listed}, e.rn, e.day, e.demand, e.has_demand, least(e.demand, coalesce(i.qty, 0.0) + e.arrivals) AS sales,
    {stock('coalesce(i.qty, 0.0)')} AS end_stock
  FROM {tag}_ev e LEFT JOIN {initial} i ON e.store_id = i.store_id AND e.item_id = i.item_id WHERE e.rn = 1
  UNION ALL
  SELECT {listed}, e.rn, e.day, e.demand, e.has_demand, least(e.demand, r.end_stock + e.arrivals), {stock('r.end_stock')}
  FROM {tag}_rec r JOIN {tag}_ev e ON {on('e', 'r')} AND e.rn = r.rn + 1),
{tag} AS (
  SELECT {', '.join(keys)}, day, demand, sales, demand - sales AS stockout, end_stock,
    end_stock * {P.HOLDING_COST} * has_demand AS holding_cost, (demand - sales) * {P.STOCKOUT_PENALTY} AS stockout_penalty
  FROM {tag}_rec)"""


_INITIAL = f"""
linit AS (
  SELECT store_id, item_id, CAST(ceil(greatest(0.0, coalesce(avg(demand), 0.0)) * {P.LEDGER_MULTIPLIER}) AS DOUBLE) AS qty
  FROM demand_daily GROUP BY store_id, item_id),
horizon AS (SELECT CAST(date_diff('day', lo, hi) + 1 AS INT) AS n FROM bounds)"""

# Interval join of the mornings with the orders open on them; stock as of the evening before.
ORACLES["open_positions"] = with_prelude(_LEDGER + "," + _INITIAL + f""",
placed AS (
  SELECT store_id, item_id, day, demand AS qty, day + {_lead_time('day', 'store_id')} AS arrival_day
  FROM demand_daily WHERE demand > 0),
came AS (SELECT store_id, item_id, arrival_day AS day, sum(qty) AS qty FROM placed
         WHERE arrival_day < (SELECT n FROM horizon) GROUP BY ALL),""" + _recursive_ledger("lg", "demand_daily", "came", ("store_id", "item_id")) + """,
series AS (SELECT store_id, item_id FROM placed UNION SELECT store_id, item_id FROM demand_daily UNION SELECT store_id, item_id FROM linit),
mornings AS (SELECT store_id, item_id, CAST(unnest(range(0, (SELECT n FROM horizon))) AS INT) AS day FROM series),
opened AS (
  SELECT m.store_id, m.item_id, m.day, sum(p.qty) AS in_transit
  FROM mornings m JOIN placed p ON p.store_id = m.store_id AND p.item_id = m.item_id AND p.day < m.day AND p.arrival_day >= m.day
  GROUP BY ALL),
held AS (
  SELECT m.store_id, m.item_id, m.day, coalesce(l.end_stock, i.qty, 0.0) AS stock
  FROM mornings m ASOF LEFT JOIN lg l ON m.store_id = l.store_id AND m.item_id = l.item_id AND m.day > l.day
  LEFT JOIN linit i ON m.store_id = i.store_id AND m.item_id = i.item_id)""", """
SELECT h.store_id, h.item_id, h.day, round(coalesce(o.in_transit, 0.0), 6) AS in_transit, round(h.stock, 6) AS stock,
  round(h.stock + coalesce(o.in_transit, 0.0), 6) AS position
FROM held h LEFT JOIN opened o ON h.store_id = o.store_id AND h.item_id = o.item_id AND h.day = o.day""")

_POLICY_ROWS = ", ".join(f"('{name}', {days}, {share})" for name, (days, share) in P.RECORDED_POLICIES.items())


def _recorded() -> str:
    due = _lead_time("day", "store_id")
    return f"""
rules AS (SELECT * FROM (VALUES {_POLICY_ROWS}) r(policy, days, share)),
placed AS (
  SELECT policy, store_id, item_id, day, qty, day + {due} AS arrival_day FROM (
    SELECT policy, store_id, item_id, CAST((day // days) * days + days - 1 AS INT) AS day, CAST(floor(sum(demand * share)) AS DOUBLE) AS qty
    FROM demand_daily CROSS JOIN rules GROUP BY ALL) WHERE qty > 0),
came AS (SELECT policy, store_id, item_id, arrival_day AS day, sum(qty) AS qty FROM placed
         WHERE arrival_day < (SELECT n FROM horizon) GROUP BY ALL),
asked AS (SELECT policy, store_id, item_id, day, demand FROM demand_daily CROSS JOIN rules)"""


ORACLES["policy_kpis"] = with_prelude(
    _LEDGER + "," + _INITIAL + "," + _recorded() + "," + _recursive_ledger("lg", "asked", "came", ("policy", "store_id", "item_id")) + """,
agg AS (SELECT policy, day, sum(demand) AS d, sum(sales) AS s, sum(stockout) AS so, sum(stockout_penalty) AS sp, sum(holding_cost) AS hc
        FROM lg GROUP BY ALL),
mornings AS (SELECT policy, CAST(unnest(range(0, (SELECT n FROM horizon))) AS INT) AS day FROM rules),
dk AS (
  SELECT m.policy, m.day, CASE WHEN coalesce(a.d, 0.0) > 0 THEN a.s / a.d ELSE 1.0 END AS fulfillment_rate,
    coalesce(a.so, 0.0) AS stockouts, coalesce(a.sp, 0.0) AS stockout_penalty, coalesce(a.hc, 0.0) AS holding_cost,
    coalesce(a.hc, 0.0) + coalesce(a.sp, 0.0) AS total_cost
  FROM mornings m LEFT JOIN agg a ON m.policy = a.policy AND m.day = a.day)""", _summary("dk", "policy"))

_LAST = f"cvf WHERE fold = {P.CV_SPLITS} AND role = 'test'"
ORACLES["model_roundtrip"] = with_prelude(
    _feature_ctes() + ",\n" + _FM + "," + _DATES + "," + _FOLDS,
    f"SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_diff, CAST(0 AS BIGINT) AS n_null FROM fm WHERE date IN (SELECT date FROM {_LAST})")
ORACLES["training_job"] = with_prelude(
    _feature_ctes() + ",\n" + _FM + "," + _DATES + "," + _FOLDS,
    "SELECT CAST((SELECT count(DISTINCT fold) FROM cvf) AS INT) AS n_folds, count(*) AS n_scored, count(*) AS n_predicted, TRUE AS measured FROM fm")
ORACLES["gbt_training_check"] = ORACLES["cv_metrics"].replace(
    "SELECT round(avg(rmse), 6) AS rmse, round(avg(wmape), 6) AS wmape, count(*) AS n_folds ",
    "SELECT count(*) AS n_folds, round(avg(wmape), 6) AS wmape_average, TRUE AS trees_better, TRUE AS loss_falls ")

_CODED = ("dept_id", "cat_id", "state_id")


def _codes(column: str) -> str:
    """Codes of the four stores' values: most frequent first, ties by name."""
    stores = ", ".join(repr(x) for x in P.FILTER_STORES)
    return f"""
code_{column} AS (
  SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS INT) AS code, CAST(count(*) OVER () AS INT) AS unseen
  FROM (SELECT {column} AS v, count(*) AS n FROM fm WHERE store_id IN ({stores}) AND {column} IS NOT NULL GROUP BY 1))"""


_NUMERIC = ["sell_price", "day_of_week", "month", "week_of_year", "day_of_month", "is_weekend", "quarter", "year", "has_event",
            "event_type_encoded", "snap_active", *_NULL_COLS]
ORACLES["feature_target_split"] = with_prelude(
    _feature_ctes() + ",\n" + _FM + "," + ",".join(_codes(c) for c in _CODED),
    "SELECT store_id, item_id, date, round(sales, 6) AS target, "
    + " + ".join(f"CAST({c} IS NULL AS INT)" for c in _NUMERIC) + " AS n_missing, "
    + ", ".join(f"coalesce((SELECT code FROM code_{c} WHERE v = fm.{c}), (SELECT coalesce(max(unseen), 0) FROM code_{c})) AS {c}_code" for c in _CODED)
    + " FROM fm")

ORACLES["price_rel_mean_as_of"] = with_prelude("""
per_day AS (SELECT item_id, date, sum(sell_price) AS s, count(sell_price) AS n FROM prepared GROUP BY item_id, date),
before AS (
  SELECT a.item_id, a.date, sum(b.s) / nullif(sum(b.n), 0) AS mean
  FROM per_day a LEFT JOIN per_day b ON a.item_id = b.item_id AND b.date < a.date GROUP BY a.item_id, a.date)""", """
SELECT p.store_id, p.item_id, p.date, round(p.sell_price, 6) AS sell_price, round(p.sell_price / nullif(b.mean, 0), 6) AS price_rel_mean
FROM prepared p JOIN before b ON p.item_id = b.item_id AND p.date = b.date""")

ORACLES["feature_job_report"] = with_prelude(
    _feature_ctes() + ",\n" + _FM,
    "SELECT (SELECT count(*) FROM featured) AS rows_in, (SELECT count(*) FROM featured) - count(*) AS rows_dropped, count(*) AS n_rows, "
    + ", ".join(f"CAST(coalesce(sum(CAST({c} IS NULL AS BIGINT)), 0) AS BIGINT) AS null_{c}" for c in _NULL_COLS) + " FROM fm")

ORACLES["feature_job_files"] = f"""WITH RECURSIVE{_dense_prelude()},
{_feature_ctes()},
bare AS (SELECT count(*) AS n FROM joined WHERE store_id = '{P.FILTER_STORES[0]}' AND sell_price IS NULL)
SELECT store_id, count(*) AS n_rows, round(sum(sales), 6) AS total_sales, round(sum(lag_28), 6) AS total_lag_28,
  CASE WHEN store_id = '{P.FILTER_STORES[0]}' THEN (SELECT n FROM bare) ELSE count(*) FILTER (sell_price IS NULL) END AS null_prices
FROM featured WHERE n_obs >= {P.MIN_GROUP_ROWS} GROUP BY store_id"""
