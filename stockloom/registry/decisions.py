"""Queries for reconciliation, intervals, inventory, drift, explanations and outputs."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions import normal
from stockloom.operators import (
    boosting,
    backtest as D, deep_tree, drift as H, explain as X, features as B, forecast as C, hierarchy as E,
    intervals as I, inventory as G, resumable, trees,
)
from stockloom.plans import planning
from stockloom.plans.forecasting import forecast, plan_from_forecast, plan_from_states
from stockloom.registry.base import query, rounded, stock_on_hand
from stockloom.registry.features import FEATURE_SQL, LAGGED
from stockloom.registry.forecasts import (
    COMING, ETS_FIT, LAST, POOLED, SEASONAL,
)
from stockloom.sources import retail as R

ORDER = "PARTITION BY store_id, item_id ORDER BY day_no"
STEPS = 14


def _z(p: float) -> str:
    return repr(NormalDist().inv_cdf(p))


def phi_sql(z: str) -> str:
    return f"(exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()))"


def cdf_sql(z: str) -> str:
    """Normal distribution by Marsaglia's series, a different formula than the library's."""
    return f"""(CASE WHEN ({z}) > 8 THEN 1.0 WHEN ({z}) < -8 THEN 0.0 ELSE 0.5 + {phi_sql(z)} * list_reduce(
      [{{'k': k::DOUBLE, 't': 0.0::DOUBLE, 's': 0.0::DOUBLE}} FOR k IN range(1, 130)],
      lambda a, x: {{'k': x.k, 't': a.t * ({z}) * ({z}) / (2 * x.k + 1), 's': a.s + a.t * ({z}) * ({z}) / (2 * x.k + 1)}},
      {{'k': 0.0::DOUBLE, 't': ({z})::DOUBLE, 's': ({z})::DOUBLE}}).s END)"""


# ---- hierarchy -------------------------------------------------------------------

NODES = """
tree AS (SELECT DISTINCT n_name AS store_id, r_name AS state_id FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
node_days AS (
  SELECT 'total' AS level, 'Total' AS node, day_no, sum(sales) AS sales FROM panel GROUP BY ALL
  UNION ALL SELECT 'state', state_id, day_no, sum(sales) FROM panel GROUP BY ALL
  UNION ALL SELECT 'store', store_id, day_no, sum(sales) FROM panel GROUP BY ALL),
node_ends AS (SELECT max(day_no) AS n FROM panel),
base AS (
  SELECT level, node, step, avg(sales) AS yhat FROM node_days, node_ends, coming
    WHERE (level = 'total' AND day_no > n - 28) OR (level = 'state' AND day_no > n - 7) GROUP BY ALL
  UNION ALL SELECT level, node, step, sales FROM node_days, node_ends, coming
    WHERE level = 'store' AND day_no = n - 7 + (step - 1) % 7 + 1),
own AS (SELECT t.store_id, t.state_id, c.step, coalesce(b.yhat, 0) AS own FROM tree t CROSS JOIN coming c
  LEFT JOIN base b ON b.level = 'store' AND b.node = t.store_id AND b.step = c.step)"""


def _sum_up_sql(table: str, value: str) -> str:
    return f"""
SELECT 'total' AS level, 'Total' AS node, step, round(sum({value}), 6) AS yhat FROM {table} GROUP BY ALL
UNION ALL SELECT 'state', state_id, step, round(sum({value}), 6) FROM {table} GROUP BY ALL
UNION ALL SELECT 'store', store_id, step, round(sum({value}), 6) FROM {table} GROUP BY ALL"""


def _base(retail):
    """Deliberately incoherent base forecasts of every node."""
    nodes = E.node_sales(retail.series)
    level = F.col("store_id")
    return E.as_base(C.from_tails(C.tails(nodes, 28), STEPS, lambda tail, step: (
        F.when(level == E.TOTAL, C.mean_of_last(tail, 28)).when(level == E.STATE, C.mean_of_last(tail, 7))
        .otherwise(C.seasonal_value(tail, step)))))


def _mapping(retail):
    return retail.stores.select("store_id", "state_id").distinct()


@query("e01_tree_nodes", """
SELECT 'total' AS level, 'Total' AS node, CAST(NULL AS VARCHAR) AS parent
UNION ALL SELECT DISTINCT 'state', state_id, 'Total' FROM tree UNION ALL SELECT 'store', store_id, state_id FROM tree
""", COMING, NODES)
def tree_nodes(retail):
    return E.tree_nodes(_mapping(retail))


@query("e02_bottom_up", _sum_up_sql("own", "own"), COMING, NODES)
def bottom_up(retail):
    return rounded(E.bottom_up(_base(retail), _mapping(retail), STEPS))


SHARES = """
shares AS (SELECT store_id, sum(sales) / (SELECT sum(sales) FROM panel) AS share FROM panel GROUP BY ALL)"""


@query("e03_top_down", _sum_up_sql("split", "v"), COMING, NODES, SHARES, """
split AS (SELECT t.store_id, t.state_id, b.step, b.yhat * coalesce(s.share, 1.0 / (SELECT count(*) FROM tree)) AS v
  FROM tree t CROSS JOIN (SELECT * FROM base WHERE level = 'total') b
  LEFT JOIN shares s ON s.store_id = t.store_id)""")
def top_down(retail):
    shares = E.historical_shares(retail.series)
    return rounded(E.top_down(_base(retail), _mapping(retail), shares, STEPS))


# The unit tests compare this block form with a dense summing matrix.
@query("e04_least_squares", """
SELECT level, node, step, round(greatest(0, sum(beta)), 6) AS yhat FROM (
  SELECT unnest(['total', 'state', 'store']) AS level, unnest(['Total', state_id, store_id]) AS node, step, beta FROM solved)
GROUP BY ALL""", COMING, NODES, """
b AS (SELECT o.store_id, o.state_id, o.step, o.own + coalesce(st.yhat, 0) + coalesce(tt.yhat, 0) AS b,
    count(*) OVER (PARTITION BY o.state_id, o.step) AS n FROM own o
  LEFT JOIN base st ON st.level = 'state' AND st.node = o.state_id AND st.step = o.step
  LEFT JOIN base tt ON tt.level = 'total' AND tt.step = o.step),
x AS (SELECT *, b - sum(b) OVER (PARTITION BY state_id, step) / (1 + n) AS x,
    sum(1.0 / (1 + n)) OVER (PARTITION BY step) AS c FROM b),
solved AS (SELECT *, x - (1.0 / (1 + n)) * sum(x) OVER (PARTITION BY step) / (1 + c) AS beta FROM x)""")
def least_squares(retail):
    return rounded(E.least_squares(_base(retail), _mapping(retail), STEPS))


_LEVELS = ["", " || '/' || state_id", " || '/' || state_id || '/' || store_id", " || '/' || state_id || '/' || store_id || '/' || item_id"]
_DEEP = ["""
paths AS (SELECT DISTINCT state_id, store_id, item_id FROM panel)""", "deep_days AS (" + " UNION ALL ".join(
    f"SELECT {k} AS level, 'Total'{path} AS node, day_no, sum(sales) AS sales FROM panel GROUP BY ALL" for k, path in enumerate(_LEVELS)) + ")", """
deep_base AS (
  SELECT level, node, step, avg(sales) AS own FROM deep_days, node_ends, coming
    WHERE (level IN (0, 2) AND day_no > n - 28) OR (level = 1 AND day_no > n - 7) GROUP BY ALL
  UNION ALL SELECT level, node, step, sales FROM deep_days, node_ends, coming
    WHERE level = 3 AND day_no = n - 7 + (step - 1) % 7 + 1),
deep_nodes AS (SELECT *, CASE WHEN level > 0 THEN regexp_replace(node, '/[^/]*$', '') END AS parent FROM deep_base),
up3 AS (SELECT *, CAST(NULL AS DOUBLE) AS held, CAST(NULL AS DOUBLE) AS spread, own AS total, 1.0::DOUBLE AS variance FROM deep_nodes WHERE level = 3)""",
         *(f"""
up{k} AS (SELECT n.*, held, spread, (held + spread * own) / (1 + spread) AS total, spread / (1 + spread) AS variance FROM deep_nodes n
  JOIN (SELECT parent AS node, step, sum(total) AS held, sum(variance) AS spread FROM up{k + 1} GROUP BY ALL) USING (node, step) WHERE level = {k})"""
           for k in (2, 1, 0)), "down0 AS (SELECT *, total AS yhat FROM up0)", *(f"""
down{k} AS (SELECT u.*, u.total + u.variance * (a.yhat - a.held) / a.spread AS yhat FROM up{k} u JOIN down{k - 1} a ON a.node = u.parent AND a.step = u.step)"""
           for k in (1, 2, 3))]


@query("e04_any_depth", " UNION ALL ".join(
    f"SELECT node, CAST({k} AS INTEGER) AS level, step, round(greatest(0, yhat), 6) AS yhat FROM down{k}" for k in range(4)), COMING, NODES, *_DEEP)
def any_depth(retail):
    """Total, states, stores and their products made to agree in one least-squares solution."""
    nested = ["state_id", "store_id", "item_id"]
    parents = deep_tree.path_parents(retail.series, nested)
    paths = F.array(*(F.struct(F.lit(str(k)).alias("store_id"), F.concat_ws("/", F.lit("Total"), *nested[:k]).alias("item_id")) for k in range(4)))
    days = retail.series.select("date", F.col("sales").cast("double").alias("sales"), F.explode(paths).alias("node")).groupBy(
        "node.store_id", "node.item_id", "date").agg(F.sum("sales").alias("sales"))
    level = F.col("store_id")
    base = C.from_tails(C.tails(days, 28), STEPS, lambda tail, step: (
        F.when(level.isin("0", "2"), C.mean_of_last(tail, 28)).when(level == "1", C.mean_of_last(tail, 7)).otherwise(C.seasonal_value(tail, step))))
    return rounded(deep_tree.reconcile(base.select(F.col("item_id").alias("node"), "step", "yhat"), parents))


@query("e05_historical_shares", "SELECT store_id, round(share, 9) AS share FROM shares", SHARES)
def historical_shares(retail):
    return rounded(E.historical_shares(retail.series), 9)


# ---- intervals -------------------------------------------------------------------

RESIDUALS = f"""
residuals AS (SELECT store_id, item_id, date, sales - lag(sales, 7) OVER ({ORDER}) AS residual, day_no FROM panel
  QUALIFY day_no > 14),
spread AS (SELECT store_id, item_id, stddev_pop(residual) AS sigma, count(*) AS m FROM residuals GROUP BY ALL)"""


@query("f01_residuals", "SELECT store_id, item_id, date, residual FROM residuals", RESIDUALS)
def residuals(retail):
    return I.seasonal_residuals(retail.series)


def _bands(retail, confidence=0.8):
    return I.prediction_intervals(
        C.seasonal_naive(retail.series, STEPS), I.residual_spread(I.seasonal_residuals(retail.series)), confidence)


def _bands_sql(sigma: str, z: str, confidence: str) -> str:
    return f"""
SELECT store_id, item_id, step, date, round({sigma}, 6) AS sigma, round(greatest(0, yhat - {z} * {sigma}), 6) AS p10,
  yhat AS p50, round(yhat + {z} * {sigma}, 6) AS p90, {confidence} AS confidence
FROM seasonal JOIN spread USING (store_id, item_id)"""


@query("f02_intervals", _bands_sql("sigma", _z(0.9), "CAST(0.8 AS DOUBLE)"), LAST, COMING, SEASONAL, RESIDUALS)
def intervals(retail):
    return rounded(_bands(retail))


@query("f02_intervals_by_series", _bands_sql(
    "sigma", f"(CASE WHEN item_id = 'PROMO' THEN {_z(0.975)} ELSE {_z(0.85)} END)",
    "CAST(CASE WHEN item_id = 'PROMO' THEN 0.95 ELSE 0.7 END AS DOUBLE)"), LAST, COMING, SEASONAL, RESIDUALS)
def intervals_by_series(retail):
    return rounded(_bands(retail, F.when(F.col("item_id") == "PROMO", 0.95).otherwise(0.7)))


@query("f03_sigma_fallback", """
SELECT store_id, item_id, step, round(CASE WHEN coalesce(m, 0) > 1 THEN sigma
  ELSE greatest(1, 0.15 * avg(yhat) OVER (PARTITION BY store_id, item_id)) END, 6) AS sigma
FROM seasonal LEFT JOIN spread USING (store_id, item_id)
""", LAST, COMING, SEASONAL, RESIDUALS)
def sigma_fallback(retail):
    """Sigma of every series: of its residuals where it has two or more, of its forecast where it has not."""
    made = I.prediction_intervals(C.seasonal_naive(retail.series, STEPS), I.residual_spread(I.seasonal_residuals(retail.series)))
    return rounded(made.select(*V.SERIES, "step", "sigma"))


HOLDOUT = f"""
cut AS (SELECT max(day_no) - {STEPS} AS n FROM panel),
train AS (SELECT * FROM panel WHERE day_no <= (SELECT n FROM cut)),
errors AS (SELECT store_id, item_id, stddev_pop(r) AS sigma FROM (
  SELECT *, sales - lag(sales, 7) OVER ({ORDER}) AS r FROM train QUALIFY day_no > 14) GROUP BY ALL),
scored AS (SELECT a.store_id, a.item_id, a.sales AS y, p.sales AS f, e.sigma,
    greatest(0, p.sales - {_z(0.9)} * e.sigma) AS lo, p.sales + {_z(0.9)} * e.sigma AS hi
  FROM panel a JOIN errors e USING (store_id, item_id)
  JOIN panel p ON p.store_id = a.store_id AND p.item_id = a.item_id
    AND p.day_no = (SELECT n FROM cut) - 7 + (a.day_no - (SELECT n FROM cut) - 1) % 7 + 1
  WHERE a.day_no > (SELECT n FROM cut))"""


def _scores(retail):
    last_day = retail.last_day
    known = retail.series.where(F.col("date") <= F.date_sub(last_day, STEPS))
    made = I.prediction_intervals(
        C.seasonal_naive(known, STEPS), I.residual_spread(I.seasonal_residuals(known)))
    held_out = retail.series.where(F.col("date") > F.date_sub(last_day, STEPS)).select(
        *V.SERIES, "date", F.col("sales").alias("actual"))
    return I.interval_scores(made.join(held_out, [*V.SERIES, "date"]))


@query("f04_coverage", 'SELECT store_id, item_id, round(avg((y BETWEEN lo AND hi)::INTEGER), 6) AS "Coverage" FROM scored GROUP BY ALL', HOLDOUT)
def coverage(retail):
    return rounded(_scores(retail).select(*V.SERIES, "Coverage"))


@query("f05_width", 'SELECT store_id, item_id, round(avg(hi - lo), 6) AS "IntervalWidth" FROM scored GROUP BY ALL', HOLDOUT)
def width(retail):
    return rounded(_scores(retail).select(*V.SERIES, "IntervalWidth"))


_CRPS_Z = "((y - f) / sigma)"


@query("f06_crps", f"""
SELECT store_id, item_id, round(avg(sigma * ({_CRPS_Z} * (2 * {cdf_sql(_CRPS_Z)} - 1) + 2 * {phi_sql(_CRPS_Z)}
  - 1 / sqrt(pi()))), 6) AS "CRPS" FROM scored GROUP BY ALL
""", HOLDOUT)
def crps(retail):
    return rounded(_scores(retail).select(*V.SERIES, "CRPS"))


@query("f07_normal", f"""
SELECT event_id, round({phi_sql('z')}, 6) AS density, round({cdf_sql('z')}, 6) AS distribution,
  round({phi_sql('z')} - z * (1 - {cdf_sql('z')}), 6) AS loss, round({cdf_sql('z')}, 6) AS back
FROM (SELECT event_id, (value - 60) / 60 AS z FROM events)
""")
def normal_functions(retail):
    z = F.col("z")
    p = normal.distribution(z)
    rows = retail.table("events").select("event_id", ((F.col("value") - 60) / 60).alias("z")).withColumn("p", p)
    return rounded(rows.select(
        "event_id", normal.density(z).alias("density"), p.alias("distribution"), normal.loss(z).alias("loss"),
        normal.distribution(normal.quantile(F.least(F.col("p"), F.lit(1 - 1e-16)))).alias("back")))


# ---- inventory -------------------------------------------------------------------

POLICY = f"""
stock AS (SELECT store_id, item_id, greatest(0.1, avg(sales)) AS m, greatest(0.1, stddev_pop(sales)) AS sd,
    sum(sales) FILTER (day_no > n - 3) AS on_hand, sum(sales) FILTER (day_no = n) AS on_order
  FROM panel JOIN (SELECT store_id, item_id, n FROM last) USING (store_id, item_id) GROUP BY ALL),
lead_demand AS (SELECT *, m * 3 AS lm, greatest(0.5, sd * sqrt(3)) AS ls, on_hand + on_order AS pos FROM stock),
levels AS (SELECT *, {_z(0.95)} * ls AS ss, lm + {_z(0.95)} * ls AS rop,
    m * 10 + {_z(0.95)} * greatest(0.5, sd * sqrt(10)) AS s_up,
    lm + {_z(1.5 / (1.5 + 0.1 * 3))} * ls AS nv, (on_hand - lm) / ls AS z FROM lead_demand),
policy AS (SELECT *, ls * ({phi_sql('z')} - z * (1 - {cdf_sql('z')})) AS short,
  CASE WHEN on_hand < ss THEN 'Understock Alert' WHEN on_hand > s_up THEN 'Overstock Alert' ELSE 'Healthy' END AS health
  FROM levels)"""


def _policies(retail):
    stats = G.demand_stats(retail.series).join(stock_on_hand(retail.series), V.SERIES)
    return G.policies(stats)


def _policy_query(name: str, sql: str, *columns: str):
    @query(name, f"SELECT store_id, item_id, {sql} FROM policy", LAST, POLICY)
    def run(retail):
        return rounded(_policies(retail).select(*V.SERIES, *columns))
    return run


_policy_query("g01_demand_stats", "round(m, 6) AS demand_mean, round(sd, 6) AS demand_std", "demand_mean", "demand_std")
_policy_query("g02_lead_time_demand", "round(lm, 6) AS ltd_mean, round(ls, 6) AS ltd_std", "ltd_mean", "ltd_std")
_policy_query("g03_safety_stock", "round(ss, 6) AS safety_stock", "safety_stock")
_policy_query("g04_reorder_point", "round(rop, 6) AS reorder_point", "reorder_point")
_policy_query("g05_inventory_position", "pos AS inventory_position", "inventory_position")
_policy_query("g06_periodic_order", "round(s_up, 6) AS order_up_to_level, round(greatest(0, s_up - pos), 6) AS order_out",
              "order_up_to_level", "order_out")
_policy_query("g07_s_s_order", "round(CASE WHEN pos <= rop THEN s_up - pos ELSE 0 END, 6) AS order_s_s", "order_s_s")
_policy_query("g08_newsvendor", "round(nv, 6) AS newsvendor_level, round(greatest(0, nv - pos), 6) AS order_newsvendor",
              "newsvendor_level", "order_newsvendor")
_policy_query("g09_expected_shortage", "round(short, 6) AS expected_shortage", "expected_shortage")
_policy_query("g10_costs", "round(on_hand * 0.1 * 3, 6) AS holding_cost, round(short * 1.5, 6) AS stockout_cost",
              "holding_cost", "stockout_cost")
_policy_query("g11_health", "health AS inventory_health, on_hand < ss AS under_stock_alert",
              "inventory_health", "under_stock_alert")

_LEADS = "CASE " + " ".join(f"WHEN length(item_id) = {n} THEN {{}}" for n in (5, 6, 7, 8)) + " END"


@query("g08_newsvendor_by_series", f"""
SELECT store_id, item_id, round(m * lt + ({_LEADS.format(*(_z(2.0 / (2.0 + 0.1 * n)) for n in (5, 6, 7, 8)))})
  * greatest(0.5, sd * sqrt(lt)), 6) AS newsvendor_level FROM (SELECT *, length(item_id) AS lt FROM stock)
""", LAST, POLICY)
def newsvendor_by_series(retail):
    stats = G.demand_stats(retail.series).join(stock_on_hand(retail.series), V.SERIES)
    made = G.policies(stats, lead_time=F.length("item_id"), stockout_cost=2.0)
    return rounded(made.select(*V.SERIES, "newsvendor_level"))


@query("g12_simple_order", """
SELECT store_id, item_id, sum(yhat) AS demand_sum, any_value(on_hand) AS on_hand,
  greatest(0, sum(yhat) - any_value(on_hand) + 15) AS recommended_order, any_value(on_hand) < 15 AS under_stock_alert
FROM seasonal JOIN stock USING (store_id, item_id) GROUP BY ALL
""", LAST, COMING, SEASONAL, POLICY)
def simple_order(retail):
    demand = C.seasonal_naive(retail.series, STEPS).groupBy(*V.SERIES).agg(F.sum("yhat").alias("demand_sum"))
    stock = stock_on_hand(retail.series).drop("on_order").withColumn("buffer", F.lit(15.0))
    return G.simple_order(demand.join(stock, V.SERIES)).drop("buffer")


FINE_POLICY = f"""
lines AS (SELECT n_name AS store_id, r_name AS state_id, p_brand AS brand, p_type AS kind, CAST(l_shipdate AS DATE) AS date,
    l_quantity AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
fine AS (SELECT store_id, state_id, brand, kind, sum(q) AS t, sum(q * q) AS tt,
    coalesce(sum(q) FILTER (date > hi - 20), 0) AS on_hand FROM (
      SELECT store_id, state_id, brand, kind, date, sum(q) AS q FROM lines GROUP BY ALL) CROSS JOIN bounds GROUP BY ALL),
fine_stats AS (SELECT *, greatest(0.1, t / d) AS m, greatest(0.1, sqrt(greatest(0, tt / d - (t / d) * (t / d)))) AS sd
  FROM fine CROSS JOIN (SELECT date_diff('day', lo, hi) + 1 AS d FROM bounds)),
fine_health AS (SELECT *, CASE WHEN on_hand < {_z(0.95)} * greatest(0.5, sd * sqrt(3)) THEN 'Understock Alert'
  WHEN on_hand > m * 10 + {_z(0.95)} * greatest(0.5, sd * sqrt(10)) THEN 'Overstock Alert' ELSE 'Healthy' END AS health
  FROM fine_stats)"""


def _fine_policies(retail):
    """Policies of store, brand and type; moments come from the days with sales only."""
    keys = ["store_id", "state_id", "dept_id", "item_id"]
    daily = retail.lines.groupBy(*keys, "date").agg(F.sum("quantity").alias("sales"))
    days = F.datediff(retail.last_day, retail.first_day) + 1
    recent = F.when(F.col("date") > F.date_sub(retail.last_day, 20), F.col("sales"))
    stats = G.sparse_demand_stats(daily, days, keys)
    stock = daily.groupBy(*keys).agg(F.coalesce(F.sum(recent), F.lit(0.0)).alias("on_hand"))
    return G.policies(stats.join(stock, keys))


@query("g13_understock_matrix", """
SELECT store_id, kind AS item_id, count(*) FILTER (health = 'Understock Alert') AS series FROM fine_health GROUP BY ALL
""", FINE_POLICY)
def understock_matrix(retail):
    return G.health_matrix(_fine_policies(retail), "store_id", "item_id")


@query("g13_worst_status_matrix", """
SELECT state_id, kind AS item_id, CASE WHEN count(*) FILTER (health = 'Understock Alert') > 0 THEN 'Understock Alert'
  WHEN count(*) FILTER (health = 'Overstock Alert') > 0 THEN 'Overstock Alert' ELSE 'Healthy' END AS status
FROM fine_health GROUP BY ALL
""", FINE_POLICY)
def worst_status_matrix(retail):
    return G.worst_status_matrix(_fine_policies(retail), "state_id", "item_id")


# ---- drift -----------------------------------------------------------------------

SIDES = """
sides AS (SELECT store_id, item_id, sales AS v, day_no > greatest(10, n - 10) AS is_new
  FROM panel JOIN (SELECT store_id, item_id, n FROM last) USING (store_id, item_id))"""
EVENT_SIDES = """
sides AS (SELECT event_type AS store_id, 'events' AS item_id, value AS v, ts >= TIMESTAMP '2024-01-24' AS is_new FROM events)"""
KS_SQL = """
counts AS (SELECT store_id, item_id, v, count(*) FILTER (NOT is_new) AS o, count(*) FILTER (is_new) AS k FROM sides GROUP BY ALL),
ks AS (SELECT store_id, item_id, max(abs(fo - fn)) AS d, any_value(no) AS n_old, any_value(nn) AS n_new FROM (
  SELECT *, sum(o) OVER w / sum(o) OVER p AS fo, sum(k) OVER w / sum(k) OVER p AS fn, sum(o) OVER p AS no, sum(k) OVER p AS nn
  FROM counts WINDOW w AS (PARTITION BY store_id, item_id ORDER BY v), p AS (PARTITION BY store_id, item_id)) GROUP BY ALL),
pvalues AS (SELECT *, CASE WHEN q < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(
    [(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2 * j * j * q) FOR j IN range(1, 101)]))) END AS p
  FROM (SELECT *, d * d * n_old * n_new / (n_old + n_new) AS q FROM ks))"""
PSI_SQL = """
edge_lists AS (SELECT store_id, item_id, list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]
    ) FILTER (NOT is_new))) AS e, count(*) FILTER (NOT is_new) AS no, count(*) FILTER (is_new) AS nn FROM sides GROUP BY ALL),
bins AS (SELECT store_id, item_id, unnest(range(1, len(e))) AS b, e, no, nn, len(e) - 1 AS m FROM edge_lists),
placed AS (SELECT store_id, item_id, is_new, count(*) AS c,
    CASE WHEN v = e[len(e)] THEN len(e) - 1 ELSE len([x FOR x IN e IF x <= v]) END AS b
  FROM sides JOIN edge_lists USING (store_id, item_id) WHERE v >= e[1] AND v <= e[len(e)] GROUP BY ALL),
psi AS (SELECT i.store_id, i.item_id, coalesce(sum((pn - po) * ln(pn / po)), 0) AS psi FROM edge_lists i LEFT JOIN (
  SELECT b.store_id, b.item_id, (coalesce(o.c, 0) + 1e-4) / (no + 1e-4 * m) AS po, (coalesce(k.c, 0) + 1e-4) / (nn + 1e-4 * m) AS pn
  FROM bins b LEFT JOIN placed o ON o.store_id = b.store_id AND o.item_id = b.item_id AND o.b = b.b AND NOT o.is_new
  LEFT JOIN placed k ON k.store_id = b.store_id AND k.item_id = b.item_id AND k.b = b.b AND k.is_new) x
  ON x.store_id = i.store_id AND x.item_id = i.item_id GROUP BY ALL)"""


def _sides(retail):
    return H.split_newest(retail.series, V.SERIES, "sales")


def _event_sides(retail):
    """Event values by type: few keys with any number of rows, so no per-key window."""
    return retail.table("events").select(
        F.col("event_type").alias("store_id"), F.lit("events").alias("item_id"), "value",
        (F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")).alias("is_new"))


@query("h01_split", "SELECT store_id, item_id, v AS value, is_new FROM sides", LAST, SIDES)
def split(retail):
    return _sides(retail)


@query("h02_psi", "SELECT store_id, item_id, round(psi, 6) AS psi FROM psi", LAST, SIDES, PSI_SQL)
def psi(retail):
    return rounded(H.psi(H.compared(_sides(retail), V.SERIES), V.SERIES))


@query("h02_psi_events", "SELECT store_id, item_id, round(psi, 6) AS psi FROM psi", EVENT_SIDES, PSI_SQL)
def psi_events(retail):
    return rounded(H.psi(H.compared(_event_sides(retail), V.SERIES, small_keys=False), V.SERIES))


@query("h03_ks", "SELECT store_id, item_id, round(d, 9) AS ks_statistic, n_old AS old_rows, n_new AS new_rows FROM ks", LAST, SIDES, KS_SQL)
def ks(retail):
    return rounded(H.ks_statistic(H.compared(_sides(retail), V.SERIES), V.SERIES), 9)


@query("h03_ks_events", "SELECT store_id, item_id, round(d, 9) AS ks_statistic, n_old AS old_rows, n_new AS new_rows FROM ks",
       EVENT_SIDES, KS_SQL)
def ks_events(retail):
    return rounded(H.ks_statistic(H.compared(_event_sides(retail), V.SERIES, small_keys=False), V.SERIES), 9)


@query("h04_ks_p_value", "SELECT store_id, item_id, round(p, 6) AS ks_p_value FROM pvalues", LAST, SIDES, KS_SQL)
def ks_p_value(retail):
    made = H.with_p_value(H.ks_statistic(H.compared(_sides(retail), V.SERIES), V.SERIES), V.SERIES, "asymptotic")
    return rounded(made.select(*V.SERIES, "ks_p_value"))


# Walks the lattice by diagonals k = i + j: the chance to have left the band on the way to
# (i, j) mixes the two points before it. Entry j + 1 of the list belongs to j new rows.
EXACT_KS = f"""
exact AS (SELECT store_id, item_id, d, list_reduce(
    [{{'k': k::DOUBLE, 't': []::DOUBLE[]}} FOR k IN range(1, CAST(n_old + n_new + 1 AS BIGINT))],
    lambda a, x: {{'k': x.k, 't': [CASE WHEN x.k < j THEN 0.0
        WHEN abs((x.k - j) * n_new - j * n_old)::DOUBLE >= round(d * n_old::DOUBLE * n_new::DOUBLE) - 0.5 THEN 1.0
        WHEN j = 0 THEN a.t[1] ELSE ((x.k - j) * a.t[j + 1] + j * a.t[j]) / x.k END FOR j IN range(0, {V.INCOMING_ROWS + 1})]}},
    {{'k': 0.0::DOUBLE, 't': [0.0 FOR j IN range(0, {V.INCOMING_ROWS + 1})]::DOUBLE[]}}).t[{V.INCOMING_ROWS + 1}] AS p FROM ks)"""


@query("h04_ks_exact_p_value", """
SELECT store_id, item_id, round(d, 6) AS ks_statistic, round(p, 6) AS ks_p_value FROM exact
""", LAST, SIDES, KS_SQL, EXACT_KS)
def ks_exact_p_value(retail):
    made = H.with_p_value(H.ks_statistic(H.compared(_sides(retail), V.SERIES), V.SERIES), V.SERIES)
    return rounded(made.select(*V.SERIES, "ks_statistic", "ks_p_value"))


VERDICT = """
SELECT store_id, item_id, round(p, 6) AS ks_p_value, round(psi, 6) AS psi, p < 0.05 AS ks_drift, psi >= 0.25 AS psi_drift,
  p < 0.05 OR psi >= 0.25 AS drift_detected,
  CASE WHEN p < 0.05 OR psi >= 0.25 THEN 'Action Required: Retrain model' ELSE 'Data stable' END AS status_message
FROM pvalues JOIN psi USING (store_id, item_id)"""


@query("h05_verdict", VERDICT.replace("FROM pvalues", "FROM exact"), LAST, SIDES, KS_SQL, EXACT_KS, PSI_SQL)
def verdict(retail):
    report = H.drift_report(_sides(retail), V.SERIES)
    return rounded(report.drop("ks_statistic", "old_rows", "new_rows"))


@query("h05_verdict_events", VERDICT, EVENT_SIDES, KS_SQL, PSI_SQL)
def verdict_events(retail):
    report = H.drift_report(_event_sides(retail), V.SERIES, small_keys=False, method="asymptotic")
    return rounded(report.drop("ks_statistic", "old_rows", "new_rows"))


# ---- explanations and records ----------------------------------------------------

WEIGHTS = {
    "sales_lag_1": 0.05, "sales_lag_7": 0.04, "sales_roll_mean_7": 0.2, "sales_roll_mean_28": 0.5,
    "sales_roll_std_7": -0.1, "is_weekend": 1.5, "is_promo": 0.75, "month": 0.02, "sin_annual": 0.6,
    "cos_annual": -0.4, "trend_idx": 0.001, "sales_expanding_mean": 0.3,
}


def _contributions_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - (SELECT avg({c}) FROM features)))), 6) AS mean_contribution
        FROM features""" for c, w in WEIGHTS.items())


def _matrix(retail):
    return B.model_matrix(B.demand_features(retail.panel), list(WEIGHTS))


@query("i01_feature_importance")
def feature_importance(retail):
    model = trees.fit_recursive(retail.panel)
    return rounded(trees.importances(model, retail.panel))


@query("i02_tree_contributions")
def tree_contributions(retail):
    """The tree model ranked by its mean absolute Shapley values over the whole panel."""
    model = trees.fit_recursive(retail.panel)
    matrix = B.model_matrix(B.demand_features(retail.panel), trees.training_columns(retail.panel))
    return rounded(boosting.mean_contributions(matrix, model))


@query("i02_contributions", _contributions_sql(), LAGGED, FEATURE_SQL)
def contributions(retail):
    return rounded(X.mean_contributions(_matrix(retail), WEIGHTS))


# Least squares on the features by Gauss-Jordan elimination of the normal equations.
_K = len(WEIGHTS) + 1
LINEAR_FIT = f"""
rows AS (SELECT [1.0, {", ".join(WEIGHTS)}]::DOUBLE[] AS x, sales::DOUBLE AS y FROM features),
term AS (SELECT unnest(range(1, {_K + 1})) AS i),
lines AS (SELECT a.i, list_append(list(s ORDER BY b), any_value(v)) AS r
  FROM (SELECT a.i AS i, b.i AS b, sum(x[a.i] * x[b.i]) AS s FROM rows, term a, term b GROUP BY a.i, b.i) a
  JOIN (SELECT i, sum(x[i] * y) AS v FROM rows, term GROUP BY i) c USING (i) GROUP BY a.i),
solved AS (SELECT list_reduce([{{'k': k, 'm': []::DOUBLE[][]}} FOR k IN range(1, {_K + 1})],
    lambda a, x: {{'k': x.k, 'm': [CASE WHEN i = x.k THEN [v / a.m[x.k][x.k] FOR v IN a.m[x.k]]
      ELSE [a.m[i][c] - a.m[i][x.k] / a.m[x.k][x.k] * a.m[x.k][c] FOR c IN range(1, {_K + 2})] END
      FOR i IN range(1, {_K + 1})]}}, {{'k': 0::BIGINT, 'm': (SELECT list(r ORDER BY i) FROM lines)}}).m AS m)"""


@query("i02_fitted_contributions", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg(abs((SELECT m[{at}][{_K + 1}] FROM solved) * ({c} - (SELECT avg({c}) FROM features)))), 5)
      AS mean_contribution FROM features""" for at, c in enumerate(WEIGHTS, start=2)), LAGGED, FEATURE_SQL, LINEAR_FIT)
def fitted_contributions(retail):
    matrix = _matrix(retail)
    return rounded(X.mean_contributions(matrix, X.linear_weights(matrix, list(WEIGHTS))), 5)


@query("i03_top_features", f"SELECT * FROM ({_contributions_sql()}) ORDER BY mean_contribution DESC, feature LIMIT 10",
       LAGGED, FEATURE_SQL)
def top_features(retail):
    return rounded(X.top_features(X.mean_contributions(_matrix(retail), WEIGHTS), "mean_contribution"))


@query("i04_run_records", """
SELECT 'baselines' AS run, store_id, item_id, model, CAST(0 AS INTEGER) AS step, unnest(['WAPE', 'MAE', 'RMSE']) AS metric,
  unnest([round("WAPE", 6), round("MAE", 6), round("RMSE", 6)]) AS value FROM scores
""", POOLED)
def run_records(retail):
    return rounded(X.run_records("baselines", D.compare(D.walk_forward(retail.series)), ["WAPE", "MAE", "RMSE"], 0))


# ---- outputs ---------------------------------------------------------------------

@query("a16_action_log", """
SELECT store_id AS "Store_ID", item_id AS "SKU_ID", on_hand AS "Current_Stock", on_order AS "On_Order",
  round(ss, 2) AS "Safety_Stock", round(rop, 2) AS "Reorder_Point", round(s_up, 2) AS "Order_Up_To_Level",
  round(greatest(0, s_up - pos), 2) AS "Order_Quantity_OUT", round(greatest(0, nv - pos), 2) AS "Order_Quantity_Newsvendor",
  health AS "Inventory_Health" FROM policy
""", LAST, POLICY)
def action_log(retail):
    return R.action_log(_policies(retail))


@query("a17_submission", """
SELECT item_id || '_' || store_id || ending AS id, """ + ", ".join(
    f'coalesce(max(sales) FILTER (s = {k}), 0) AS "F{k}"' for k in range(1, 29)) + """
FROM (SELECT p.*, unnest(range(1, 15)) AS s, n FROM panel p JOIN (SELECT store_id, item_id, n FROM last) USING (store_id, item_id))
CROSS JOIN (SELECT unnest(['_validation', '_evaluation']) AS ending) WHERE day_no = n - 7 + (s - 1) % 7 + 1 GROUP BY ALL
""", LAST)
def submission(retail):
    forecast = C.seasonal_naive(retail.series, STEPS).withColumn(
        "id", F.concat_ws("_", "item_id", "store_id", F.lit("validation")))
    return R.submission(forecast)


_CHART = f"""
SELECT store_id, item_id, date, sales AS actual, NULL::DOUBLE AS p10, NULL::DOUBLE AS p50, NULL::DOUBLE AS p90,
  round(rop, 6) AS reorder_point FROM panel JOIN (SELECT store_id, item_id, n FROM last) USING (store_id, item_id)
  JOIN policy USING (store_id, item_id) WHERE day_no > n - 30
UNION ALL SELECT store_id, item_id, date, NULL, round(greatest(0, yhat - {_z(0.9)} * sigma), 6), yhat,
  round(yhat + {_z(0.9)} * sigma, 6), round(rop, 6)
FROM seasonal JOIN spread USING (store_id, item_id) JOIN policy USING (store_id, item_id)"""


@query("j01_chart_rows", _CHART, LAST, COMING, SEASONAL, RESIDUALS, POLICY)
def chart_rows(retail):
    return rounded(planning.chart_rows(retail.series, _bands(retail), _policies(retail)))


@query("j02_planning_table", f"""
SELECT store_id, item_id, round(m, 6) AS demand_mean, round(sd, 6) AS demand_std, on_hand, on_order,
  round(forecast_sum, 6) AS forecast_sum, round(p10_sum, 6) AS p10_sum, round(p90_sum, 6) AS p90_sum,
  round(sigma, 6) AS sigma, horizon_end, round(ss, 6) AS safety_stock, round(rop, 6) AS reorder_point,
  round(s_up, 6) AS order_up_to_level, round(greatest(0, s_up - pos), 6) AS order_out,
  round(CASE WHEN pos <= rop THEN s_up - pos ELSE 0 END, 6) AS order_s_s,
  round(greatest(0, nv - pos), 6) AS order_newsvendor, round(short, 6) AS expected_shortage,
  health AS inventory_health, on_hand < ss AS under_stock_alert
FROM policy JOIN (SELECT store_id, item_id, sum(yhat) AS forecast_sum, any_value(sigma) AS sigma, max(date) AS horizon_end,
    sum(greatest(0, yhat - {_z(0.9)} * sigma)) AS p10_sum, sum(yhat + {_z(0.9)} * sigma) AS p90_sum
  FROM seasonal JOIN spread USING (store_id, item_id) GROUP BY ALL) USING (store_id, item_id)
""", LAST, COMING, SEASONAL, RESIDUALS, POLICY)
def planning_table(retail):
    table = planning.planning_table(retail.series, stock_on_hand(retail.series), STEPS)
    return rounded(table.select(
        *V.SERIES, "demand_mean", "demand_std", "on_hand", "on_order", "forecast_sum", "p10_sum", "p90_sum", "sigma",
        "horizon_end", "safety_stock", "reorder_point", "order_up_to_level", "order_out", "order_s_s",
        "order_newsvendor", "expected_shortage", "inventory_health", "under_stock_alert"))


_PLAN_WITH_ETS = f"""
SELECT store_id, item_id, round(forecast_sum, 6) AS forecast_sum, round(p10_sum, 6) AS p10_sum, round(p90_sum, 6) AS p90_sum,
  horizon_end, round(rop, 6) AS reorder_point, round(greatest(0, s_up - pos), 6) AS order_out
FROM policy JOIN (SELECT store_id, item_id, sum(f) AS forecast_sum, max(last_date + step) AS horizon_end,
    sum(greatest(0, f - {_z(0.9)} * sigma)) AS p10_sum, sum(greatest(0, f + {_z(0.9)} * sigma)) AS p90_sum
  FROM (SELECT store_id, item_id, step, last_date, r.l + step * r.b AS f FROM best JOIN last USING (store_id, item_id) CROSS JOIN coming)
  JOIN spread USING (store_id, item_id) GROUP BY ALL) USING (store_id, item_id)
"""


@query("j02_planning_resumed", _PLAN_WITH_ETS, LAST, COMING, RESIDUALS, POLICY, ETS_FIT)
def planning_resumed(retail):
    """Planning from stored states: the walk up to the day before the last, stored, then the last day alone."""
    last = F.col("date") == retail.last_day
    states = resumable.store(resumable.advance(None, retail.series.where(~last)))
    states = resumable.store(resumable.advance(states, retail.series.where(last)))
    return rounded(plan_from_states(states, stock_on_hand(retail.series), STEPS).select(
        *V.SERIES, "forecast_sum", "p10_sum", "p90_sum", "horizon_end", "reorder_point", "order_out"))


@query("j02_planning_with_ets", _PLAN_WITH_ETS, LAST, COMING, RESIDUALS, POLICY, ETS_FIT)
def planning_with_ets(retail):
    point = forecast(retail.series, "ets", STEPS)
    table = plan_from_forecast(point, retail.series, stock_on_hand(retail.series))
    return rounded(table.select(
        *V.SERIES, "forecast_sum", "p10_sum", "p90_sum", "horizon_end", "reorder_point", "order_out"))
