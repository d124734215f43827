"""Queries for forecasters, metrics and the walk-forward backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions.metrics import ALL
from stockloom.operators import (
    additive, arima, backtest as D, boosting, features as B, forecast as C, piecewise, smoothing, trees)
from stockloom.operators.series_fit import as_forecast
from stockloom.plans.forecasting import backtest
from stockloom.registry.base import query, rounded
from stockloom.session import stored

H = 14
ORDER = "PARTITION BY store_id, item_id ORDER BY day_no"
COMING = f"coming AS (SELECT CAST(unnest(range(1, {H + 1})) AS INTEGER) AS step)"
LAST = "last AS (SELECT store_id, item_id, max(day_no) AS n, max(date) AS last_date, arg_max(sales, day_no) AS y FROM panel GROUP BY ALL)"


@query("c01_naive", "SELECT store_id, item_id, step, last_date + step AS date, y AS yhat FROM last CROSS JOIN coming", LAST, COMING)
def naive(retail):
    return C.naive(retail.series, H)


SEASONAL = """
seasonal AS (SELECT l.store_id, l.item_id, step, l.last_date + step AS date, p.sales AS yhat
  FROM last l CROSS JOIN coming
  JOIN panel p ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.day_no = l.n - 7 + (step - 1) % 7 + 1)"""


@query("c02_seasonal_naive", "SELECT * FROM seasonal", LAST, COMING, SEASONAL)
def seasonal_naive(retail):
    return C.seasonal_naive(retail.series, H)


@query("c03_moving_average", """
SELECT l.store_id, l.item_id, step, last_date + step AS date, round(m, 6) AS yhat, round(m90, 6) AS yhat_90
FROM last l CROSS JOIN coming JOIN (
  SELECT store_id, item_id, avg(sales) FILTER (day_no > n - 7) AS m, avg(sales) FILTER (day_no > n - 90) AS m90
  FROM panel JOIN last USING (store_id, item_id) GROUP BY ALL) USING (store_id, item_id)
""", LAST, COMING)
def moving_average(retail):
    quarter = C.moving_average(retail.series, H, 90).select(*V.SERIES, "step", F.col("yhat").alias("yhat_90"))
    return rounded(C.moving_average(retail.series, H).join(quarter, [*V.SERIES, "step"]))


@query("c04_ar1_closed_form", """
SELECT a.store_id, a.item_id, round(phi, 6) AS phi, step, last_date + step AS date,
  round(l.y + w * phi * (1 - pow(phi, step)) / (1 - phi), 6) AS yhat
FROM (SELECT store_id, item_id, sum(w * b) / sum(b * b) AS phi, arg_max(w, day_no) AS w FROM (
    SELECT *, lag(w) OVER (PARTITION BY store_id, item_id ORDER BY day_no) AS b FROM (
      SELECT *, sales - lag(sales) OVER (PARTITION BY store_id, item_id ORDER BY day_no) AS w FROM panel))
  GROUP BY ALL) a JOIN last l USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING)
def ar1(retail):
    return rounded(arima.autoregression(retail.series, H))


@query("c04_ar1_levels", """
SELECT a.store_id, a.item_id, round(phi, 6) AS phi, step, last_date + step AS date,
  round(c * (1 - pow(phi, step)) / (1 - phi) + l.y * pow(phi, step), 6) AS yhat
FROM (SELECT store_id, item_id, regr_slope(sales, b) AS phi, regr_intercept(sales, b) AS c FROM (
    SELECT *, lag(sales) OVER (PARTITION BY store_id, item_id ORDER BY day_no) AS b FROM panel)
  GROUP BY ALL) a JOIN last l USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING)
def ar1_levels(retail):
    return rounded(arima.autoregression(retail.series, H, d=0))


ARIMA_FIT = f"""
grid AS (SELECT * FROM (SELECT unnest({arima.COEFFICIENTS}::DOUBLE[]) AS phi)
  CROSS JOIN (SELECT unnest({arima.COEFFICIENTS}::DOUBLE[]) AS theta)),
changes AS (SELECT store_id, item_id, list({{'w': w, 'e': 0.0::DOUBLE, 's': 0.0::DOUBLE}} ORDER BY day_no) AS ws FROM (
  SELECT *, sales - lag(sales) OVER ({ORDER}) AS w FROM panel) WHERE w IS NOT NULL GROUP BY ALL),
fits AS (SELECT store_id, item_id, phi, theta, list_reduce(ws, lambda a, x: {{
    'w': x.w, 'e': x.w - phi * a.w - theta * a.e,
    's': a.s + (x.w - phi * a.w - theta * a.e) * (x.w - phi * a.w - theta * a.e)}}) AS r FROM changes CROSS JOIN grid),
best AS (SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY r.s, phi, theta) = 1)"""


PLACES = {"yhat": 6, "sse": 3, "intercept": 6, "slope": 9}


def _rounded_fit(made):
    return made.drop("origin").withColumns({c: F.round(c, n) for c, n in PLACES.items() if c in made.columns})


@query("c04_arima", """
SELECT b.store_id, b.item_id, phi, theta, round(r.s, 3) AS sse, step, last_date + step AS date,
  round(y + (phi * r.w + theta * r.e) * (1 - pow(phi, step)) / (1 - phi), 6) AS yhat
FROM best b JOIN last USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING, ARIMA_FIT)
def arima_grid(retail):
    made = as_forecast(arima.arima(retail.series, H), ("phi", "theta", "sse"))
    return _rounded_fit(made)


@query("c04_arima_higher_order")
def arima_higher_order(retail):
    return rounded(as_forecast(arima.arima(retail.series, H, (2, 1, 2))).drop("origin"))


@query("c04_arima_estimated")
def arima_estimated(retail):
    """ARIMA(1, 1, 1) by Gauss-Newton steps from the grid's best."""
    return rounded(as_forecast(arima.arima(retail.series, H, estimate=True), ("phi_1", "theta_1", "sse")).drop("origin"))


AR2_ORIGINS = (28, 7)   # first origin and step


# Least squares on running sums at every origin, with the prior's inverse on the diagonal.
@query("c04_ar2_every_origin", f"""
SELECT store_id, item_id, CAST(o AS INTEGER) AS origin, round(phi_1, 4) AS phi_1, round(phi_2, 4) AS phi_2,
  round(list_reduce([{{'y': 0.0::DOUBLE, 'w': 0.0::DOUBLE, 'v': 0.0::DOUBLE}} FOR k IN range({H})], lambda made, k: {{
    'y': made.y + phi_1 * made.w + phi_2 * made.v, 'w': phi_1 * made.w + phi_2 * made.v, 'v': made.w}},
    {{'y': y::DOUBLE, 'w': w::DOUBLE, 'v': w1::DOUBLE}}).y, 3) AS last_yhat
FROM fits
""", f"""
changes AS (SELECT store_id, item_id, day_no AS o, sales AS y, sales - lag(sales) OVER s AS w, count(*) OVER (PARTITION BY store_id, item_id) AS n
  FROM panel WINDOW s AS ({ORDER})),
lagged AS (SELECT *, lag(w) OVER s AS w1, lag(w, 2) OVER s AS w2 FROM changes WINDOW s AS (PARTITION BY store_id, item_id ORDER BY o)),
sums AS (SELECT *, sum(w1 * w1) OVER s + 1e-6 AS a, sum(w1 * w2) OVER s AS b, sum(w2 * w2) OVER s + 1e-6 AS c, sum(w1 * w) OVER s AS d, sum(w2 * w) OVER s AS e
  FROM (SELECT *, w2 IS NOT NULL AS known FROM lagged) WHERE known WINDOW s AS (PARTITION BY store_id, item_id ORDER BY o)),
fits AS (SELECT *, (c * d - b * e) / (a * c - b * b) AS phi_1, (a * e - b * d) / (a * c - b * b) AS phi_2 FROM sums
  WHERE o >= {AR2_ORIGINS[0]} AND o <= n - {H} AND (o - {AR2_ORIGINS[0]}) % {AR2_ORIGINS[1]} = 0)""")
def ar2_every_origin(retail):
    """AR(2) on daily changes, fitted anew at every origin by one recursive walk."""
    made = arima.arima(retail.series, H, (2, 1, 0), backtest=AR2_ORIGINS)
    return made.select(*V.SERIES, "origin", F.round("phi_1", 4).alias("phi_1"), F.round("phi_2", 4).alias("phi_2"),
                       F.round(F.element_at("path", -1), 3).alias("last_yhat"))


ETS_FIT = f"""
grid AS (SELECT * FROM (SELECT unnest({smoothing.LEVEL_GRID}::DOUBLE[]) AS alpha)
  CROSS JOIN (SELECT unnest({smoothing.TREND_GRID}::DOUBLE[]) AS beta)),
ordered AS (SELECT store_id, item_id,
  list({{'y': sales::DOUBLE, 'l': sales::DOUBLE, 'b': 0.0::DOUBLE, 's': 0.0::DOUBLE}} ORDER BY day_no) AS ys FROM panel GROUP BY ALL),
fits AS (SELECT store_id, item_id, alpha, beta, list_reduce(ys, lambda a, x: {{
    'y': x.y, 'l': a.l + a.b + alpha * (x.y - a.l - a.b), 'b': a.b + alpha * beta * (x.y - a.l - a.b),
    's': a.s + (x.y - a.l - a.b) * (x.y - a.l - a.b)}}) AS r FROM ordered CROSS JOIN grid),
best AS (SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY r.s, alpha, beta) = 1)"""


@query("c05_ets", """
SELECT b.store_id, b.item_id, alpha, beta, round(r.s, 3) AS sse, step, last_date + step AS date,
  round(r.l + step * r.b, 6) AS yhat FROM best b JOIN last USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING, ETS_FIT)
def ets(retail):
    made = as_forecast(smoothing.ets(retail.series, H), ("alpha", "beta", "sse"))
    return _rounded_fit(made)


@query("c05_ets_estimated")
def ets_estimated(retail):
    """Smoothing with gains and first states estimated from the grid's best."""
    return rounded(as_forecast(smoothing.ets(retail.series, H, estimate=True), ("alpha", "beta", "sse")).drop("origin"))


# The state keeps the seven seasonal terms as a list whose first entry is the coming day's.
ETS_SEASON_FIT = f"""
grid AS (SELECT * FROM (SELECT unnest({smoothing.LEVEL_GRID}::DOUBLE[]) AS alpha)
  CROSS JOIN (SELECT unnest({smoothing.TREND_GRID}::DOUBLE[]) AS beta)
  CROSS JOIN (SELECT unnest({smoothing.SEASON_GRID}::DOUBLE[]) AS gamma)),
week AS (SELECT store_id, item_id, avg(sales) AS l0, list(sales::DOUBLE ORDER BY day_no) AS first_week
  FROM panel WHERE day_no <= 7 GROUP BY ALL),
starts AS (SELECT store_id, item_id, {{'y': 0.0::DOUBLE, 'l': l0::DOUBLE, 'b': 0.0::DOUBLE, 's': 0.0::DOUBLE,
    'q': [v - l0 FOR v IN first_week]::DOUBLE[]}} AS z FROM week),
ordered AS (SELECT store_id, item_id, list({{'y': sales::DOUBLE, 'l': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 's': 0.0::DOUBLE,
    'q': []::DOUBLE[]}} ORDER BY day_no) AS ys FROM panel WHERE day_no > 7 GROUP BY ALL),
fits AS (SELECT store_id, item_id, alpha, beta, gamma, list_reduce(ys, lambda a, x: {{
    'y': x.y - a.l - a.b - a.q[1],
    'l': a.l + a.b + alpha * (x.y - a.l - a.b - a.q[1]),
    'b': a.b + alpha * beta * (x.y - a.l - a.b - a.q[1]),
    's': a.s + (x.y - a.l - a.b - a.q[1]) * (x.y - a.l - a.b - a.q[1]),
    'q': [a.q[2], a.q[3], a.q[4], a.q[5], a.q[6], a.q[7], a.q[1] + gamma * (1 - alpha) * (x.y - a.l - a.b - a.q[1])]}}, z) AS r
  FROM ordered JOIN starts USING (store_id, item_id) CROSS JOIN grid),
best AS (SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY r.s, alpha, beta, gamma) = 1)"""


@query("c05_ets_seasonal", """
SELECT b.store_id, b.item_id, alpha, beta, gamma, round(r.s, 3) AS sse, step, last_date + step AS date,
  round(r.l + step * r.b + r.q[(step - 1) % 7 + 1], 6) AS yhat FROM best b JOIN last USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING, ETS_SEASON_FIT)
def ets_seasonal(retail):
    made = as_forecast(smoothing.ets(retail.series, H, period=7), ("alpha", "beta", "gamma", "sse"))
    return _rounded_fit(made)


@query("c06_trend_regression", """
SELECT r.store_id, r.item_id, round(c, 6) AS intercept, round(b, 9) AS slope, step, last_date + step AS date,
  round(c + b * (n - 1 + step), 6) AS yhat
FROM (SELECT store_id, item_id, regr_slope(sales, day_no - 1) AS b, regr_intercept(sales, day_no - 1) AS c
  FROM panel GROUP BY ALL) r JOIN last USING (store_id, item_id) CROSS JOIN coming
""", LAST, COMING)
def trend_regression(retail):
    made = as_forecast(additive.additive_regression(retail.series, H, weekly=0, yearly=0, ridge=0.0), ("intercept", "slope"))
    return _rounded_fit(made)


# The ridge normal equations of the shared design, solved by Gauss-Jordan elimination: one
# list_reduce step per pivot on the augmented matrix.
_TERMS = 2 + 2 * (additive.WEEKLY_TERMS + additive.YEARLY_TERMS)
_WAVES = ", ".join(
    f"sin(2 * pi() * {k} * a / {period}), cos(2 * pi() * {k} * a / {period})"
    for period, terms in ((7.0, additive.WEEKLY_TERMS), (365.25, additive.YEARLY_TERMS)) for k in range(1, terms + 1))
ADDITIVE_FIT = f"""
span AS (SELECT max(day_no) AS n, date_diff('day', DATE '1970-01-01', min(date)) AS first FROM panel),
design AS (SELECT t, [1.0, t / (n - 1)::DOUBLE, {_WAVES}]::DOUBLE[] AS x FROM (
  SELECT t, n, first + t AS a FROM span, (SELECT unnest(range(0, (SELECT n + {H} FROM span))) AS t))),
term AS (SELECT unnest(range(1, {_TERMS + 1})) AS i),
gram AS (SELECT a.i, b.i AS j, sum(x[a.i] * x[b.i]) + CASE WHEN a.i = b.i AND a.i > 1 THEN {additive.RIDGE} ELSE 0 END AS g
  FROM design, term a, term b WHERE t < (SELECT n FROM span) GROUP BY a.i, b.i),
moments AS (SELECT store_id, item_id, i, sum(x[i] * sales) AS v FROM panel JOIN design ON t = day_no - 1, term GROUP BY ALL),
lines AS (SELECT store_id, item_id, i, list_append(list(g ORDER BY j), any_value(v)) AS r FROM gram JOIN moments USING (i) GROUP BY ALL),
systems AS (SELECT store_id, item_id, list(r ORDER BY i) AS m FROM lines GROUP BY ALL),
solved AS (SELECT store_id, item_id, list_reduce(
    [{{'k': k, 'm': []::DOUBLE[][]}} FOR k IN range(1, {_TERMS + 1})],
    lambda a, x: {{'k': x.k, 'm': [CASE WHEN i = x.k THEN [v / a.m[x.k][x.k] FOR v IN a.m[x.k]]
      ELSE [a.m[i][c] - a.m[i][x.k] / a.m[x.k][x.k] * a.m[x.k][c] FOR c IN range(1, {_TERMS + 2})] END
      FOR i IN range(1, {_TERMS + 1})]}}, {{'k': 0::BIGINT, 'm': m}}).m AS m FROM systems)"""


@query("c06_additive_regression", f"""
SELECT store_id, item_id, step, last_date + step AS date, round(list_sum([m[i][{_TERMS + 1}] * x[i] FOR i IN range(1, {_TERMS + 1})]), 6) AS yhat
FROM solved JOIN last USING (store_id, item_id) CROSS JOIN coming JOIN design ON t = n - 1 + step
""", LAST, COMING, ADDITIVE_FIT)
def additive_regression(retail):
    return rounded(as_forecast(additive.additive_regression(retail.series, H)).drop("origin"))


@query("c06_running_moments", f"""
SELECT store_id, item_id, CAST(t + 1 AS INTEGER) AS day, is_origin, round(total, 3) AS total, round(moment, 2) AS moment,
  round(squares, 2) AS squares, round(week_wave, 3) AS week_wave, round(year_wave, 3) AS year_wave
FROM (SELECT *, day_no - 1 AS t, sum(sales) OVER s AS total, sum((day_no - 1) * sales) OVER s AS moment, sum(sales * sales) OVER s AS squares,
    sum(sales * sin(2 * pi() * date_diff('day', DATE '1970-01-01', date) / 7.0)) OVER s AS week_wave,
    sum(sales * cos(2 * pi() * 10 * date_diff('day', DATE '1970-01-01', date) / 365.25)) OVER s AS year_wave,
    day_no >= 28 AND day_no <= (SELECT max(day_no) FROM panel) - {H} AND (day_no - 28) % 7 = 0 AS is_origin
  FROM panel WINDOW s AS ({ORDER}))
WHERE is_origin OR (t + 1) % {piecewise.SPACING} = 0
""")
def running_moments(retail):
    """The sums that the piecewise fit of every origin is a difference of."""
    sums = piecewise.running_moments(retail.series, H, backtest=(28, 7))
    return sums.select(*V.SERIES, F.col("day").cast("int").alias("day"), "is_origin", F.round("total", 3).alias("total"),
                       F.round("moment", 2).alias("moment"), F.round("squares", 2).alias("squares"),
                       F.round(F.element_at("waves", 1), 3).alias("week_wave"), F.round(F.element_at("waves", -1), 3).alias("year_wave"))


@query("c06_piecewise_regression")
def piecewise_regression(retail):
    return rounded(as_forecast(piecewise.piecewise_regression(retail.series, H), ("slope", "bends")).drop("origin"))


TREE_HORIZON = 14


@query("c07_trees_recursive")
def trees_recursive(retail):
    model = trees.fit_recursive(retail.panel)
    return rounded(trees.predict_recursive(model, retail.panel, TREE_HORIZON, retail.calendar_until(TREE_HORIZON)))


TREE_INPUTS = ["dayofweek", "month", "quarter", "year", "is_weekend", "is_holiday", "is_promo"]
TREE_LEVELS = 3


def _first_tree_sql() -> tuple[str, list[str]]:
    """Residuals of the mean, then level by level the split that removes most of the squared error."""
    snap = " ".join(f"WHEN state_id = '{s}' THEN \"snap_{s}\"" for s in ("AFRICA", "AMERICA", "ASIA"))
    ctes = [f"""
n0 AS (
  SELECT 0 AS node, sales - avg(sales) OVER () AS r, [isodow(date) - 1, month(date), quarter(date), year(date),
    CAST(isodow(date) >= 6 AS INTEGER), CAST(event_name_1 IS NOT NULL AS INTEGER), CASE {snap} ELSE 0 END] AS x FROM panel)"""]
    for level in range(TREE_LEVELS):
        ctes.append(f"""
h{level} AS (
  SELECT node, f, v, sum(r) AS s, count(*) AS c FROM (
    SELECT node, r, unnest(range(1, {len(TREE_INPUTS) + 1})) AS f, unnest(x) AS v FROM n{level}) GROUP BY ALL),
g{level} AS (
  SELECT *, sl * sl / cl + (st - sl) * (st - sl) / (ct - cl) - st * st / ct AS gain FROM (
    SELECT node, f, v, sum(s) OVER w AS sl, sum(c) OVER w AS cl, sum(s) OVER (PARTITION BY node, f) AS st, sum(c) OVER (PARTITION BY node, f) AS ct
    FROM h{level} WINDOW w AS (PARTITION BY node, f ORDER BY v)) WHERE ct > cl),
b{level} AS (
  SELECT node, f, v, ct FROM (SELECT *, max(gain) OVER (PARTITION BY node) AS top FROM g{level})
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain / top, 9) DESC, f, v) = 1),
n{level + 1} AS (SELECT 2 * node + CAST(x[f] > v AS INTEGER) AS node, r, x FROM n{level} JOIN b{level} USING (node))""")
    names = "[" + ", ".join(f"'{c}'" for c in TREE_INPUTS) + "]"
    inner = " UNION ALL ".join(
        f"SELECT CAST({(1 << level) - 1} + node AS INTEGER) AS node, {names}[f] AS feature, CAST(v AS DOUBLE) AS threshold, "
        f"CAST(ct AS BIGINT) AS cover, CAST(NULL AS DOUBLE) AS value FROM b{level}" for level in range(TREE_LEVELS))
    return "SELECT * FROM (" + inner + f""" UNION ALL
  SELECT CAST({(1 << TREE_LEVELS) - 1} + node AS INTEGER), NULL, NULL, count(*), round(0.05 * avg(r), 6) FROM n{TREE_LEVELS} GROUP BY node)
""", ctes


@query("c07_first_tree", _first_tree_sql()[0], *_first_tree_sql()[1])
def first_tree(retail):
    """Splits, covers and leaf values of one boosting round on the calendar's features."""
    matrix = B.temporal(retail.panel).withColumn("sales", F.col("sales").cast("double"))
    model = boosting.fit(matrix, TREE_INPUTS, ["sales"], [boosting.Model(0)], rounds=1, depth=TREE_LEVELS)[0]
    return rounded(boosting.tree_table(matrix.sparkSession, model).select("node", "feature", "threshold", "cover", "value"))


@query("c08_trees_direct")
def trees_direct(retail):
    models = trees.fit_direct(retail.panel, TREE_HORIZON)
    return rounded(trees.predict_direct(models, retail.panel, TREE_HORIZON))


@query("c09_fallback", """
SELECT store_id, item_id, step, last_date + step AS date,
  CASE WHEN y > 30 THEN y ELSE round(s.yhat, 6) END AS yhat,
  CASE WHEN y > 30 THEN 'forecast is not a number' END AS fallback_reason
FROM last CROSS JOIN coming JOIN seasonal s USING (store_id, item_id, step)
""", LAST, COMING, SEASONAL)
def fallback(retail):
    # Busy series have a broken forecast; a missing one is in the unit tests.
    last = C.naive(retail.series, 1).select(*V.SERIES, F.col("yhat").alias("y"))
    fitted = C.seasonal_naive(retail.series, H).join(last, V.SERIES).withColumn(
        "yhat", F.when(F.col("y") > 30, float("nan")).otherwise(F.col("yhat")))
    return C.with_fallback(fitted, C.naive(retail.series, H))


@query("c10_floor_at_zero", """
SELECT store_id, item_id, step, date, greatest(0, yhat - 5) AS yhat FROM seasonal
""", LAST, COMING, SEASONAL)
def floor_at_zero(retail):
    return C.floor_at_zero(C.seasonal_naive(retail.series, H).withColumn("yhat", F.col("yhat") - 5))


@query("c11_fit_length", """
SELECT l.store_id, l.item_id, step, sales AS yhat FROM last l CROSS JOIN coming
JOIN panel p ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.day_no = l.n - 7 + least(step, 5)
""", LAST, COMING)
def fit_length(retail):
    return C.fit_length(C.seasonal_naive(retail.series, 5), H)


@query("c12_future_rows", """
SELECT l.store_id, l.item_id, p.state_id, step, l.last_date + step AS date, p.wm_yr_wk, p."snap_AFRICA", p."snap_AMERICA",
  p."snap_ASIA", CAST(NULL AS VARCHAR) AS event_name_1 FROM last l CROSS JOIN coming
JOIN panel p ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.day_no = l.n
""", LAST, COMING)
def future_rows(retail):
    return C.future_rows(retail.panel, H).select(
        *V.SERIES, "state_id", "step", "date", "wm_yr_wk", "snap_AFRICA", "snap_AMERICA", "snap_ASIA", "event_name_1")


POOLED = f"""
origins AS (SELECT store_id, item_id, CAST(unnest(range(14, n - 7 + 1, 7)) AS INTEGER) AS origin FROM (
  SELECT store_id, item_id, count(*) AS n FROM panel GROUP BY ALL)),
at_origin AS (SELECT store_id, item_id, CAST(day_no AS INTEGER) AS origin, sales AS y,
  avg(sales) OVER ({ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m,
  [{", ".join(f"lead(sales, {k}) OVER ({ORDER})" for k in range(1, 8))}] AS actuals,
  [{", ".join(f"lag(sales, {7 - k}) OVER ({ORDER})" for k in range(1, 8))}] AS seasons FROM panel),
pairs AS (SELECT store_id, item_id, origin, CAST(unnest(range(1, 8)) AS INTEGER) AS step, unnest(actuals) AS actual,
  y, m, unnest(seasons) AS s FROM at_origin JOIN origins USING (store_id, item_id, origin)),
pooled AS (
  SELECT store_id, item_id, origin, step, actual, 'naive' AS model, y AS yhat FROM pairs
  UNION ALL SELECT store_id, item_id, origin, step, actual, 'seasonal_naive', s FROM pairs
  UNION ALL SELECT store_id, item_id, origin, step, actual, 'moving_average', m FROM pairs),
scores AS (SELECT store_id, item_id, model,
  greatest(0, 1 - CASE WHEN sum(actual) > 0 THEN sum(abs(actual - yhat)) / sum(actual) ELSE 0 END) AS "Accuracy",
  CASE WHEN sum(actual) > 0 THEN sum(abs(actual - yhat)) / sum(actual) ELSE 0 END AS "WAPE",
  avg(abs(actual - yhat)) AS "MAE", sqrt(avg(pow(actual - yhat, 2))) AS "RMSE",
  avg(abs(actual - yhat) / greatest((abs(actual) + abs(yhat)) / 2, 1e-5)) * 100 AS "SMAPE",
  avg(abs(actual - yhat) / greatest(actual, 1e-5)) AS "MAPE", avg(yhat - actual) AS "Bias"
  FROM pooled GROUP BY ALL)"""


def _metric_query(number: int, name: str):
    places = 3 if name == "MAPE" else 6  # zero demand makes MAPE very large
    body = f'SELECT store_id, item_id, model, round("{name}", {places}) AS "{name}" FROM scores'

    @query(f"d0{number}_{name.lower()}", body, POOLED)
    def run(retail):
        return D.walk_forward(retail.series).groupBy(*V.SERIES, "model").agg(
            F.round(ALL[name](F.col("actual"), F.col("yhat")), places).alias(name))
    return run


for _number, _name in enumerate(["MAE", "RMSE", "WAPE", "MAPE", "SMAPE", "Bias", "Accuracy"], start=1):
    _metric_query(_number, _name)

@query("d09_origins", "SELECT * FROM origins", POOLED)
def origins(retail):
    return D.origins(retail.series)


@query("d10_walk_forward", """
SELECT store_id, item_id, origin, model, sum(actual) AS actual_sum, round(sum(yhat), 6) AS yhat_sum,
  round(sum(step * abs(actual - yhat)), 6) AS weighted_error FROM pooled GROUP BY ALL
""", POOLED)
def walk_forward(retail):
    return rounded(D.walk_forward(retail.series).groupBy(*V.SERIES, "origin", "model").agg(
        F.sum("actual").alias("actual_sum"), F.sum("yhat").alias("yhat_sum"),
        F.sum(F.col("step") * F.abs(F.col("actual") - F.col("yhat"))).alias("weighted_error")))


@query("d10_walk_forward_fitted")
def walk_forward_fitted(retail):
    """Baselines, smoothing, ARIMA and additive models on the same origins: first after 15 days, then every fifth."""
    pooled = backtest(retail.series, ["seasonal_naive", "moving_average", "arima", "ets", "additive"], 15, 5, 14)
    return rounded(D.compare(pooled, ["model"]))


@query("d12_best_fitted_model")
def best_fitted_model(retail):
    models = ["seasonal_naive", "arima", "ets", "additive"]
    return rounded(D.best_model(D.compare(backtest(retail.series, models, 15, 5, 14)), models))


@query("d10_walk_forward_trees")
def walk_forward_trees(retail):
    """The tree model refitted at the origins of the fitted models: first after 15 days, then every fifth."""
    series = stored(retail.series, "series")   # for origins and actuals; the features keep their partitions, on which cuts depend
    made = trees.tree_backtest(retail.panel, trees.origins(series, 15, 5, TREE_HORIZON), TREE_HORIZON)
    return rounded(D.compare(D.attach_actuals(made, series), ["model", "origin"]))


@query("d11_comparison", """
SELECT store_id, item_id, model, round("Accuracy", 6) AS "Accuracy", round("WAPE", 6) AS "WAPE", round("MAE", 6) AS "MAE",
  round("RMSE", 6) AS "RMSE", round("SMAPE", 6) AS "SMAPE", round("MAPE", 3) AS "MAPE", round("Bias", 6) AS "Bias" FROM scores
""", POOLED)
def comparison(retail):
    return rounded(D.comparison_table(D.walk_forward(retail.series)).withColumn("MAPE", F.round("MAPE", 3)))


@query("d11_comparison_overall", """
SELECT model, round(greatest(0, 1 - sum(abs(actual - yhat)) / sum(actual)), 6) AS "Accuracy",
  round(sum(abs(actual - yhat)) / sum(actual), 6) AS "WAPE", round(avg(abs(actual - yhat)), 6) AS "MAE",
  round(sqrt(avg(pow(actual - yhat, 2))), 6) AS "RMSE",
  round(avg(abs(actual - yhat) / greatest((abs(actual) + abs(yhat)) / 2, 1e-5)) * 100, 6) AS "SMAPE",
  round(avg(abs(actual - yhat) / greatest(actual, 1e-5)), 3) AS "MAPE", round(avg(yhat - actual), 6) AS "Bias"
FROM pooled GROUP BY ALL
""", POOLED)
def comparison_overall(retail):
    overall = D.compare(D.walk_forward(retail.series), ["model"])
    return rounded(overall.withColumn("MAPE", F.round("MAPE", 3)))


@query("d12_best_model", """
SELECT store_id, item_id, model AS best_model, round("WAPE", 6) AS best_wape FROM scores
QUALIFY row_number() OVER (PARTITION BY store_id, item_id
  ORDER BY "WAPE", list_position(['naive', 'seasonal_naive', 'moving_average'], model)) = 1
""", POOLED)
def best_model(retail):
    return rounded(D.best_model(D.compare(D.walk_forward(retail.series)), D.BASELINES))
