"""Names and numbers that have to match the public M5 files and the published formulas.

Fixed values: they are stated here once, as they are defined, and imported elsewhere.
"""

# One demand series is one product in one store.
SERIES = ["store_id", "item_id"]
SALES_IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

CALENDAR_FILE = "calendar.csv"
PRICES_FILE = "sell_prices.csv"
SALES_FILE = "sales_train_validation.csv"

CALENDAR_REQUIRED = [
    "date", "wm_yr_wk", "weekday", "wday", "month", "year", "d",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
]
PRICES_REQUIRED = ["store_id", "item_id", "wm_yr_wk", "sell_price"]
SALES_REQUIRED = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

# Calendar rules.
FIRST_WEEK_ID = 11101
SNAP_DAYS = {
    "CA": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10],
    "TX": [1, 3, 5, 6, 7, 9, 11, 12, 13, 15],
    "WI": [2, 3, 5, 8, 9, 10, 11, 14, 15, 18],
}
FIXED_EVENTS = [(2, 6, "SuperBowl", "Sporting")]  # month, day, name, type
DEFAULT_STATE = "CA"

# Feature parameters.
SALES_LAGS = [1, 2, 3, 4, 5, 6, 7, 14, 21, 28]
ROLLING_WINDOWS = [7, 14, 28]
PLAIN_ROLLING_WINDOWS = [7, 14]
PRICE_STD_WINDOW = 7
DEFAULT_PRICE = 1.99
DAYS_PER_WEEK, DAYS_PER_YEAR = 7.0, 365.25
PATCH_LENGTH, PATCH_STRIDE = 8, 4
CATEGORY_LIMIT = 20  # a text column with at most this many values is a category

# Forecasting and backtest defaults.
SEASON = 7
SUBMISSION_STEPS = 28
BACKTEST_INITIAL, BACKTEST_STEP, BACKTEST_HORIZON = 14, 7, 7
METRIC_ORDER = ["Accuracy", "WAPE", "MAE", "RMSE", "SMAPE", "MAPE", "Bias"]
METRIC_EPS = 1e-5

# Intervals.
RESIDUAL_WARMUP = 14
INTERVAL_CONFIDENCE = 0.8
FALLBACK_SIGMA_SHARE, FALLBACK_SIGMA_FLOOR = 0.15, 1.0
CRPS_SIGMA_FLOOR = 1e-5

# Inventory policy defaults.
LEAD_TIME_DAYS, REVIEW_DAYS, SERVICE_LEVEL = 3, 7, 0.95
HOLDING_COST, STOCKOUT_COST = 0.1, 1.5
DEMAND_FLOOR, POLICY_STD_FLOOR = 0.1, 0.5
UNDERSTOCK, OVERSTOCK, HEALTHY = "Understock Alert", "Overstock Alert", "Healthy"

# Drift.
PSI_BINS, PSI_EPS, PSI_ALARM = 10, 1e-4, 0.25
KS_ALPHA = 0.05
INCOMING_ROWS, MIN_BASELINE_ROWS = 10, 10
DRIFT_MESSAGE, STABLE_MESSAGE = "Action Required: Retrain model", "Data stable"

CHART_HISTORY_DAYS = 30
ACTION_LOG_COLUMNS = [
    "Store_ID", "SKU_ID", "Current_Stock", "On_Order", "Safety_Stock", "Reorder_Point",
    "Order_Up_To_Level", "Order_Quantity_OUT", "Order_Quantity_Newsvendor", "Inventory_Health",
]
