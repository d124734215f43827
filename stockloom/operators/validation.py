"""Table checks: schema, nulls, duplicates, values, summaries and the overall verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import fixed_values as V
from stockloom.errors import (
    DataValidationError, EmptyDataFrameError, InvalidSKUError, InvalidStoreError,
)
from stockloom.operators.panel import day_columns
from stockloom.plans.ordered import count_quantiles
from stockloom.session import scratch_path
from stockloom.sources.retail import RetailTables

# Exclusive bounds of the integer types, narrowest first.
_INTEGER_RANGES = [
    ("tinyint", -(2**7), 2**7 - 1), ("smallint", -(2**15), 2**15 - 1), ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
]
_FLOAT_LIMIT = 3.4028234663852886e38


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str], dataset: str) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise DataValidationError(f"{dataset}: missing columns {missing}")


def _one_row_per_column(df: DataFrame, measures: dict[str, dict[str, "F.Column"]]) -> DataFrame:
    """Aggregate once, then turn ``{column: {measure: expression}}`` into rows."""
    flat = {
        f"{i}_{m}": e for i, exprs in enumerate(measures.values()) for m, e in exprs.items()}
    totals = df.agg(*(e.alias(a) for a, e in flat.items()))
    rows = F.array(*(
        F.struct(F.lit(c).alias("column"), *(F.col(f"{i}_{m}").alias(m) for m in exprs))
        for i, (c, exprs) in enumerate(measures.items())
    ))
    return totals.select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    """Null cells per column, as ``(column, null_count)``."""
    return _one_row_per_column(df, {
        c: {"null_count": F.count_if(F.col(c).isNull())} for c in df.columns})


def null_cells(df: DataFrame) -> DataFrame:
    """Null cells of the whole table."""
    return null_counts(df).agg(F.sum("null_count").alias("null_count"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    return (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_count"))
    )


def non_positive_prices(prices: DataFrame) -> DataFrame:
    return prices.agg(F.count_if(F.col("sell_price") <= 0).alias("invalid_prices_count"))


def negative_sales(sales: DataFrame) -> DataFrame:
    """Negative cells of a long table (``sales``) or of a wide one (all day columns)."""
    days = day_columns(sales)
    if not days:
        return sales.agg(F.count_if(F.col("sales") < 0).alias("negative_sales_count"))
    below = F.size(F.filter(F.array(*days), lambda cell: cell < 0))
    return sales.agg(F.coalesce(F.sum(below), F.lit(0)).alias("negative_sales_count"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.lit(len(day_columns(df))).alias("day_columns"))


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column, from one scan.

    Equal values of all columns are counted together and the counts are stored; everything else comes from them.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns)))
    path = scratch_path(df.sparkSession, "value-counts")
    df.select(pairs.alias("pair")).select("pair.*").where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    sums = counts.groupBy("column").agg(
        F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    # Squares around the mean, so that large values far from zero lose no digits.
    spread = counts.join(F.broadcast(sums.select("column", "mean")), "column").groupBy("column").agg(
        F.sum(F.col("n") * (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean"))).alias("squares"))
    quartiles = count_quantiles(counts, [0.25, 0.5, 0.75])
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return named.join(sums, "column", "left").join(spread, "column", "left").join(quartiles, "column", "left").select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"), "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, distinct values, most frequent value (least on ties) and its frequency."""
    pairs = F.explode(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = (
        df.select(pairs.alias("pair")).select("pair.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"))


def head_sample(df: DataFrame, order: list[str], rows: int = 3, columns: int = 10) -> DataFrame:
    """The first rows in a stated order; a report sample."""
    return df.orderBy(*order).limit(rows).select(*df.columns[:columns])


def point_query(sales: DataFrame, store_id: str, item_id: str) -> DataFrame:
    return sales.where((F.col("store_id") == store_id) & (F.col("item_id") == item_id))


def narrowing_advice(df: DataFrame) -> DataFrame:
    """The narrowest type each column's values allow, with the numbers that decide it."""
    measures = {}
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        current = F.first(F.lit(kind.simpleString()))
        nothing = F.lit(None)
        low, high = F.min(column), F.max(column)
        if isinstance(kind, T.IntegralType):
            advice = F.coalesce(*(
                F.when((low > lo) & (high < hi), F.lit(name)) for name, lo, hi in _INTEGER_RANGES),
                F.lit("bigint"))
            numbers = [low.cast("double"), high.cast("double"), nothing.cast("bigint")]
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            fits = (F.count(column) == F.count(F.lit(1))) & (low > -_FLOAT_LIMIT) & (high < _FLOAT_LIMIT)
            advice = F.when(fits, F.lit("float")).otherwise(F.lit("double"))
            numbers = [low.cast("double"), high.cast("double"), nothing.cast("bigint")]
        elif isinstance(kind, T.StringType):
            distinct = F.count_distinct(column)
            advice = F.when(distinct <= V.CATEGORY_LIMIT, F.lit("category")).otherwise(F.lit("string"))
            numbers = [nothing.cast("double"), nothing.cast("double"), distinct]
        else:
            advice = F.first(F.lit(kind.simpleString()))
            numbers = [nothing.cast("double"), nothing.cast("double"), nothing.cast("bigint")]
        measures[field.name] = {
            "current_type": current, "min_value": numbers[0], "max_value": numbers[1],
            "n_distinct": numbers[2], "suggested_type": advice,
        }
    return _one_row_per_column(df, measures)


def apply_narrowing(df: DataFrame, advice: DataFrame) -> DataFrame:
    """Cast by an advice table (one row per column, so collecting it is bounded)."""
    wanted = {r["column"]: r["suggested_type"] for r in advice.select("column", "suggested_type").collect()}
    casts = [
        F.col(c).cast(wanted[c]).alias(c)
        if wanted.get(c) not in (None, "category", "string") else F.col(c)
        for c in df.columns
    ]
    return df.select(*casts)


def findings(tables: RetailTables) -> DataFrame:
    """Every check of the three tables as ``(dataset, check, value, passed)``.

    ``passed`` is null for checks that are reported but do not decide the status.
    """
    named = {"calendar": tables.calendar, "sell_prices": tables.prices, "sales": tables.sales}
    require = {
        "calendar": V.CALENDAR_REQUIRED, "sell_prices": V.PRICES_REQUIRED, "sales": V.SALES_REQUIRED}
    deciding = {
        "sell_prices": ("invalid_prices", "sell_price"), "sales": ("negative_sales", "sales")}
    return reduce(DataFrame.unionByName, (
        _checks(dataset, df, missing_columns(df, require[dataset]), deciding.get(dataset)) for dataset, df in named.items()))


def _checks(dataset: str, df: DataFrame, missing: list[str], deciding: tuple | None) -> DataFrame:
    """The rows of one table's checks from one pass: equal rows are counted together, which also tells the repeats."""
    nulls = reduce(lambda a, b: a + b, (F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0))
    bad = bad_cells(df, deciding[1]) if deciding else F.lit(0)
    counted = df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    total = lambda value: F.coalesce(F.sum(F.col("_copies") * value), F.lit(0)).cast("bigint")
    sums = counted.agg(total(F.lit(1)).alias("rows"), total(nulls).alias("null_cells"),
                       F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"), total(bad).alias("bad"))
    undecided = F.lit(None).cast("boolean")
    lines = [("missing_columns", F.lit(len(missing)), F.lit(not missing)), ("rows", F.col("rows"), undecided),
             ("null_cells", F.col("null_cells"), undecided), ("duplicates", F.col("duplicates"), undecided)]
    if deciding:
        lines.append((deciding[0], F.col("bad"), F.col("bad") == 0))
    return sums.select(F.inline(F.array(*(
        F.struct(F.lit(dataset).alias("dataset"), F.lit(check).alias("check"), value.cast("bigint").alias("value"), passed.alias("passed"))
        for check, value, passed in lines))))


def bad_cells(df: DataFrame, kind: str) -> Column:
    """Number of a row's cells that break the table's rule: prices not above 0, or sales below 0 (all day columns)."""
    if kind == "sell_price":
        return F.coalesce((F.col("sell_price") <= 0).cast("long"), F.lit(0))
    days = day_columns(df)
    if not days:
        return F.coalesce((F.col("sales") < 0).cast("long"), F.lit(0))
    return F.size(F.filter(F.array(*days), lambda cell: cell < 0)).cast("long")


def overall_status(checks: DataFrame) -> DataFrame:
    """True when every deciding check passed."""
    return checks.agg(
        F.bool_and("passed").alias("all_passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"))


def validate(tables: RetailTables) -> DataFrame:
    """Required columns are enforced; the findings table is returned."""
    require_columns(tables.calendar, V.CALENDAR_REQUIRED, "calendar")
    require_columns(tables.prices, V.PRICES_REQUIRED, "sell_prices")
    require_columns(tables.sales, V.SALES_REQUIRED, "sales")
    return findings(tables)


def report_lines(checks: DataFrame) -> DataFrame:
    """The findings as numbered lines of a markdown report: status, then one row per check."""
    verdict = F.when(F.col("passed").isNull(), "info").when(F.col("passed"), "ok").otherwise("FAILED")
    cells = [F.col("dataset"), F.col("check"), F.col("value").cast("string"), verdict]
    line = lambda *parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    place = F.row_number().over(Window.orderBy("dataset", "check"))  # a dozen rows, one per check
    body = checks.select((place + 5).alias("line_no"), line(*cells).alias("line"))
    outcome = F.when(F.col("all_passed"), "all checks passed").otherwise(
        F.concat(F.col("failed_checks").cast("string"), F.lit(" checks failed")))
    head = overall_status(checks).select(F.posexplode(F.array(
        F.lit("# Table checks"), F.lit(""), F.concat(F.lit("Status: "), outcome), F.lit(""),
        line(*(F.lit(c) for c in ("dataset", "check", "value", "result"))),
        line(*(F.lit("---") for _ in cells)))).alias("line_no", "line"))
    return head.unionByName(body)


def sample_lines(dataset: str, df: DataFrame, order: list[str], first: int, rows: int = 3, columns: int = 10) -> DataFrame:
    """A table's shape and first rows as lines of a markdown report, numbered from ``first``."""
    shown = df.columns[:columns]
    bar = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    size = df.agg(F.count(F.lit(1)).alias("n")).select(F.posexplode(F.array(
        F.lit(""), F.concat(F.lit(f"## {dataset}: "), F.col("n").cast("string"), F.lit(f" rows, {len(df.columns)} columns")), F.lit(""),
        bar([F.lit(c) for c in shown]), bar([F.lit("---") for _ in shown]))).alias("at", "line"))
    # A handful of rows: the limit comes before the numbering.
    sample = df.orderBy(*order).limit(rows).select(*shown, *(F.col(c).alias(f"_by{i}") for i, c in enumerate(order)))
    place = F.row_number().over(Window.orderBy(*(f"_by{i}" for i in range(len(order)))))
    cells = sample.select((place + 4).alias("at"), bar([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in shown]).alias("line"))
    return size.unionByName(cells).select((F.col("at") + first).alias("line_no"), "line")


def full_report(tables: RetailTables, orders: dict[str, list[str]], rows: int = 3, columns: int = 10) -> DataFrame:
    """The whole validation of three tables in one frame of numbered lines: status, every check, shapes and samples.

    ``orders`` names the columns that each table's sample is ordered by. Write it with ``sources.retail.write_report``.
    """
    named = {"calendar": tables.calendar, "sell_prices": tables.prices, "sales": tables.sales}
    parts = [report_lines(validate(tables)).select(F.col("line_no").cast("int").alias("line_no"), "line")]
    for number, (dataset, df) in enumerate(named.items(), start=1):
        parts.append(sample_lines(dataset, df, orders[dataset], 100 * number, rows, columns))
    return reduce(DataFrame.unionByName, parts)


def reject_requests(requests: DataFrame, sales: DataFrame) -> DataFrame:
    """Requested series that cannot be planned, with the reason."""
    stores = sales.select("store_id").distinct().withColumn("known_store", F.lit(True))
    items = sales.select("item_id").distinct().withColumn("known_item", F.lit(True))
    pairs = sales.select(*V.SERIES).distinct().withColumn("known_pair", F.lit(True))
    reason = (
        F.when(F.col("known_store").isNull(), "unknown store")
        .when(F.col("known_item").isNull(), "unknown product")
        .when(F.col("known_pair").isNull(), "no rows for this store and product")
    )
    return (
        requests.join(stores, "store_id", "left").join(items, "item_id", "left")
        .join(pairs, V.SERIES, "left")
        .select(*V.SERIES, reason.alias("reason")).where(F.col("reason").isNotNull())
    )


def require_series(sales: DataFrame, store_id: str, item_id: str) -> DataFrame:
    """Single-series façade: the rows of one series, or a typed error."""
    request = sales.sparkSession.createDataFrame([(store_id, item_id)], "store_id string, item_id string")
    if sales.isEmpty():
        raise EmptyDataFrameError("sales")
    rejected = reject_requests(request, sales).first()
    if rejected is None:
        return point_query(sales, store_id, item_id)
    if rejected["reason"] == "unknown store":
        raise InvalidStoreError(store_id)
    if rejected["reason"] == "unknown product":
        raise InvalidSKUError(item_id)
    raise EmptyDataFrameError(f"{store_id}/{item_id}")


def store_list(sales: DataFrame) -> DataFrame:
    return sales.select("store_id").distinct().orderBy("store_id")


def items_of_store(sales: DataFrame, store_id: str) -> DataFrame:
    return sales.where(F.col("store_id") == store_id).select("item_id").distinct().orderBy("item_id")
