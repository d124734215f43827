import datetime
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.errors import (
    DataValidationError, EmptyDataFrameError, InvalidSKUError, InvalidStoreError, MissingDatasetError,
)
from stockloom.operators import forecast as C, panel as P, validation as A
from stockloom.session import cut_lineage, drop_scratch, scratch_path
from stockloom.sources import retail as R
from stockloom.streaming.drift_monitor import start_drift_monitor


@pytest.fixture(scope="module")
def m5_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("m5")
    days, first = 30, datetime.date(2011, 1, 29)
    span = spark.createDataFrame([(first, first + datetime.timedelta(days=days - 1))], "first date, last date")
    R.write_csv(P.calendar(span), f"{folder}/calendar.csv")
    stores, items = ["CA_1", "CA_2", "TX_1", "WI_1"], [f"HOBBIES_1_00{i}" for i in range(1, 6)]
    sales = [(f"{i}_{s}_validation", i, "HOBBIES_1", "HOBBIES", s, s[:2], *(((d * 7 + len(i) + k) % 4) for d in range(days)))
             for k, s in enumerate(stores) for i in items]
    names = ", ".join(f"d_{d} int" for d in range(1, days + 1))
    R.write_csv(spark.createDataFrame(sales, "id string, item_id string, dept_id string, cat_id string, store_id string, "
                                             "state_id string, " + names), f"{folder}/sales_train_validation.csv")
    prices = [(s, i, 11101 + w, 2.5) for s in stores for i in items for w in range(5)]
    R.write_csv(spark.createDataFrame(prices, "store_id string, item_id string, wm_yr_wk int, sell_price double"),
                f"{folder}/sell_prices.csv")
    return str(folder)


@pytest.fixture(scope="module")
def tables(spark, m5_folder):
    return R.read_retail_tables(spark, m5_folder)


def test_read_types(tables):
    assert dict(tables.calendar.dtypes)["date"] == "date" and dict(tables.calendar.dtypes)["snap_CA"] == "int"
    assert dict(tables.prices.dtypes)["sell_price"] == "double" and dict(tables.sales.dtypes)["d_30"] == "int"


def test_typed_read_errors(spark, tmp_path):
    with pytest.raises(MissingDatasetError) as error:
        R.read_table(spark, f"{tmp_path}/none.csv")
    assert error.value.file_path.endswith("none.csv")
    (tmp_path / "head.csv").write_text("store_id,item_id\n")
    with pytest.raises(EmptyDataFrameError):
        R.read_table(spark, f"{tmp_path}/head.csv")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(EmptyDataFrameError):
        R.read_table(spark, f"{tmp_path}/empty.csv")
    (tmp_path / "bad.csv").write_text("store_id,wm_yr_wk\nCA_1,not a week\n")
    with pytest.raises(DataValidationError):
        R.read_table(spark, f"{tmp_path}/bad.csv")


def test_validation_passes_and_fails(tables, tmp_path):
    checks = A.validate(tables)
    status = A.overall_status(checks).first()
    assert status["all_passed"] and status["failed_checks"] == 0
    broken = R.RetailTables(tables.calendar, tables.prices.withColumn("sell_price", F.lit(0.0)), tables.sales)
    assert A.overall_status(A.validate(broken)).first()["failed_checks"] == 1
    R.write_report(A.report_lines(checks), f"{tmp_path}/report")
    lines = [r["value"] for r in checks.sparkSession.read.text(f"{tmp_path}/report").collect()]
    assert lines[0] == "# Table checks" and lines[2] == "Status: all checks passed"
    assert "| sell_prices | invalid_prices | 0 | ok |" in lines and len(lines) == 6 + checks.count()
    with pytest.raises(DataValidationError, match="sell_price"):
        A.validate(R.RetailTables(tables.calendar, tables.prices.drop("sell_price"), tables.sales))


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None)], "n int, t string")
    assert A.duplicate_count(df).first()[0] == 2
    assert {r["column"]: r["null_count"] for r in A.null_counts(df).collect()} == {"n": 0, "t": 1}
    assert A.null_cells(df).first()[0] == 1
    wide = spark.createDataFrame([(1, -1, -2), (2, 3, -1)], "id int, d_1 int, d_2 int")
    assert A.negative_sales(wide).first()[0] == 3
    shape = A.table_shape(wide).first()
    assert (shape["rows"], shape["columns"], shape["day_columns"]) == (2, 3, 2)


def test_narrowing_advice_and_cast(spark):
    df = spark.createDataFrame([(1, 1.5, "x"), (2, 2.7, "y"), (10, 3.9, "x")], "a bigint, b double, c string")
    advice = A.narrowing_advice(df)
    assert {r["column"]: r["suggested_type"] for r in advice.collect()} == {"a": "tinyint", "b": "float", "c": "category"}
    assert dict(A.apply_narrowing(df, advice).dtypes) == {"a": "tinyint", "b": "float", "c": "string"}
    edge = spark.createDataFrame([(127, None), (-5, 1.0)], "a bigint, b double")  # bounds are exclusive
    assert {r["column"]: r["suggested_type"] for r in A.narrowing_advice(edge).collect()} == {"a": "smallint", "b": "double"}


def test_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "b"), (10.0, None)], "x double, t string")
    row = A.describe_numbers(df, ["x"]).first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (4, 4.25, 1.75, 3.0, 5.5)
    text = A.describe_texts(df, ["t"]).first()
    assert (text["count"], text["unique"], text["top"], text["freq"]) == (3, 2, "b", 2)


def test_series_lookup_errors(tables):
    assert A.require_series(tables.sales, "CA_1", "HOBBIES_1_001").count() == 1
    with pytest.raises(InvalidStoreError):
        A.require_series(tables.sales, "NY_1", "HOBBIES_1_001")
    with pytest.raises(InvalidSKUError) as error:
        A.require_series(tables.sales, "TX_1", "HOBBIES_1_999")
    assert error.value.item_id == "HOBBIES_1_999"
    partial = tables.sales.where("not (store_id = 'TX_1' and item_id = 'HOBBIES_1_001')")
    with pytest.raises(EmptyDataFrameError):
        A.require_series(partial, "TX_1", "HOBBIES_1_001")
    with pytest.raises(EmptyDataFrameError):
        A.require_series(tables.sales.where("1 = 0"), "TX_1", "HOBBIES_1_001")


def test_panel_to_submission(spark, tables, tmp_path):
    panel = P.prepare_panel(tables.sales, tables.calendar, tables.prices)
    assert panel.count() == 4 * 5 * 30 and panel.where("sell_price is null").isEmpty()
    ids = tables.sales.select("store_id", "item_id", "id")
    rows = R.submission(C.seasonal_naive(panel, 14).join(ids, ["store_id", "item_id"]))
    assert rows.count() == 40 and rows.columns == ["id", *(f"F{i}" for i in range(1, 29))]
    assert rows.where("F15 <> 0").isEmpty() and rows.where("id like '%_evaluation'").count() == 20
    log = rows.select(F.lit("r").alias("run"), F.lit("m").alias("metric"), F.col("F1").alias("value"))
    R.write_records(log, f"{tmp_path}/records")
    R.write_records(log, f"{tmp_path}/records")
    R.write_records(log.withColumn("run", F.lit("other")), f"{tmp_path}/records")
    assert spark.read.parquet(f"{tmp_path}/records").count() == 80  # a repeated run replaces itself only


def test_results_do_not_depend_on_partitions(make_panel):
    series = {("S", str(k)): [(k * 7 + d) % 5 for d in range(20)] for k in range(6)}
    one, many = (C.seasonal_naive(make_panel(series, partitions=n), 9).orderBy("item_id", "step").collect() for n in (1, 13))
    assert one == many


def test_checkpoint_uses_the_session_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(spark.range(3)).count() == 3
    assert folder in spark.sparkContext.getCheckpointDir()


def test_drift_monitor_reports_each_batch(spark, tmp_path):
    old = spark.createDataFrame([("a", float(i % 50)) for i in range(200)] + [("b", float(i % 9)) for i in range(90)],
                                "event_type string, value double")
    arriving = tmp_path / "in"
    spark.createDataFrame([("a", 500.0 + i) for i in range(40)], old.schema).coalesce(1).write.parquet(str(arriving))
    stream = spark.readStream.schema(old.schema).parquet(str(arriving))
    query = start_drift_monitor(stream, old, ["event_type"], "value", f"{tmp_path}/out", f"{tmp_path}/cp", once=True)
    assert query.awaitTermination(120)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r["event_type"], r["drift_detected"], r["batch"]) for r in rows] == [("a", True, 0)]


def test_every_query_has_a_callable_and_every_oracle_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100 and V.SERIES == ["store_id", "item_id"]


def test_parts_with_another_column_order_are_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nS,I,1,2.5\n")
    (tmp_path / "t/b.csv").write_text("item_id,store_id,wm_yr_wk,sell_price\nI,S,1,2.5\n")
    with pytest.raises(Exception):
        R.read_table(spark, str(tmp_path / "t")).collect()


def test_workers_get_the_package_wherever_the_driver_runs(tmp_path):
    """A driver in another folder, without PYTHONPATH, whose Python workers only have what is shipped."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__
assert __spark_entry__.queries()["c05_ets"](spark, "/root/testdata/sf0.001").count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_scratch_tables_are_dropped(spark):
    path = scratch_path(spark, "kept")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
