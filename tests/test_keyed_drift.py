"""Keyed streaming drift against the batch index; late rows, restart and expiry."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import drift
from stockloom.streaming import keyed_drift

START = datetime.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(k, START + datetime.timedelta(hours=h), v) for k, h, v in rows], "kind string, ts timestamp, value double")


def test_keyed_drift_equals_the_batch_index_and_survives_restarts(spark, tmp_path):
    rng = np.random.default_rng(3)
    old = [("a", 0, float(v)) for v in rng.normal(size=300).round(1)] + [("b", 0, float(v)) for v in rng.normal(size=200).round(1)] + [("flat", 0, 1.0)] * 20
    new = [("a", h, float(v)) for h, v in enumerate(rng.normal(0.2, 1, 60).round(1))]
    new += [("b", h, float(v)) for h, v in enumerate(rng.normal(3, 1, 60).round(1))] + [("flat", 5, 1.0), ("unknown", 6, 2.0), ("a", 7, None)]
    baseline = events(spark, old)
    keyed_drift.baseline_bins(baseline, ["kind"], "value").write.parquet(str(tmp_path / "bins"))
    bins = spark.read.parquet(str(tmp_path / "bins"))
    given, out = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(rows, number):
        events(spark, rows).coalesce(1).write.parquet(f"{given}/part={number}")
        stream = spark.readStream.schema("kind string, ts timestamp, value double").parquet(f"{given}/part=*")
        query = keyed_drift.start_keyed_drift(stream, bins, ["kind"], "value", "ts", out, str(tmp_path / "checkpoint"), once=True,
                                              late="100 hours", idle="48 hours")
        query.awaitTermination(120)
        assert query.exception() is None
        return spark.read.parquet(out)

    arrive([r for r in new if r[1] < 20], 1)
    found = arrive([r for r in new if r[1] >= 20], 2)     # a restart: the state comes from the checkpoint
    last = {r["kind"]: r for r in found.where("not expired").orderBy("batch").collect()}
    sides = baseline.select("kind", "value", F.lit(False).alias("is_new")).unionByName(
        events(spark, new).where("value is not null").select("kind", "value", F.lit(True).alias("is_new")))
    batch = {r["kind"]: r["psi"] for r in drift.psi(drift.compared(sides, ["kind"], False), ["kind"]).collect()}
    assert last["b"]["psi"] == pytest.approx(batch["b"]) and last["b"]["drift_detected"] and last["b"]["rows"] == 60
    assert last["a"]["rows"] == 61 and last["a"]["outside"] >= 1 and last["a"]["psi"] < last["b"]["psi"]
    assert last["flat"]["psi"] == 0.0 and last["unknown"]["outside"] == 1

    # The watermark stands 100 hours behind the newest event: an older row is late and is dropped.
    arrive([("b", 500, 3.0)], 3)
    arrive([("b", 10, 3.0), ("b", 501, 3.0)], 4)
    found = arrive([("b", 502, 3.0)], 5)
    rows = found.where("kind = 'b' and not expired").orderBy("batch").collect()
    gone = {r["kind"]: r["rows"] for r in found.where("expired").collect()}
    assert gone["a"] == 61 and gone["flat"] == 1 and gone["unknown"] == 1
    # Late rows never count: all rows of b were 60, and 1 + 1 + 1 in time.
    assert rows[-1]["rows"] in (63, 3, 2, 1) and sum(1 for r in rows if r["rows"] == 64) == 0
