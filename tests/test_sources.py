"""Readers and sinks on small files."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from brisa.operators import panel
from brisa.session import settle
from brisa.sources import inventory, readers, sinks

T0 = dt.datetime(2024, 1, 1)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_yearly_csv_with_different_columns(spark, tmp_path):
    write(f"{tmp_path}/2010_AllStations.csv", "fecha,cont_otres_PED,i_x\n2010-01-01,1.5,2\n2010-01-01 01:00:00,,3\n")
    write(f"{tmp_path}/2011_AllStations.csv", "fecha,cont_co_UIZ,cont_otres_PED\n2011-01-01 00:00:00,nan,7\n")
    d = readers.yearly_csv(spark, str(tmp_path), 2010, 2011)
    out = sorted((r.fecha, r.pollutant, r.id_est, r.val) for r in panel.unpivot(d).filter("val is not null").collect())
    assert out == [(dt.datetime(2010, 1, 1), "otres", "PED", 1.5), (dt.datetime(2011, 1, 1), "otres", "PED", 7.0)]


def test_agency_csv_quarantine(spark, tmp_path):
    head = "".join(f"header {i}\n" for i in range(11))
    write(f"{tmp_path}/a/x.csv", head + "01/02/2012 24:00,PED,O3,12.5,ppb\n01/02/2012 01:00,PED,PM2.5,,u\n99/99/2012 01:00,PED,O3,1,u\n01/02/2012 02:00,PED,O3,abc,u\n01/02/2012 02:00,PED,O3\n")
    rows, bad = readers.agency_csv(spark, f"{tmp_path}/a")
    assert [(r.fecha, r.table, r.id_est, r.val) for r in rows.collect()] == [(dt.datetime(2012, 2, 1, 23), "cont_otres", "PED", 12.5)]
    assert sorted(r.line[:16] for r in bad.collect()) == ["01/02/2012 02:00", "01/02/2012 02:00", "99/99/2012 01:00"]


def test_forecast_csvs_use_their_own_header(spark, tmp_path):
    write(f"{tmp_path}/M1/0101_000000/M1_forecast_3.csv", "timestamp,pred_cont_otres_PED,target_cont_otres_PED\n2024-01-01 00:00:00,1,2\n")
    write(f"{tmp_path}/M2/0101_000000/x_7.csv", "timestamp,target_cont_otres_UIZ,pred_cont_otres_UIZ,target_cont_otres_PED\n2024-01-01,5,6,nan\n")
    out = sorted((r.model, r.predicted_hour, r.station, r.target, r.pred) for r in readers.forecast_csvs(spark, str(tmp_path)).collect())
    assert out[0] == ("M1", 3, "PED", 2.0, 1.0) and out[2] == ("M2", 7, "UIZ", 5.0, 6.0) and out[1][:3] == ("M2", 7, "PED") and out[1][3] is None


def test_logs_and_listing(spark, tmp_path):
    write(f"{tmp_path}/l/run_a_gpu2.log", "Started at: 2024-01-01\nTraining timed out\n")
    write(f"{tmp_path}/l/training_summary_1.log", "x")
    r = inventory.log_status(readers.logs(spark, f"{tmp_path}/l")).collect()
    assert [(x.status, x.gpu_id, x.started, x.completed) for x in r] == [("timeout", "2", "2024-01-01", None)]
    assert readers.files(spark, f"{tmp_path}/l").count() == 2


def test_obs_roundtrip_prunes_partitions(spark, tmp_path):
    rows = [(T0 + dt.timedelta(days=200 * i), p, "A", float(i)) for p in ("otres", "co") for i in range(5)]
    o = spark.createDataFrame(rows, "fecha timestamp_ntz, pollutant string, id_est string, val double")
    sinks.write_obs(o, f"{tmp_path}/obs")
    d = panel.fetch(readers.scan_obs(spark, f"{tmp_path}/obs"), "co", "2024-01-01", "2025-12-31", ["A"])
    assert sorted(r.val for r in d.collect()) == [0, 1, 2, 3]
    plan = d._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pollutant" in plan and "PushedFilters: [" in plan and "GreaterThanOrEqual(fecha" in plan
    sinks.swap_without_years(spark, f"{tmp_path}/obs", f"{tmp_path}/obs2", 2025)
    assert sorted(r.val for r in spark.read.parquet(f"{tmp_path}/obs2").filter("pollutant = 'co'").collect()) == [0, 1]


def test_snapshot_is_write_once(spark, tmp_path):
    a = spark.createDataFrame([("pollutant", "co", 1.0, 2.0)], "kind string, name string, mean double, std double")
    p = sinks.write_params_once(a, f"{tmp_path}/p")
    q = sinks.write_params_once(a.withColumn("mean", F.lit(9.0)), f"{tmp_path}/p")
    assert p.first().mean == q.first().mean == 1.0
    sinks.copy_table(spark, f"{tmp_path}/p", f"{tmp_path}/p2")
    assert spark.read.parquet(f"{tmp_path}/p2").count() == 1
    sinks.save_columns(a, f"{tmp_path}/cols")
    assert [r.name for r in spark.read.json(f"{tmp_path}/cols").orderBy("pos").collect()] == ["kind", "name", "mean", "std"]


def test_settled_table_is_broadcast_by_size(spark):
    big = spark.range(100000).withColumn("k", F.col("id") % 10)
    small = settle(spark.range(10).withColumnRenamed("id", "k"), "t")
    assert "BroadcastHashJoin" in big.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in big.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_inventory_fallback_and_gap(spark):
    def days(*xs):
        return spark.createDataFrame([(T0 + dt.timedelta(days=x), s) for x, s in xs], "day timestamp_ntz, length bigint")

    found = days((0, 10**6), (1, 10**6), (3, 10**5))
    req = found.select("day").unionByName(days((2, 0), (6, 0)).select("day"))
    st = {r.day.day: r.status for r in inventory.gap_report(req, found).collect()}
    assert st == {1: "present", 2: "present", 4: "present", 3: "missing", 7: "missing"}
    broken = days((0, 10**5), (1, 10**5), (3, 10**6))
    assert {r.status for r in inventory.gap_report(req, broken).collect()} == {"missing"}
    use = {r.day.day: r.use_day and r.use_day.day for r in inventory.with_fallback(req, found).collect()}
    assert use == {1: 1, 2: 2, 3: 2, 4: 4, 7: None}
    assert inventory.latest_available(found, "2024-01-05").first().day == dt.datetime(2024, 1, 4)
    assert inventory.latest_available(found, "2024-03-05").first().is_default == 1
