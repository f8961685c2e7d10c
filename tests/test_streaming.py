"""Incremental staging driven by a file stream (availableNow)."""

from pyspark.sql import functions as F

from terrafold.operators import landing
from terrafold.plans.boundaries import stage_boundaries
from terrafold.streaming import incremental

from test_stage import GOOD, SHORT


def _land(spark, root, day, lines, member):
    df = spark.createDataFrame([(v,) for v in lines], "value string").select(
        F.lit("neighborhoods").alias("product"), F.lit(day).alias("file_date"), F.lit(member).alias("member"), "value")
    landing.land(df, root)


def test_new_dates_only_and_late_member(spark, tmp):
    raw, hist, bad, ckpt = f"{tmp}/raw", f"{tmp}/hist", f"{tmp}/bad", f"{tmp}/ckpt"

    def restage(days):
        stage_boundaries(spark, raw, hist, bad, days=days, bad_by="parent_folder_name")

    _land(spark, raw, "20240101", [GOOD, SHORT], "neighborhoods-1m.tsv")
    assert incremental.run(spark, raw, restage, checkpoint=ckpt) == ["20240101"]
    assert incremental.run(spark, raw, restage, checkpoint=ckpt) == []            # nothing new
    _land(spark, raw, "20240101", [GOOD.replace("g1", "g7")], "neighborhoods-2n.tsv")  # late member
    _land(spark, raw, "20240201", [GOOD.replace("g1", "g8")], "neighborhoods-1m.tsv")
    assert incremental.run(spark, raw, restage, checkpoint=ckpt) == ["20240101", "20240201"]
    h = spark.read.orc(hist)
    got = sorted((str(r["load_date"]), r["geo_id"]) for r in h.select("load_date", "geo_id").collect())
    assert got == [("2024-01-01", "g1"), ("2024-01-01", "g7"), ("2024-02-01", "g8")]
    assert [r[0] for r in spark.read.text(bad).collect()] == [SHORT]
